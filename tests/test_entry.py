import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [n for n in entry.oracle_sql() if not n.startswith("op")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
    cursor = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert got == sorted((tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=str)


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def _sorted_rows(rows, names, columns):
    return sorted((tuple(r[names.index(c)] for c in columns) for r in rows), key=str)


@pytest.fixture(scope="module")
def no_rows(spark, tmp_path_factory):
    root, con = tmp_path_factory.mktemp("none"), duckdb.connect()
    for t in TABLES:
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(root / f"{t}.parquet"))
        con.execute(f"create view {t} as select * from '{root}/{t}.parquet/*.parquet'")
    return str(root), con


@pytest.mark.parametrize("name", [n for n in NAMES if n != "published_tables"])
def test_tables_without_rows(spark, no_rows, name):
    root, con = no_rows
    df = entry.queries()[name](spark, root)
    cursor = con.execute(entry.oracle_sql()[name])
    assert _sorted_rows(df.collect(), df.columns, sorted(df.columns)) == _sorted_rows(cursor.fetchall(), [d[0] for d in cursor.description], sorted(df.columns))


def test_publishing_tables_without_rows(spark, no_rows):
    """None of the later sets is newer, so the first one stays."""
    rows = entry.queries()["published_tables"](spark, no_rows[0]).collect()
    assert {(r["table_name"], r["version"], r["n"], r["newest"]) for r in rows} == {(t, 1, 0, None) for t in ("customers", "orders", "settled")}
