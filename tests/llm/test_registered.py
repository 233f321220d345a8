"""The registered queries themselves: against their SQL where they have one, else that they cover their table."""

import duckdb
import pytest

from cairnlake.llm import queries

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()
OF = {"op6_lattice_vectors": ("embeddings", "vec_id"), "op7_chat_formatting": ("conversations", "conv_id"), "op9_warc_archive": ("pages", "page_id")}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _rounded(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", queries.QUERIES)
def test_registered_query(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    rows = df.collect()
    table, key = OF.get(name, ("documents", "doc_id"))
    if name != "op12_spelling_variants":  # which has a row for each word, held against its SQL
        ids = {x for (x,) in duck.execute(f"select distinct {key} from {table}").fetchall()}
        assert {r[key] for r in rows} == ids | ({-7} if key == "conv_id" else set())
    if name in queries.ORACLES:
        columns = sorted(df.columns)
        cursor = duck.execute(queries.ORACLES[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        expected = [tuple(_rounded(r[names.index(c)]) for c in columns) for r in cursor.fetchall()]
        assert sorted([tuple(_rounded(r[c]) for c in columns) for r in rows], key=str) == sorted(expected, key=str)
