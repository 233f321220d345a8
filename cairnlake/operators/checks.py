"""Validation queries over tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairnlake.sources.folders import rewritten


def compare_sets(left: DataFrame, right: DataFrame, column: str, shown: int = 5) -> DataFrame:
    """One row: how many values only one side has, and the smallest few of them. The samples are bounded."""
    l, r = left.select(column).distinct().withColumn("l", F.lit(1)), right.select(column).distinct().withColumn("r", F.lit(1))
    odd = l.join(r, column, "full_outer").where("l is null or r is null")
    parts = odd.agg(F.count_if(F.col("r").isNull()).alias("left_only"), F.count_if(F.col("l").isNull()).alias("right_only"))
    for name, side in (("left", "r"), ("right", "l")):
        few = odd.where(F.col(side).isNull()).select(F.col(column).alias(name)).orderBy(name).limit(shown)
        parts = parts.unionByName(few, allowMissingColumns=True)
    sample = lambda name: F.array_sort(F.collect_list(name)).alias(f"{name}_sample")  # noqa: E731  a few rows at most
    return parts.agg(F.max("left_only").alias("left_only"), F.max("right_only").alias("right_only"), sample("left"), sample("right"))


def compare_all(tables: dict[str, DataFrame], column: str, required: bool = True, shown: int = 5) -> DataFrame:
    """(left_table, right_table, left_only, right_only, left_sample, right_sample) for each two tables, in the order of their
    names: how many values only one of them has, and the smallest few of them.

    Every value gets the set of tables that hold it, in one aggregation over all tables; what two tables lack of each
    other follows from the number of values with each set. Null counts as a value, unless values are not required: then null
    and empty values are left out. At most 62 tables."""
    names = sorted(tables)
    rows = [tables[n].select(F.col(column).alias("value"), F.lit(1 << i).cast("long").alias("held")) for i, n in enumerate(names)]
    if len(rows) < 2:
        raise ValueError("at least two tables are compared")
    whole = reduce(DataFrame.unionAll, rows)
    if not required:
        whole = whole.where(F.col("value").isNotNull() & (F.col("value").cast("string") != ""))
    sets = rewritten(whole.groupBy("value").agg(F.bit_or("held").alias("held")))
    counts = sets.groupBy("held").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("held").orderBy(F.col("value").asc_nulls_first()))
    few = sets.where(F.col("held") != (1 << len(names)) - 1).withColumn("nth", nth).where(F.col("nth") <= shown)  # Spark cuts each task to a few of each set
    known = counts.join(few.groupBy("held").agg(F.collect_list(F.struct("value")).alias("few")), "held", "left")
    nowhere = whole.sparkSession.range(1).select(F.lit(0).cast("long").alias("held"), F.lit(0).cast("long").alias("n"))  # tables without rows have their pairs too
    known = known.unionByName(nowhere, allowMissingColumns=True)
    has = lambda i: F.col("held").bitwiseAND(F.lit(1 << i)) != 0
    pairs = [F.struct(F.lit(a).alias("left_table"), F.lit(b).alias("right_table"), has(i).alias("l"), has(j).alias("r")) for i, a in enumerate(names) for j, b in enumerate(names) if i < j]
    each = known.select("n", "few", F.explode(F.array(*pairs)).alias("p")).select("n", "few", "p.*")
    side = lambda c, o: F.col(c) & ~F.col(o)
    total = lambda c, o: F.coalesce(F.sum(F.when(side(c, o), F.col("n"))), F.lit(0))
    smallest = lambda c, o: F.slice(F.array_sort(F.flatten(F.collect_list(F.when(side(c, o), F.col("few"))))), 1, shown)
    out = each.groupBy("left_table", "right_table").agg(total("l", "r").alias("left_only"), total("r", "l").alias("right_only"), smallest("l", "r").alias("x"), smallest("r", "l").alias("y"))
    value = lambda c: F.transform(c, lambda v: v["value"])
    return out.select("left_table", "right_table", "left_only", "right_only", value("x").alias("left_sample"), value("y").alias("right_sample"))


#: Columns that all tables which have them must agree on, and whether every row has one.
SHARED_COLUMNS = {"Identity": True, "LowerId": True, "Fingerprint": False}


def compare_registry(tables: dict[str, DataFrame]) -> DataFrame | None:
    """compare_all() of each shared column over the tables that have it: the first of them, by name, with each other one.
    None where no column is in two tables."""
    parts = []
    for column, required in SHARED_COLUMNS.items():
        own = {name: df for name, df in tables.items() if column in df.columns}
        if len(own) > 1:
            parts.append(compare_all(own, column, required).where(F.col("left_table") == min(own)).select(F.lit(column).alias("column"), "*"))
    return reduce(DataFrame.unionByName, parts) if parts else None


def missing(rows: DataFrame, columns: list[str], reference: DataFrame, key: str) -> DataFrame:
    """Distinct non-empty values of several columns that the reference lacks."""
    values = rows.select(F.explode(F.array(*columns)).alias(key)).where(F.col(key).isNotNull() & (F.col(key).cast("string") != "")).distinct()
    return values.join(reference.select(key).distinct(), key, "left_anti")


def distinct_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, n): distinct values of a column of each table."""
    parts = [df.agg(F.countDistinct(column).alias("n")).select(F.lit(name).alias("table_name"), "n") for name, (df, column) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def adjacent(df: DataFrame, at: str, value) -> DataFrame:
    """(label, low, high) of the values just before, at and just after a moment, as far as they exist."""
    near = df.where(F.col(at) <= value).select(at).distinct().orderBy(F.desc(at)).limit(2).union(df.where(F.col(at) >= value).select(at).distinct().orderBy(at).limit(2)).distinct()
    label = F.when(F.col(at) < value, "before").when(F.col(at) == value, "same").otherwise("after")
    return near.groupBy(label.alias("label")).agg(F.min(at).alias("low"), F.max(at).alias("high"))


def newer(new: DataFrame, old: DataFrame, at: str, default) -> DataFrame:
    """(new_max, old_max, is_newer); an empty table counts with the default."""
    both = new.agg(F.max(at).alias("new_max")).unionByName(old.agg(F.max(at).alias("old_max")), allowMissingColumns=True)
    both = both.agg(*[F.coalesce(F.max(c), F.lit(default)).alias(c) for c in ("new_max", "old_max")])
    return both.withColumn("is_newer", F.col("new_max") > F.col("old_max"))


def keyset_page(rows: DataFrame, firsts: DataFrame, key: str, first: str, created: str, start, size: int) -> DataFrame:
    """A page of rows by creation time (or the first event where it is missing), from `start` on."""
    least = firsts.groupBy(key).agg(F.min(first).alias("__first"))
    return rows.join(least, key).withColumn(created, F.coalesce(created, "__first")).drop("__first").where(F.col(created) >= start).orderBy(created, key).limit(size)


def load_and_swap(spark, tables: dict[str, DataFrame], checks, database: str = "default") -> dict[str, bool]:
    """Writes each table beside the live one, runs checks (name -> function of the new tables that returns failed rows)
    and renames the new tables over the old ones only if none failed."""
    for name, df in tables.items():
        df.write.mode("overwrite").saveAsTable(f"{database}.{name}_Temp")
    fresh = {name: spark.table(f"{database}.{name}_Temp") for name in tables}
    result = {name: not check(fresh).take(1) for name, check in checks.items()}
    if all(result.values()):
        live = [name for name in tables if spark.catalog.tableExists(f"{database}.{name}")]
        for name in live:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}_Old")
        for old, new in [(name, f"{name}_Old") for name in live] + [(f"{name}_Temp", name) for name in tables]:
            spark.sql(f"ALTER TABLE {database}.{old} RENAME TO {database}.{new}")  # names only, all together
        for name in live:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}_Old")
    return result
