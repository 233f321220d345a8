"""Merging new rows into keyed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def newest_batch(rows: DataFrame, keys: list[str], commit: str, scanned: str, batch: str, final: bool = False) -> DataFrame:
    """All distinct rows of the newest batch of each key.

    A batch is the rows of one scan and commit; the greatest commit wins, then the latest scan, where rows without
    a scan time (already in the table) are the oldest. A final merge clears the scan columns."""
    order = Window.partitionBy(*keys).orderBy(F.col(commit).desc(), F.col(scanned).desc_nulls_last(), F.col(batch))
    best = rows.withColumn("__rank", F.rank().over(order)).where("__rank = 1").drop("__rank").distinct()
    if final:
        best = best.withColumn(scanned, F.lit(None).cast(rows.schema[scanned].dataType)).withColumn(batch, F.lit(None).cast(rows.schema[batch].dataType))
    return best


def greatest_row(rows: DataFrame, keys: list[str], value: str, ties: list[str]) -> DataFrame:
    """The row of each key with the greatest value; of equal ones the first by `ties`."""
    order = Window.partitionBy(*keys).orderBy(F.col(value).desc(), *ties)
    return rows.withColumn("__nth", F.row_number().over(order)).where("__nth = 1").drop("__nth")


def block_merge(rows: DataFrame, key: str, newest: list[str], blocks: dict[str, list[str]], deleted: str | None = None, fixed: list[str] | None = None) -> DataFrame:
    """One row for each key, put together from blocks of columns that have their own times.

    The base columns come from the row that is greatest by `newest`; each block (time column -> its columns) from
    the row with the greatest time of its own. A key any of whose rows is `deleted` goes; columns in `fixed`
    must agree, or the merge fails."""
    taken = {c for time, columns in blocks.items() for c in (time, *columns)}
    base = [c for c in rows.columns if c != key and c not in taken and c != deleted]
    parts = [F.max_by(F.struct(*base), F.struct(*newest)).alias("__base")]
    for i, (time, columns) in enumerate(blocks.items()):
        parts.append(F.max_by(F.struct(time, *columns), F.struct(F.col(time), *newest)).alias(f"__block{i}"))
    parts += [F.bool_or(deleted).alias("__gone")] if deleted else []
    parts += [F.min(F.struct(*fixed)).alias("__low"), F.max(F.struct(*fixed)).alias("__high")] if fixed else []
    out = rows.groupBy(key).agg(*parts)
    out = out.where(~F.col("__gone")) if deleted else out
    if fixed:
        differ = F.when(~F.col("__low").eqNullSafe(F.col("__high")), F.raise_error(F.concat(F.lit("columns that never change differ for "), F.col(key).cast("string"))))
        out = out.where(differ.cast("boolean").isNull())
    return out.select(key, "__base.*", *[f"__block{i}.*" for i in range(len(blocks))])


def check_unique(rows: DataFrame, keys: list[str], shown: int = 10) -> DataFrame:
    """The rows, or an error that names a few keys which occur twice."""
    twice = rows.groupBy(*keys).count().where("count > 1").limit(shown).collect()
    if twice:
        raise ValueError(f"rows share a key: {[tuple(r[k] for k in keys) for r in twice]}")
    return rows


def compact(existing: DataFrame | None, new: DataFrame, prune, keys: list[str], sort: list[str]) -> DataFrame:
    """Existing and new rows together, pruned, checked and sorted inside partitions."""
    rows = new if existing is None else existing.unionByName(new)
    return check_unique(prune(rows), keys).sortWithinPartitions(*sort)


def upsert_latest(stored: DataFrame, new: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Stored rows replaced only by rows of a later time."""
    both = stored.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    order = Window.partitionBy(*keys).orderBy(F.col(at).desc(), "__new")
    return both.withColumn("__nth", F.row_number().over(order)).where("__nth = 1").drop("__nth", "__new")
