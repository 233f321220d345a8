"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's target over its size. The
documents of a source stand in a fixed order (by size band, then by a digest of the id); the prefix sums
of their expected copies, plus one random offset for the source, cross integers, and a document is
emitted once for each integer that its share crosses. As neighbours in the order have like sizes, the
words taken come near the target.

The prefix sums are taken in three levels, so that no task sees more than a small part of a source: rows
in a cell (source, size band, one of 64 digest buckets), cells in a band, bands in a source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairnlake.llm.common import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)


def word_count(text: Column | str) -> Column:
    return F.regexp_count(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources by code point, null last, get the weights in turn. The level that weighted targets rise to is the
    largest (rest of the total) / (rest of the weights) when sources are filled up in order of cap over
    weight: what stops at its cap leaves its excess to the others."""
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(ordered) - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("source", "source_size", weight.alias("weight")).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    onward = filled.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward))
    return s.select("source", "source_size", F.least("cap", F.col("weight") * F.max("level").over(everything)).alias("target"))


def mix(df: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 0) -> DataFrame:
    """(id, size, source_size, target, copies, taken) of every row, and the columns named in keep.

    Null texts have size 0; a null source is a source of its own, the last; empty texts get copies but take
    no words; a source without words has target 0 and no copies. Repeated rows are rows of their own.
    Reruns agree: order and offsets come from digests, not from the layout of the data."""
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    bits = F.length(F.bin("size"))
    top = F.expr("shiftright(size, cast(greatest(length(bin(size)) - 5, 0) as int))")
    kept = [F.col(c).alias(f"keep_{i}") for i, c in enumerate(keep or [])]
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), *kept)
    rows = rows.withColumn("digest", digest).withColumn("band", (bits * 32 + top).cast("int")).withColumn("bucket", F.conv(F.substring("digest", 1, 2), 16, 10).cast("int") % 64)
    cell = ["source", "band", "bucket"]
    if not keep:
        rows = written(rows)  # narrow rows: texts are read once
    cells = written(rows.groupBy(*cell).agg(F.count("*").alias("n"), F.sum("size").alias("words")))
    bands = cells.groupBy("source", "band").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    totals = targets(bands.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    up_to = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    base = bands.withColumn("band_base", F.coalesce(F.sum("n").over(up_to("source", "band")), F.lit(0))).drop("n", "words")
    base = _null_safe(base, totals, ["source"])
    cells = cells.withColumn("cell_base", F.coalesce(F.sum("n").over(up_to(*cell)), F.lit(0))).drop("n", "words")
    cells = _null_safe(cells, base, ["source", "band"])
    rows = _null_safe(rows, cells, cell)
    place = F.col("band_base") + F.col("cell_base") + F.row_number().over(Window.partitionBy(*cell).orderBy("size", "digest", "id"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat_ws("#", F.lit(str(seed)), F.col("source"))), 1, 3), 16, 10).cast("double") / 4096.0
    rows = rows.withColumn("place", place).withColumn("rate", rate).withColumn("offset", offset)
    copies = (F.floor(F.col("place") * F.col("rate") + F.col("offset")) - F.floor((F.col("place") - 1) * F.col("rate") + F.col("offset"))).cast("long")
    rows = rows.withColumn("copies", copies)
    result = [F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")]
    own = {id_col, "size", "source_size", "target", "copies", "taken"}
    return rows.select(*result, *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(keep or []) if c not in own])


def _null_safe(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """An inner join in which null keys match, by way of a key without nulls beside each."""
    other = right.select(*[F.col(c).alias(f"r_{c}") for c in on], *[c for c in right.columns if c not in on])
    matched = [left[c].eqNullSafe(other[f"r_{c}"]) for c in on]
    condition = matched[0]
    for m in matched[1:]:
        condition = condition & m
    return left.join(other, condition).drop(*[f"r_{c}" for c in on])


def mixed_rows(df: DataFrame, **options) -> DataFrame:
    """The mixture itself: every row of df as often as its source's share crosses integers over it."""
    columns = df.columns
    held = df.select(*columns, F.struct(*columns).alias("__row"))
    plan = mix(held, keep=["__row"], **options).where("copies > 0")
    return plan.select("__row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*[F.col("__row")[c].alias(c) for c in columns])
