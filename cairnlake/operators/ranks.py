"""Ranks, latest flags and the content budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest_flags(df: DataFrame, partition: list[str], order: list[Column], flags: dict[str, Column], rank: str = "SemVerOrder") -> DataFrame:
    """A 0-based rank by ascending order, and for each flag whether a row is the greatest of those that meet its
    condition. Rank and flags share one sort."""
    df = df.withColumn(rank, F.row_number().over(Window.partitionBy(*partition).orderBy(*order)) - 1)
    everything = Window.partitionBy(*partition)
    for name, condition in flags.items():
        best = F.max(F.when(condition, F.col(rank))).over(everything)
        df = df.withColumn(name, F.coalesce(F.col(rank) == best, F.lit(False)))
    return df


def content_budget(files: DataFrame, package: list[str], extension: str, order: list[str], size: str, digest: str, per_file: int = 16384, per_extension: int = 16384) -> DataFrame:
    """How much of each file's content is kept: (is_duplicate, kept_size, truncated, package_truncated).

    Files of one extension share a budget in the given order; files whose digest occurred before in the package keep
    nothing and cost nothing. What is left for a file is the budget less the full sizes of those before it."""
    first = F.row_number().over(Window.partitionBy(*package, digest).orderBy(*order)) == 1
    df = files.withColumn("is_duplicate", ~first)
    cost = F.when(F.col("is_duplicate"), 0).otherwise(F.col(size))
    before = Window.partitionBy(*package, extension).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    left = F.greatest(F.lit(0), F.lit(per_extension) - F.coalesce(F.sum(cost).over(before), F.lit(0)))
    kept = F.when(F.col("is_duplicate"), 0).otherwise(F.least(F.col(size), F.lit(per_file), left))
    df = df.withColumn("kept_size", kept.cast("long")).withColumn("truncated", ~F.col("is_duplicate") & (F.col("kept_size") < F.col(size)))
    return df.withColumn("package_truncated", F.bool_or("truncated").over(Window.partitionBy(*package)))


def cut_text(text: Column, size: Column) -> Column:
    """The first `size` bytes of a text without a partial character at the end."""
    data = F.substring(text.cast("binary"), F.lit(1), size.cast("int"))
    trimmed = data
    for back in (1, 2, 3):  # a lead byte near the end whose character is not whole
        at = F.length(data) - back + 1
        lead = F.conv(F.hex(F.substring(data, at, F.lit(1))), 16, 10).cast("int")
        need = F.when(lead >= 0xF0, 4).when(lead >= 0xE0, 3).when(lead >= 0xC0, 2).otherwise(1)
        trimmed = F.when((F.length(data) >= back) & (need > back), F.substring(data, F.lit(1), F.length(data) - back)).otherwise(trimmed)
    return F.decode(trimmed, "UTF-8")
