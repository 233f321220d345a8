"""Which buckets to process again in a tumbling window, and which runs to keep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def due_buckets(buckets: DataFrame, window_start, due_up_to: int, most: int = 50) -> DataFrame:
    """Buckets not processed in the current window and due by now, the longest waiting first."""
    stale = buckets.where(F.col("last_processed").isNull() | (F.col("last_processed") < window_start))
    return stale.where(F.col("bucket") <= due_up_to).orderBy(F.col("last_processed").asc_nulls_first(), "bucket").limit(most)


def newest_runs(runs: DataFrame, keep: int, partition: list[str], at: str) -> DataFrame:
    """The last runs of each partition."""
    order = Window.partitionBy(*partition).orderBy(F.desc(at))
    return runs.withColumn("__nth", F.row_number().over(order)).where(F.col("__nth") <= keep).drop("__nth")
