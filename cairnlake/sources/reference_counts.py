"""How many owners name each subject, kept by the changes of edges alone.

A run brings edges that were added and removed. Only the buckets of their subjects are read and written; all other edges are
never looked at. A stored count knows the last run that it holds, so a run that is repeated after a failure changes nothing."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake.sources.bucket_tables import BucketTable

_ROWS = "subject string, n long, run long, is_change boolean"


def _summed(rows: DataFrame) -> DataFrame:
    """Stored counts and the changes of later runs, one row for each subject; counts below zero are an error."""
    stored, change = ~F.col("is_change"), F.struct("run", "n")
    each = rows.groupBy("subject", "bucket").agg(F.max(F.when(stored, F.col("run"))).alias("last"), F.max(F.when(stored, F.col("n"))).alias("was"), F.max("run").alias("run"), F.collect_set(F.when(F.col("is_change"), change)).alias("changes"))
    later = F.filter("changes", lambda c: F.col("last").isNull() | (c["run"] > F.col("last")))  # a row for each run since the last compaction
    n = F.coalesce("was", F.lit(0)) + F.aggregate(later, F.lit(0).cast("long"), lambda total, c: total + c["n"])
    low = F.raise_error(F.concat(F.lit("more edges were removed than added for "), F.col("subject")))
    return each.withColumn("n", n).withColumn("n", F.when(F.col("n") < 0, low.cast("long")).otherwise(F.col("n"))).select("subject", "n", "run", F.lit(False).alias("is_change"), "bucket")


@dataclass
class ReferenceCounts:
    table: BucketTable

    @staticmethod
    def at(spark: SparkSession, path: str, buckets: int = 16) -> ReferenceCounts:
        return ReferenceCounts(BucketTable(spark, path, T.StructType.fromDDL(_ROWS), ["subject"], F.col("subject"), buckets, _summed))

    def apply(self, changes: DataFrame, run: int) -> list[int]:
        """Counts edges (owner, subject, change: added, removed or kept), each named once, for a run; runs are numbered
        upwards. Returns the buckets that changed. Edges without a subject are left out."""
        step = F.when(F.col("change") == "added", 1).when(F.col("change") == "removed", -1).otherwise(0)
        sums = changes.where(F.col("subject").isNotNull()).groupBy(F.col("subject").cast("string").alias("subject")).agg(F.sum(step).alias("n")).where("n <> 0")
        self.table.append(sums.select("subject", F.col("n").cast("long").alias("n"), F.lit(run).cast("long").alias("run"), F.lit(True).alias("is_change")), f"run-{run}")
        return self.table.compact()

    def counts(self, buckets: list[int] | None = None) -> DataFrame:
        """(subject, n); 0 for subjects that owners named once."""
        return self.table.read(buckets).select("subject", "n")

    def orphans(self, buckets: list[int] | None = None) -> DataFrame:
        """(subject) that no owner is left for, of the buckets that a run changed or of all."""
        return self.counts(buckets).where("n = 0").select("subject")


def deletions(orphans: DataFrame, stored: DataFrame, key: str, scan: str, at) -> DataFrame:
    """The stored rows of orphans as deleted rows of a scan, to be appended to their table, whose rule then drops them."""
    own = stored.join(orphans.select(F.col("subject").alias(key)), key, "left_semi")
    return own.withColumns({"ResultType": F.lit("Deleted"), "ScanId": F.lit(scan), "ScanTimestamp": F.lit(at).cast("timestamp")}).select(*stored.columns)
