"""A store of what was fetched for each package version, stamped with the commit it was fetched for.

Items name a key and perhaps the commit that asks. What the store holds is used again or fetched anew by one rule, for
all items of a run in one join; fetches are one call on the keys that need one, and only their buckets are rewritten."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake.operators.events import latest
from cairnlake.sources.bucket_tables import BucketTable
from cairnlake.sources.folders import rewritten


def usable(stored: str, incoming: str, force: bool):
    """Whether a stored row answers an item. Where both have a commit, it does unless the item's is later, whatever
    `force` says. Else one has none: without force it answers items that have none, with force nothing."""
    both = F.col(stored).isNotNull() & F.col(incoming).isNotNull()
    return F.when(both, F.col(incoming) <= F.col(stored)).otherwise(F.lit(False) if force else F.col(incoming).isNull())


@dataclass
class AssetStore:
    """A bucketed table (key, commit, run, data columns) below path; `run` is the number of the run that fetched a row."""

    table: BucketTable
    key: str
    data: list[str]

    @staticmethod
    def at(spark: SparkSession, path: str, key: str, commit_type: str, data: str, buckets: int = 16) -> AssetStore:
        """data: the data columns as a schema, `name type, ...`."""
        own = T.StructType.fromDDL(data)
        schema = T.StructType([*T.StructType.fromDDL(f"`{key}` string, commit {commit_type}, run long"), *own])
        return AssetStore(BucketTable(spark, path, schema, [key], F.col(key), buckets, lambda rows: latest(rows, [key], ["run"])), key, own.names)

    def resolve(self, items: DataFrame, fetch: Callable[[DataFrame], DataFrame], run: int, force: bool = False) -> DataFrame:
        """The items with the data of their keys, `reused` (whether the stored data answered) and `run` (which run fetched it).

        items: the key, `commit` (may be null), and other columns that stay. fetch takes the keys that need data and returns
        the key and data columns; a key it returns nothing for is stored with nulls. Of several items of a key that ask
        for a fetch, the latest commit is the stamp. Runs are numbered upwards; a run that is repeated after a failure fetches
        again what it has not stored. Items without a key are left out."""
        stored = self.table.read().select(self.key, F.col("commit").alias("__commit"), F.col("run").alias("__run"), *[F.col(c).alias(f"__{c}") for c in self.data])
        asked = items.where(F.col(self.key).isNotNull()).join(stored, self.key, "left")
        asked = rewritten(asked.withColumn("reused", F.col("__run").isNotNull() & usable("__commit", "commit", force)))
        wanted = asked.where(~F.col("reused")).groupBy(self.key).agg(F.max("commit").alias("commit"))
        fetched = rewritten(wanted.join(fetch(wanted.select(self.key)).select(self.key, *self.data), self.key, "left").withColumn("run", F.lit(run).cast("long")))
        self.table.append(fetched, f"run-{run}")
        self.table.compact()
        kept = asked.where("reused").select(*items.columns, "reused", F.col("__run").alias("run"), *[F.col(f"__{c}").alias(c) for c in self.data])
        new = asked.where(~F.col("reused")).select(*items.columns, "reused").join(fetched.drop("commit"), self.key)
        return kept.unionByName(new.select(*kept.columns))
