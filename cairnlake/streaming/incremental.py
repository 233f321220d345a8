"""Incremental processing: named cursors, bounded batch runs, and merging streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.operators.events import in_bounds, latest
from cairnlake.operators.merge import upsert_latest
from cairnlake.sources.bucket_tables import BucketTable


class Cursors:
    """High-water marks by name, kept as a small append-only table; the newest row of a name counts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _rows(self) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], "name string, value long")
        return self.spark.read.schema("name string, value long").parquet(self.path)

    def get(self, name: str, default: int) -> int:
        value = self._rows().where(F.col("name") == name).agg(F.max("value")).first()[0]
        return default if value is None else value

    def advance(self, name: str, value: int) -> None:
        """Cursors never move back."""
        if value > self.get(name, value - 1):
            self.spark.createDataFrame([(name, value)], "name string, value long").write.mode("append").parquet(self.path)


def run_once(cursors: Cursors, name: str, events: DataFrame, at: str, depends_on: list[str], step: Callable[[DataFrame], None], start: int = 0, given_max: int | None = None, enabled: bool = True) -> str:
    """Processes the events after the cursor of `name`, up to the given maximum or to what all runs it depends on have
    done (without such runs: to the last event there is), and moves the cursor. Returns the state of the run.

    A maximum beyond what there is would move the cursor past events that come later, so the run is blocked until
    they are there; so is one that depends on a run which has not started."""
    if not enabled:
        return "Disabled"
    low = cursors.get(name, start)
    reached = [cursors.get(d, start) for d in depends_on]
    source = min(reached) if reached else events.agg(F.max(at)).first()[0]
    if reached and source <= start:
        return "BlockedByDependency"
    source = start if source is None else source
    high = source if given_max is None else given_max
    if high == low:
        return "FullyCaughtUpWithMax" if given_max is not None else "FullyCaughtUpWithDependency"
    if high > source:
        return "BlockedByDependency"
    if high < low:
        return "MinAfterMax"
    step(events.where(in_bounds(F.col(at), low, high)))
    cursors.advance(name, high)
    return "NewStarted"


def closure(dependencies: dict[str, list[str]], wanted: list[str]) -> list[str]:
    """The wanted names and all that they depend on, dependencies first and otherwise by name."""
    depth: dict[str, int] = {}

    def visit(name: str, above: tuple[str, ...]) -> int:
        if name in above:
            raise ValueError(f"{name} depends on itself")
        if name not in dependencies:
            raise ValueError(f"unknown name {name}")
        if name not in depth:
            depth[name] = 1 + max((visit(d, (*above, name)) for d in dependencies[name]), default=-1)
        return depth[name]

    for name in wanted:
        visit(name, ())
    return sorted(depth, key=lambda n: (depth[n], n))


def run_all(cursors: Cursors, dependencies: dict[str, list[str]], wanted: list[str], events: DataFrame, at: str, steps: dict[str, Callable[[DataFrame], None]], **options) -> dict[str, str]:
    """Runs the wanted names and all that they depend on, each after those it depends on and up to where these have come. Returns the
    state of each run, in their order. A step that fails ends the runs; those before it keep their cursors, and a repeat goes on there."""
    return {name: run_once(cursors, name, events, at, dependencies[name], steps[name], **options) for name in closure(dependencies, wanted)}


def merge_latest_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str], at: str):
    """Keeps the latest row of each key of a stream in numbered versions of a table below path.

    Each micro-batch is reduced to its latest rows, merged with the version of the batch before and written as its
    own version, so a batch that is repeated after a failure gives the same version again."""
    spark = stream.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        new = latest(batch, keys, [at, *[c for c in batch.columns if c not in (*keys, at)]])
        if number:
            new = upsert_latest(spark.read.schema(batch.schema).parquet(f"{path}/v={number - 1}"), new, keys, at)
        new.write.mode("overwrite").parquet(f"{path}/v={number}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def merge_bucket_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str], at: list[str], buckets: int):
    """Keeps the latest row of each key of a stream in a bucketed table, of which a batch rewrites only the buckets that
    its keys fall into. A batch that is repeated after a failure leaves the table as it is."""
    prune = lambda rows: latest(rows, keys, at)
    table = BucketTable(stream.sparkSession, path, stream.schema, keys, F.concat_ws("/", *[F.col(k).cast("string") for k in keys]), buckets, prune)

    def step(batch: DataFrame, number: int) -> None:
        table.append(latest(batch, keys, at), f"batch-{number}")
        table.compact()

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    return query, table
