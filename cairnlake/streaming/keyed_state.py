"""The latest row of each key as the state of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def latest_state_stream(stream: DataFrame, checkpoint: str, keys: list[str], at: list[str], changes: str | None = None) -> StreamingQuery:
    """Keeps the latest row of each key of a stream in its state store, below checkpoint; the rest of a row breaks ties of `at`.

    A batch reads and writes the state of its own keys alone; rows older than what the state holds change nothing, whenever
    they come. It is an aggregation with partial maxima before the shuffle, so no Python worker takes part. With `changes`, each batch
    writes the rows of its keys there as batch=N, over what an earlier try of the batch left.

    The number of state partitions is that of shuffle partitions at the first start. For more keys than executors hold in memory, set
    spark.sql.streaming.stateStore.providerClass to the RocksDB provider before it."""
    rest = [c for c in stream.columns if c not in (*keys, *at)]
    kept = stream.groupBy(*keys).agg(F.max(F.struct(*at, *rest)).alias("row"))

    def step(batch: DataFrame, number: int) -> None:
        if changes is not None:
            batch.select(*keys, "row.*").write.mode("overwrite").parquet(f"{changes}/batch={number}")
        else:
            batch.write.format("noop").mode("overwrite").save()

    return kept.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_state(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The rows that the state of such a stream holds, read from its checkpoint; after a given batch, or the last one."""
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    state = reader.load(checkpoint)
    row = state.schema["value"].dataType.names[0]
    return state.select("key.*", F.col("value")[row].alias("row")).select("*", "row.*").drop("row")
