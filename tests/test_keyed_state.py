import pytest
from pyspark.sql import functions as F

from cairnlake.operators.events import latest
from cairnlake.streaming.keyed_state import latest_state, latest_state_stream

DDL = "k string, part int, at long, v string"
BATCHES = [
    [("a", 1, 5, "x"), ("a", 1, 4, "old"), ("b", 1, 1, "y"), (None, None, 1, "n"), ("a", 2, 3, None)],
    [("a", 1, 2, "stale"), ("b", 1, 7, "new"), ("b", 1, 7, "newer"), ("c", 1, 1, "z")],
    [("b", 1, 6, "stale"), (None, None, 2, "m")],
]


@pytest.mark.parametrize("provider", ["HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider"])
def test_state_after_restarts_is_the_latest_row(spark, tmp_path, provider):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, f"org.apache.spark.sql.execution.streaming.state.{provider}")
    try:
        source, checkpoint, changes = (str(tmp_path / n) for n in ("in", "checkpoint", "changes"))
        done = []
        for number, rows in enumerate(BATCHES):
            spark.createDataFrame(rows, DDL).coalesce(1).write.mode("append").parquet(source)
            latest_state_stream(spark.readStream.schema(DDL).parquet(source), checkpoint, ["k", "part"], ["at"], changes).awaitTermination()
            done += rows
            want = {tuple(r) for r in latest(spark.createDataFrame(done, DDL), ["k", "part"], ["at", "v"]).select("k", "part", "at", "v").collect()}
            state = latest_state(spark, checkpoint)
            assert state.columns == ["k", "part", "at", "v"]
            assert {tuple(r) for r in state.collect()} == want
            # a batch gives the rows of its own keys, stale ones as the state has them
            out = {tuple(r) for r in spark.read.parquet(f"{changes}/batch={number}").collect()}
            assert out == {w for w in want if w[:2] in {r[:2] for r in rows}}
        first = {tuple(r) for r in latest_state(spark, checkpoint, 0).collect()}
        assert ("a", 1, 5, "x") in first and not [r for r in first if r[0] == "c"]
    finally:
        spark.conf.unset(name)


def test_nothing_new_runs_no_batch(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    spark.createDataFrame(BATCHES[0], DDL).write.parquet(source)
    for _ in range(2):
        run = latest_state_stream(spark.readStream.schema(DDL).parquet(source), checkpoint, ["k", "part"], ["at"])
        run.awaitTermination()
    assert run.lastProgress is None or run.lastProgress["numInputRows"] == 0
    assert latest_state(spark, checkpoint).where(F.col("k") == "a").count() == 2
