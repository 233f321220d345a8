import os

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.sources import ledger as module
from cairnlake.sources.ledger import Ledger


def files(path):
    return sorted((os.path.join(d, f), os.stat(os.path.join(d, f)).st_mtime_ns) for d, _, names in os.walk(path) for f in names)


@pytest.fixture
def made(spark):
    def of(age, inputs=None):
        rows = spark.createDataFrame([(age, k) for k in range(3)], "age int, k int")
        return {name: (inputs or str(age), lambda: rows) for name in ("a", "b")}

    return of


def ages(ledger):
    return {name: {r["age"] for r in df.collect()} for name, df in ledger.tables().items()}



def test_states_of_a_run(spark, tmp_path, made):
    ledger, gate = Ledger(spark, str(tmp_path / "l")), ("a", "age", F.lit(-1))
    assert ledger.tables() == {} and ledger.publish(made(1), gate=gate) == "Published"
    before = files(tmp_path)
    assert ledger.publish(made(9, "1"), gate=gate) == "Unchanged" and files(tmp_path) == before
    assert ledger.publish(made(0), gate=gate) == "Older" and ages(ledger) == {"a": {1}, "b": {1}} and files(tmp_path) == before
    differ = {"odd ages": lambda t: t["a"].where("age = 2"), "fine": lambda t: t["b"].where("age < 0")}
    assert ledger.publish(made(2), differ, gate) == "Failed: odd ages" and ages(ledger) == {"a": {1}, "b": {1}}
    old = ledger.tables()
    assert ledger.publish(made(3), differ, gate) == "Published" and ages(ledger) == {"a": {3}, "b": {3}}
    assert {r["age"] for r in old["b"].collect()} == {1}  # a reader of the last set goes on
    only = {"b": made(5)["b"]}
    assert ledger.publish(only, gate=("b", "age", F.lit(-1))) == "Published" and ages(ledger) == {"a": {3}, "b": {5}}
    ledger.create_views("led_")
    assert spark.sql("select max(age) m from led_b").first()["m"] == 5
    assert len(os.listdir(tmp_path / "l" / "pointers")) == 2


@pytest.mark.parametrize("stop", range(1, 8))
def test_a_stop_at_any_step_leaves_one_age(spark, tmp_path, made, monkeypatch, stop):
    ledger = Ledger(spark, str(tmp_path / "l"))
    ledger.publish(made(1))
    steps = []

    def counted(real):
        def run(*a, **k):
            steps.append(1)
            if len(steps) == stop:
                raise RuntimeError("stopped")
            return real(*a, **k)

        return run

    with monkeypatch.context() as m:
        m.setattr(module, "drop", counted(module.drop))
        m.setattr(Ledger, "_version", counted(Ledger._version))
        m.setattr(type(spark), "createDataFrame", counted(type(spark).createDataFrame))
        m.setattr(DataFrame, "coalesce", counted(DataFrame.coalesce))
        try:
            ledger.publish(made(2), {"none": lambda t: t["a"].where("false")})
        except RuntimeError:
            pass
    assert ages(ledger) in ({"a": {1}, "b": {1}}, {"a": {2}, "b": {2}})
    os.makedirs(tmp_path / "l" / "pointers" / "p=99")  # a pointer that was never committed
    assert ages(ledger) in ({"a": {1}, "b": {1}}, {"a": {2}, "b": {2}})
    assert ledger.publish(made(3)) == "Published" and ages(ledger) == {"a": {3}, "b": {3}}
