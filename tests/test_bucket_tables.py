import datetime
import os
import random

import pytest
from pyspark.sql import functions as F

from cairnlake.functions.scalars import bucket
from cairnlake.operators import edges, events
from cairnlake.plans.registry import TABLES
from cairnlake.sources import bucket_tables
from cairnlake.sources.bucket_tables import PRUNES, BucketTable
from cairnlake.streaming import incremental

SPEC = TABLES["PackageVulnerabilities"]
DAY = datetime.datetime(2024, 1, 1)


def rows(spark, items):
    """(identity, commit day, scan or None, advisory)"""
    made = [(None if s is None else f"s{s}", None if s is None else DAY + datetime.timedelta(hours=s), i.split("/")[0], i, i.split("/")[0], i.split("/")[1], DAY + datetime.timedelta(days=c), None, "Vulnerable", None, a, 1) for i, c, s, a in items]
    return spark.createDataFrame(made, SPEC.schema)


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet") and "bucket=" in d}


def brute(increments):
    """The whole newest batch of each identity; of equal commits the later scan."""
    best = {}
    for items in increments:
        for i, c, s, a in items:
            if (c, s) > best.get(i, ((-1, -1), None))[0]:
                best[i] = ((c, s), set())
            if (c, s) == best[i][0]:
                best[i][1].add(a)
    return sorted((i, a) for i, (_, own) in best.items() for a in own)


def content(table):
    return sorted((r["Identity"], r["AdvisoryUrl"]) for r in table.read().collect())


def test_increments_equal_a_merge_of_all(spark, tmp_path):
    rng = random.Random(1)
    increments = [[(f"p{rng.randrange(30)}/{rng.randrange(3)}", rng.randrange(4), scan, f"a{rng.randrange(50)}") for _ in range(40)] for scan in range(1, 5)]
    table = BucketTable.of(spark, str(tmp_path / "t"), SPEC, 8)
    assert table.read().count() == 0 and table.compact() == [] and table.metrics().count() == 0
    for k, items in enumerate(increments):
        table.append(rows(spark, items), f"b{k}")
        if k == 1:
            table.append(rows(spark, items), f"b{k}")  # the same batch again
        if k != 2:  # two batches meet in one compaction
            assert table.compact()
    assert content(table) == brute(increments)
    assert all(r["ScanId"] is None for r in table.read().collect())
    got = table.metrics().agg(F.sum("records"), F.sum("raw_bytes")).first()
    assert got[0] == len(brute(increments)) and got[1] > 20 * got[0]
    some = {r["b"] for r in table.read().select(bucket(F.col("Identity"), 8).alias("b")).collect()}
    assert sum(table.read([b]).count() for b in some) == got[0]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    table = BucketTable.of(spark, path, SPEC, 8)
    table.append(rows(spark, [(f"p{i}/1", 1, 1, "a") for i in range(60)]), "one")
    assert table.compact() == list(range(8))
    before = files(path)
    table.append(rows(spark, [("p3/1", 2, 2, "b"), ("p3/1", 2, 2, "c")]), "two")
    changed = table.compact()
    after = files(path)
    own = f"bucket={changed[0]}/"
    assert len(changed) == 1 and {f: t for f, t in before.items() if own not in f} == {f: t for f, t in after.items() if own not in f}
    assert before != after and not os.path.exists(f"{path}/_merged") and os.listdir(f"{path}/_new") == []
    table.append(rows(spark, [("p3/1", 2, 3, "b"), ("p3/1", 2, 3, "c"), ("p9/1", 0, 3, "late")]), "three")  # nothing new
    assert table.compact() == [] and files(path) == after
    table.append(rows(spark, []), "empty")
    assert table.compact() == [] and files(path) == after


@pytest.mark.parametrize("stop", ["_write", "check_unique", "_digests", "after plan", "in replay", "before clearing"])
def test_compaction_that_stops_anywhere_loses_nothing(spark, tmp_path, monkeypatch, stop):
    table = BucketTable.of(spark, str(tmp_path / "t"), SPEC, 4)
    first = [(f"p{i}/1", 1, 1, "a") for i in range(20)]
    second = [(f"p{i}/1", 2, 2, "b") for i in range(0, 20, 3)]
    table.append(rows(spark, first), "one")
    table.compact()
    table.append(rows(spark, second), "two")

    def fail(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        if stop in ("_write", "_digests"):
            m.setattr(BucketTable, stop, fail)
        elif stop == "check_unique":
            m.setattr(bucket_tables.merge, "check_unique", fail)
        elif stop == "after plan":
            calls = []
            real = BucketTable.recover
            m.setattr(BucketTable, "recover", lambda self: fail() if calls else (calls.append(1), real(self)))
        elif stop == "in replay":
            real = BucketTable._write

            def write(self, r, path):
                real(self, r, path)
                if path == self.path:
                    fail()

            m.setattr(BucketTable, "_write", write)
        else:
            m.setattr(bucket_tables, "drop", fail)
        with pytest.raises(RuntimeError):
            table.compact()
    table.append(rows(spark, [("p1/1", 3, 3, "c")]), "three")
    table.compact()
    assert content(table) == brute([first, second, [("p1/1", 3, 3, "c")]])


def test_rules_of_the_registry(spark, tmp_path):
    assert {spec.merge for spec in TABLES.values()} <= set(PRUNES)
    owners = BucketTable.of(spark, str(tmp_path / "o"), TABLES["VerifiedPackages"], 4)
    named = lambda ids: spark.createDataFrame([(None, i, i, True) for i in ids], TABLES["VerifiedPackages"].schema)
    owners.append(named("abcdefgh"), "1")
    owners.compact()
    owners.append(named("ax"), "2")
    owners.compact()
    assert sorted(r["LowerId"] for r in owners.read().collect()) == ["a", "x"]
    owners.append(named("aa"), "3")
    with pytest.raises(ValueError, match="share a key"):
        owners.compact()
    downloads = BucketTable.of(spark, str(tmp_path / "d"), TABLES["PackageDownloads"], 2)
    for k, n in enumerate((5, 9, 7)):
        downloads.append(spark.createDataFrame([(DAY, "a", "a/1", "A", "1", n, n)], TABLES["PackageDownloads"].schema), str(k))
        downloads.compact()
    assert [r["Downloads"] for r in downloads.read().collect()] == [9]
    spec = TABLES["Certificates"]
    fixed = {f.name: {"string": "x", "int": 1, "timestamp": DAY}[f.dataType.simpleString()] for f in spec.schema if not f.nullable}
    row = lambda **k: tuple((fixed | k).get(f.name) for f in spec.schema)
    certs = BucketTable.of(spark, str(tmp_path / "c"), spec, 2)
    hour = lambda n: DAY + datetime.timedelta(hours=n)
    certs.append(spark.createDataFrame([row(Fingerprint="f", ScanTimestamp=hour(1), CodeSigningCommitTimestamp=hour(9), CodeSigningStatus="old scan, late commit"), row(Fingerprint="g", ScanTimestamp=hour(1))], spec.schema), "1")
    certs.compact()
    certs.append(spark.createDataFrame([row(Fingerprint="f", ScanTimestamp=hour(2), CodeSigningCommitTimestamp=hour(3), CodeSigningStatus="early", ChainLength=4), row(Fingerprint="g", ScanTimestamp=hour(2), ResultType="Deleted")], spec.schema), "2")
    assert len(certs.compact()) == len({r["b"] for r in spark.createDataFrame([("f",), ("g",)], "k string").select(bucket(F.col("k"), 2).alias("b")).collect()})
    assert [(r["Fingerprint"], r["CodeSigningStatus"], r["ChainLength"]) for r in certs.read().collect()] == [("f", "old scan, late commit", 4)]


def test_stream_rewrites_only_its_buckets(spark, tmp_path):
    data = [(i % 5, i, f"v{i}") for i in range(40)] + [(7, 100 + i, "w") for i in range(10)]
    src = tmp_path / "in"
    for k in range(5):
        spark.createDataFrame(data[10 * k : 10 * k + 10], "k int, at int, v string").coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("k int, at int, v string").option("maxFilesPerTrigger", 1).parquet(str(src))
    query, table = incremental.merge_bucket_stream(stream, str(tmp_path / "t"), str(tmp_path / "cp"), ["k"], ["at"], 16)
    query.awaitTermination(120)
    assert {tuple(r) for r in table.read().collect()} == {tuple(r) for r in events.latest(spark.createDataFrame(data, "k int, at int, v string"), ["k"], ["at"]).collect()}
    times = {int(f.split("bucket=")[1].split("/")[0]): t for f, t in files(str(tmp_path / "t")).items()}
    own = spark.createDataFrame([("7",)], "k string").select(bucket(F.col("k"), 16)).first()[0]
    others = {spark.createDataFrame([(str(k),)], "k string").select(bucket(F.col("k"), 16)).first()[0] for k in range(5)}
    assert own in others or times[own] != max(t for b, t in times.items() if b != own)


def test_chains_of_repeated_rows(spark):
    made = lambda r: spark.createDataFrame(r, "fingerprint string, issuer_fingerprint string")
    got = edges.chain_roots(made([("a", "b"), ("a", "b"), ("b", "c"), ("b", "c"), ("c", None), (None, "a")]))
    assert sorted(map(tuple, got.collect())) == [("a", "c", 2), ("b", "c", 1), ("c", "c", 0)]
    with pytest.raises(Exception, match="two issuers"):
        edges.chain_roots(made([("a", "b"), ("a", "c")])).collect()
