import datetime
import random

import pytest
from pyspark.sql import functions as F

from cairnlake.operators import edges
from cairnlake.plans.registry import TABLES
from cairnlake.sources.bucket_tables import BucketTable
from cairnlake.sources.reference_counts import ReferenceCounts, deletions

EDGE = "owner string, subject string"


def test_random_histories_equal_a_recount(spark, tmp_path):
    rng = random.Random(6)
    kept = ReferenceCounts.at(spark, str(tmp_path / "r"), 4)
    now, named = set(), set()
    for run in range(1, 5):
        new = {(f"o{rng.randrange(6)}", f"s{rng.randrange(9)}") for _ in range(rng.choice([3, 25]))}
        changes = edges.edge_changes(spark.createDataFrame(sorted(now), EDGE), spark.createDataFrame(sorted(new), EDGE), ["owner", "subject"])
        changed = kept.apply(changes, run)
        if run % 2:
            assert kept.apply(changes, run) == []  # the same run again
        now, named = new, named | {s for _, s in new}
        assert {r["subject"]: r["n"] for r in kept.counts().collect()} == {s: sum(x == s for _, x in now) for s in named}
        gone = {r["subject"] for r in kept.orphans().collect()}
        assert gone == named - {s for _, s in now} and {r["subject"] for r in kept.orphans(changed).collect()} <= gone
    assert kept.apply(spark.createDataFrame([("o", None, "added"), ("o", "s1", "kept")], EDGE + ", change string"), 9) == []
    with pytest.raises(Exception, match="more edges were removed"):
        kept.apply(spark.createDataFrame([("o", "never", "removed")], EDGE + ", change string"), 10)


def test_orphans_leave_the_certificates(spark, tmp_path):
    spec, day = TABLES["Certificates"], datetime.datetime(2024, 1, 1)
    fixed = {f.name: {"string": "x", "int": 1, "timestamp": day}[f.dataType.simpleString()] for f in spec.schema if not f.nullable}
    row = lambda name: tuple((fixed | {"Fingerprint": name, "ScanTimestamp": day}).get(f.name) for f in spec.schema)
    table = BucketTable.of(spark, str(tmp_path / "c"), spec, 2)
    table.append(spark.createDataFrame([row("s1"), row("s2")], spec.schema), "1")
    table.compact()
    kept = ReferenceCounts.at(spark, str(tmp_path / "r"), 2)
    change = lambda rows: spark.createDataFrame(rows, EDGE + ", change string")
    kept.apply(change([("a", "s1", "added"), ("b", "s1", "added"), ("a", "s2", "added")]), 1)
    changed = kept.apply(change([("a", "s1", "removed"), ("a", "s2", "removed")]), 2)
    table.append(deletions(kept.orphans(changed), table.read(), "Fingerprint", "clean", day + datetime.timedelta(days=1)), "2")
    table.compact()
    assert [r["Fingerprint"] for r in table.read().select("Fingerprint").where(F.lit(True)).collect()] == ["s1"]
