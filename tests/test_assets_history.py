import datetime
import random

import pytest

from cairnlake.operators import events
from cairnlake.sources.asset_store import AssetStore

CASES = [  # force, stored commit, incoming commit, reused
    (False, None, None, True), (False, 5, None, True), (False, None, 5, False), (False, 5, 4, True), (False, 5, 5, True), (False, 5, 6, False),
    (True, None, None, False), (True, 5, None, False), (True, None, 5, False), (True, 5, 4, True), (True, 5, 5, True), (True, 5, 6, False),
]


@pytest.mark.parametrize("force", [False, True])
def test_all_cases_of_reuse(spark, tmp_path, force):
    own = [c for c in CASES if c[0] == force]
    store = AssetStore.at(spark, str(tmp_path / "s"), "id", "long", "v string", 4)
    asked = []

    def fetch(run):
        def of(keys):
            asked.append(sorted(r["id"] for r in keys.collect()))
            return keys.where("id <> 'gone'").selectExpr("id", f"concat(id, '@{run}') as v")

        return of

    first = spark.createDataFrame([(str(i), c[1]) for i, c in enumerate(own)], "id string, commit long")
    assert store.resolve(first, fetch(1), 1, force).where("reused").count() == 0
    second = spark.createDataFrame([(str(i), c[2], "kept") for i, c in enumerate(own)] + [("new", 1, ""), ("gone", 1, ""), (None, 1, "")], "id string, commit long, extra string")
    got = {r["id"]: r for r in store.resolve(second, fetch(2), 2, force).collect()}
    for i, (_, _, _, reused) in enumerate(own):
        assert (got[str(i)]["reused"], got[str(i)]["run"], got[str(i)]["v"], got[str(i)]["extra"]) == (reused, 1 if reused else 2, f"{i}@{1 if reused else 2}", "kept")
    assert got["new"]["v"] == "new@2" and got["gone"]["v"] is None and got["gone"]["run"] == 2 and None not in got
    assert asked[1] == sorted(["new", "gone", *[str(i) for i, c in enumerate(own) if not c[3]]])
    again = store.resolve(spark.createDataFrame([("gone", 1), ("gone", 0)], "id string, commit long"), fetch(3), 3, force).collect()
    assert [(r["reused"], r["run"]) for r in again] == [(True, 2)] * 2  # that nothing was found is known, too
    stamped = {r["id"]: (r["commit"], r["run"]) for r in store.table.read().collect()}
    assert stamped["new"] == (1, 2) and len(stamped) == len(own) + 2


def test_several_items_of_a_key_fetch_once(spark, tmp_path):
    store = AssetStore.at(spark, str(tmp_path / "s"), "id", "long", "v string", 4)
    items = spark.createDataFrame([("a", c) for c in (3, 9, None, 4)], "id string, commit long")
    out = store.resolve(items, lambda keys: keys.selectExpr("id", "'x' as v"), 1).collect()
    assert len(out) == 4 and {r["v"] for r in out} == {"x"} and store.table.read().first()["commit"] == 9
    assert store.resolve(items, lambda keys: keys.selectExpr("id", "'y' as v"), 2).where("reused and v = 'x'").count() == 4


def day(n):
    return datetime.datetime(2020, 1, 1) + datetime.timedelta(days=n)


def brute(history, facts, moments):
    born = {}
    for k, p, c in history:
        born[k, p] = min(c, born.get((k, p), c))
    out = []
    for m in moments:
        own = [(k, p, n) for a, k, p, n in facts if a == m]
        named = {(k, p) for k, p, _ in own}
        kept = [(k, p, n) for k, p, n in own if born.get((k, p), 10**9) <= m]
        total = {}
        for k, _, n in kept:
            total[k] = total.get(k, 0) + n
        out += [(m, k, p, n, total[k]) for k, p, n in kept]
        out += [(m, k, p, 0, total[k]) for (k, p), c in born.items() if k in total and c <= m and (k, p) not in named]
        checked = {k for k, _, _ in own}
        alive = {k for (k, _), c in born.items() if c <= m}
        out += [(m, k, p, 0, 0) for k, p in born if k in alive and k not in checked]
    return sorted(out)


@pytest.mark.parametrize("width", [3, 40, 5000])
def test_backfill_equals_a_loop(spark, width):
    rng = random.Random(width)
    history = [(f"k{rng.randrange(8)}", f"p{rng.randrange(4)}", rng.randrange(100)) for _ in range(60)]
    moments = [5, 6, 30, 55, 99, 140]
    facts = list({(m, k, p): (m, k, p, n) for m, k, p, n in ((rng.choice(moments[:-1]), f"k{rng.randrange(10)}", f"p{rng.randrange(5)}", rng.randrange(1, 9)) for _ in range(40))}.values())
    h = spark.createDataFrame([(k, p, day(c)) for k, p, c in history], "key string, part string, created timestamp_ntz")
    f = spark.createDataFrame([(day(m), k, p, n) for m, k, p, n in facts], "as_of timestamp_ntz, key string, part string, n long")
    m = spark.createDataFrame([(day(x),) for x in [*moments, moments[0]]], "as_of timestamp_ntz")
    out = events.backfill(h, f, m, "key", "part", "n", width * 86400)
    got = sorted(((r["as_of"] - day(0)).days, r["key"], r["part"], r["n"], r["total"]) for r in out.collect())
    assert got == brute(history, facts, moments)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert events.existing_at(m.limit(0), h, "key", 100).count() == 0
