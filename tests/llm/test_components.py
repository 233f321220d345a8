import random

import pytest

from cairnlake.llm import common


@pytest.mark.parametrize("share", [3, 2_000_000])
def test_components_of_chains_stars_and_cycles(spark, monkeypatch, share):
    monkeypatch.setattr(common, "SHARE", share)
    rng = random.Random(1)
    order = list(range(100, 160))
    rng.shuffle(order)
    edges = list(zip(order, order[1:])) + [(7, i) for i in range(10, 30)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    found = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {i: 100 for i in order} | {i: 7 for i in [7, *range(10, 30)]} | {200: 200, 201: 200, 202: 200}
    assert common.components(spark.createDataFrame([], "src long, dst long")).count() == 0
