import numpy as np

from cairnlake.llm import lattice


def rows_and_truth(seed, n=400, dim=64):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(n // 2, n):
        x[i] = x[rng.integers(0, n // 2)] + 0.02 * rng.normal(size=dim)
    x[10] = x[11]
    x = x.astype(np.float32)
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    label = np.arange(n)
    while True:
        before = label.copy()
        i, j = np.nonzero(near)
        np.minimum.at(label, i, label[j])
        if (label == before).all():
            return x, near.sum(1), label


def test_links_and_components(spark):
    x, degree, label = rows_and_truth(1)
    df = spark.createDataFrame([(i, v.tolist(), "c") for i, v in enumerate(x)], "vec_id long, embedding array<float>, cell string")
    got = {r["vec_id"]: r for r in lattice.near_vectors(df).collect()}
    found = sum(r["n_links"] for r in got.values())
    assert all(got[i]["n_links"] <= degree[i] for i in got)
    assert found >= 0.9 * degree.sum()
    assert sum(got[i]["component_id"] == label[i] for i in got) >= 0.95 * len(x)
    assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_crowded_cells_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(lattice, "TILE", 16)
    rng = np.random.default_rng(3)
    base = rng.normal(size=32)
    x = base + 0.01 * rng.normal(size=(150, 32))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = lattice.near_vectors(df).collect()
    assert all(r["component_id"] == 0 for r in got)
    assert sum(r["n_links"] for r in got) == 150 * 149


def test_odd_vectors_stay_alone(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [None, [], [0.0, 0.0], [1.0, None], [1.0, nan], [inf, 1.0], [1.0, 1.0], [2.0, 2.0], [1.0, 1.0], [1.0, 1.0, 1.0]]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)] + [(None, [1.0, 1.0])], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in lattice.near_vectors(df).collect()}
    assert all(got[i] == (0, i) for i in (0, 1, 2, 3, 4, 5, 9))
    assert all(got[i] == (2, 6) for i in (6, 7, 8))
    assert got[None] == (0, None)
    assert lattice.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_decoder_finds_the_nearest_point():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 8)) * 2
    point = lattice.nearest_e8(x)
    own = ((x - point) ** 2).sum(1)
    around = ((x[:, None] - (point[:, None] + lattice.shortest()[None])) ** 2).sum(2).min(1)
    assert (own <= around + 1e-9).all() and len(lattice.shortest()) == 240
