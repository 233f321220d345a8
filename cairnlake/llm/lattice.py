"""Near-duplicate vectors by lattice hashing.

Each of several tables projects a vector to two blocks of eight random directions and decodes each block to the
nearest point of the E8 lattice; the two points are the vector's home cell. It also probes the cells that the
next nearest lattice points of either block give. Vectors that meet in a cell, one of them at home there,
are compared by cosine in double precision.

Equal vectors are one point with a number of copies. Cells with one vector are dropped before any vector is
moved; a crowded cell is cut into tiles of pairs of blocks, so no task holds a whole cell. A pair that meets more
than once counts where it meets first, so links are counted without being listed."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.llm.common import components, mix64, shuffle_partitions, smallest_reachable, written

TABLES, BLOCKS, PROBES = 6, 2, 2
SCALE = 2.0
TILE = 512
SEED = 20240229


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even coordinate sum (the lattice D8)."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(-1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(-1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8, the union of D8 and D8 shifted by one half."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    return np.where((((x - whole) ** 2).sum(-1) <= ((x - half) ** 2).sum(-1))[:, None], whole, half)


@functools.cache
def shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps to neighbouring lattice points."""
    steps = []
    for i in range(8):
        for j in range(i):
            for a in (-1, 1):
                for b in (-1, 1):
                    step = np.zeros(8)
                    step[i], step[j] = a, b
                    steps.append(step)
    for signs in range(256):
        step = np.array([0.5 if signs >> k & 1 else -0.5 for k in range(8)])
        if (step < 0).sum() % 2 == 0:
            steps.append(step)
    return np.array(steps)


@functools.cache
def _directions(dim: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED + dim)
    return rng.standard_normal((dim, TABLES * BLOCKS * 8)) / SCALE, rng.random(TABLES * BLOCKS * 8)


def _point_hash(points: np.ndarray, place: int) -> np.ndarray:
    """A hash of lattice points (last axis) for one block of one table."""
    twice = np.rint(points * 2).astype(np.int64).view(np.uint64)
    out = np.full(points.shape[:-1], place + 1, np.uint64)
    for k in range(8):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + twice[..., k])
    return out


def cells(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home cells (n, TABLES) and probed cells (n, TABLES, BLOCKS * PROBES) of unit vectors."""
    n, dim = unit.shape
    directions, shift = _directions(dim)
    projected = unit @ directions + shift
    home = np.zeros((n, TABLES), np.uint64)
    probed = np.zeros((n, TABLES, BLOCKS * PROBES), np.uint64)
    steps = shortest()
    for t in range(TABLES):
        own, near = [], []
        for b in range(BLOCKS):
            place = t * BLOCKS + b
            x = projected[:, 8 * place : 8 * place + 8]
            point = nearest_e8(x)
            best = np.argpartition(-((x - point) @ steps.T), PROBES, axis=1)[:, :PROBES]
            own.append(_point_hash(point, place))
            near.append(_point_hash(point[:, None, :] + steps[best], place))
        everything = sum(own[1:], own[0])
        home[:, t] = mix64(everything + np.uint64(dim))
        for b in range(BLOCKS):
            probed[:, t, b * PROBES : (b + 1) * PROBES] = mix64((everything - own[b])[:, None] + near[b] + np.uint64(dim))
    return home, probed


def _units(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row indices, unit vectors in double precision) for each dimension that occurs."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        x = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dim)
        x = x / np.abs(x).max(1, keepdims=True)
        yield rows, x / np.sqrt((x * x).sum(1, keepdims=True))


def _addresses(points: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for rows, unit in _units(batch.column(1)):
                for a in range(0, len(rows), 4096):
                    own = ids[rows[a : a + 4096]]
                    home, probed = cells(unit[a : a + 4096])
                    every = np.concatenate([home, probed.reshape(len(own), -1)], 1)
                    at_home = np.zeros(every.shape, bool)
                    at_home[:, :TABLES] = True
                    yield pa.RecordBatch.from_arrays([pa.array(every.ravel().view(np.int64)), pa.array(np.repeat(own, every.shape[1])), pa.array(at_home.ravel())], ["cell", "rep", "home"])

    return points.select("rep", "embedding").mapInArrow(run, "cell bigint, rep bigint, home boolean")


def _first_meeting(home: np.ndarray, probed: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For pairs of rows, the cell where they meet first by table, and by number where two cells do."""
    out = np.zeros(len(i), np.uint64)
    open_ = np.ones(len(i), bool)
    top = np.uint64(2**64 - 1)
    for t in range(home.shape[1]):
        a, b = home[i, t], home[j, t]
        to_b = (probed[i, t] == b[:, None]).any(1)
        to_a = (probed[j, t] == a[:, None]).any(1)
        same = a == b
        cell = np.where(same, a, np.minimum(np.where(to_b, b, top), np.where(to_a, a, top)))
        new = open_ & (same | to_a | to_b)
        out[new] = cell[new]
        open_ &= ~new
    return out


def _meetings(tiles: DataFrame, threshold: float) -> DataFrame:
    """Rows (a, null, n): a has n links found here, copies counted. Rows (a, b, null): a forest of links."""

    def solve(cell, members, ids, copies, unit, home, probed, at_home, block, low, high):
        own, mine = ids[members], at_home[members]
        u = unit[members]
        side = block[members]
        left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
        near = u[left] @ u[right].T >= threshold
        near &= mine[left][:, None] | mine[right][None, :]
        if low == high:
            near &= left[:, None] < right[None, :]
        i, j = np.nonzero(near)
        i, j = left[i], right[j]
        here = _first_meeting(home, probed, members[i], members[j]) == np.uint64(cell & (2**64 - 1))
        i, j = i[here], j[here]
        if not len(i):
            return
        weight = copies[members]
        counts = np.bincount(i, weight[j], len(members)) + np.bincount(j, weight[i], len(members))
        some = np.flatnonzero(counts)
        yield own[some], None, counts[some].astype(np.int64)
        label = smallest_reachable(len(members), i, j)
        tied = np.flatnonzero(label != np.arange(len(members)))
        yield own[tied], own[label[tied]], None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        ids, copies = rows["rep"].to_numpy(), rows["copies"].to_numpy().astype(np.float64)
        at_home, block = rows["home"].to_numpy(zero_copy_only=False), rows["block"].to_numpy()
        group = np.stack([rows["cell"].to_numpy(), rows["low"].to_numpy(), rows["high"].to_numpy()], 1)
        for place, unit in _units(rows["embedding"]):
            home = np.zeros((len(place), TABLES), np.uint64)
            probed = np.zeros((len(place), TABLES, BLOCKS * PROBES), np.uint64)
            for a in range(0, len(place), 4096):
                home[a : a + 4096], probed[a : a + 4096] = cells(unit[a : a + 4096])
            own = group[place]
            order = np.lexsort((own[:, 2], own[:, 1], own[:, 0]))
            sorted_ = own[order]
            at = np.flatnonzero(np.concatenate([[True], (sorted_[1:] != sorted_[:-1]).any(1)]))
            for a, b in zip(at, np.append(at[1:], len(order))):
                if b - a < 2:
                    continue
                cell, low, high = (int(x) for x in sorted_[a])
                for x, y, n in solve(cell, order[a:b], ids[place], copies[place], unit, home, probed, at_home[place], block[place], low, high):
                    none = pa.nulls(len(x), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array(x), none if y is None else pa.array(y), none if n is None else pa.array(n)], ["a", "b", "n"])

    return tiles.mapInArrow(run, "a bigint, b bigint, n bigint")


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: not null, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(df: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id_col, n_links, component_id, kept) of every row.

    Vectors that are null, zero or hold null or non-finite components, and rows without an id, have no
    links and are their own component. Repeated rows link each other; ties do not arise, as links depend on
    the pair alone. Vectors of different dimension never link."""
    n = shuffle_partitions(df.sparkSession)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("embedding"))
    rows = rows.withColumn("embedding", F.when(usable(F.col("embedding")) & F.col("id").isNotNull(), F.col("embedding")))
    points = written(rows.where("embedding is not null").groupBy("embedding").agg(F.min("id").alias("rep"), F.count("*").alias("copies")))
    addresses = _addresses(points.repartition(n))
    crowded = addresses.groupBy("cell").agg(F.count("*").alias("g"), F.max("home").alias("any")).where("g > 1 and any").select("cell", "g")
    members = addresses.join(crowded, "cell").withColumn("blocks", F.ceil(F.col("g") / TILE).cast("long"))
    members = members.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    tiles = members.select("cell", "rep", "home", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    met = written(_meetings(tiles.join(points, "rep").repartition(n, "cell", "low", "high"), threshold))
    links = met.where("n is not null").groupBy("a").agg(F.sum("n").alias("found"))
    joined = components(met.where("b is not null").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    known = points.join(links, points["rep"] == links["a"], "left").join(joined, points["rep"] == joined["id"], "left")
    known = known.select(F.col("embedding").alias("point"), "rep", (F.coalesce("found", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    out = rows.join(known, rows["embedding"] == known["point"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
