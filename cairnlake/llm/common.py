"""Helpers that the operators of this subpackage share: Arrow blocks, written tables, components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which every executor can reach.

    Where the setting is missing, a session whose executors run in the driver's own process, as in tests, gets a
    temporary folder as its setting; any cluster is refused, because its machines do not share one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="cairnlake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


#: Folders of the tables written so far, for release().
_folders: list[str] = []


def written(df: DataFrame, path: str | None = None) -> DataFrame:
    """df written as Parquet to the shared folder and read again: lineage ends there, and a lost
    executor costs no recomputation of what lies before. The table stays until release()."""
    spark = df.sparkSession
    if path is None:
        path = shared_dir(spark)
        _folders.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, keep: int = 0) -> None:
    """Deletes the tables that written() made, but for the last `keep`. Results that were not consumed yet read
    from these tables, so call it when they have been."""
    old = _folders[: len(_folders) - keep]
    del _folders[: len(old)]
    for path in old:
        drop_path(spark, path)


def forget(spark: SparkSession) -> None:
    """Has the driver's JVM collect its garbage. Only then does Spark let go of the shuffle files, broadcasts and plans of
    rounds that are over; a loop of many small rounds otherwise keeps them all."""
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Bounds the Arrow batches of the session by bytes: rows are texts and archives of any length, and a
    worker and its executor each hold a batch."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(re.match(r"-?\d+", spark.conf.get(name))[0]) != most:
        spark.conf.set(name, str(most))


def drop_path(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 row offsets into them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_blocks(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.Table]:
    """The same rows in blocks of about `most` text bytes; a longer text is a block of its own."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        row, used = 0, 0
        while row < batch.num_rows:
            stop = int(np.searchsorted(ends, used + most - size, side="right"))
            if stop <= row:
                if held:
                    yield pa.Table.from_batches(held)
                    held, size = [], 0
                    continue
                stop = row + 1
            held.append(batch.slice(row, stop - row))
            size += int(ends[stop - 1]) - used
            row, used = stop, int(ends[stop - 1])
            if size >= most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Flat indices of the ranges [start, start + length), one after the other."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scramble of 64-bit numbers (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def smallest_reachable(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n numbered points, the smallest that the pairs (i, j) reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, before[i], low)
        np.minimum.at(label, before[j], low)
        label = label[label]
        if (label == before).all():
            return label


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in the undirected edges (src, dst); component is the smallest id
    that can be reached.

    Alternating star contraction: every round links the larger neighbours of a node, then the smaller
    ones, to its smallest neighbour. A round is two aggregations with map-side combine and two joins
    that adaptive execution may split, so a hub costs no single task its whole neighbourhood. Before each round
    every task ties together what a share of at most about SHARE edges reaches; where one share holds all edges, that
    already is the result. Earlier rounds are deleted. Rounds go on until every node is linked to the
    smallest of its component alone."""
    now, path = _rewritten(_oriented(edges), None)
    while True:
        forget(now.sparkSession)
        shares = -(-now.count() // SHARE)
        now, path = _rewritten(_contracted(now.coalesce(max(1, shares))), path)
        if shares <= 1 or _are_stars(now):
            break
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        # the node itself stays linked to its smallest neighbour
        own = least.where("m < u").select(F.col("u").alias("a"), F.col("m").alias("b"))
        star = large.unionAll(own).where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        small = star.join(low, "u")
        small = small.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        now, path = _rewritten(_oriented(small.select(F.col("a").alias("src"), F.col("b").alias("dst"))), path)
    _folders.append(path)
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(roots)


#: Edges that one task ties together.
SHARE = 2_000_000


def _rewritten(df: DataFrame, old: str | None) -> tuple[DataFrame, str]:
    """df written to a new shared folder, and that folder; the folder it was made from goes."""
    path = shared_dir(df.sparkSession)
    out = written(df, path)
    if old:
        drop_path(df.sparkSession, old)
    return out, path


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct()


def _contracted(edges: DataFrame) -> DataFrame:
    """What the edges of each partition reach, as stars around the smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        u, v = (np.concatenate([b.column(k).to_numpy() for b in held]) for k in (0, 1))
        ids, place = np.unique(np.concatenate([u, v]), return_inverse=True)
        label = smallest_reachable(len(ids), place[: len(u)], place[len(u) :])
        tied = np.flatnonzero(label != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[tied]), pa.array(ids[label[tied]])], ["u", "v"])

    return edges.mapInArrow(run, "u bigint, v bigint")


def _are_stars(edges: DataFrame) -> bool:
    """Whether each u has one v, and no v is a u."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    odd = ends.groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
    return not odd.take(1)
