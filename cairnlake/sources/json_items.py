"""The items of one large JSON document, read by many tasks.

Spark's text reader cuts a file into byte ranges; with commas as line ends each task gets the pieces between commas that
start in its range. Whether a comma stands inside a string, and how deep, depends on all that comes before, so
every range is scanned for both possible starts: inside a string and outside. A table with one row for each range composes the
outcomes into the state at the start of each range. With it the ranges are read again and cut at the commas between the
items of the outermost array or object. Only items that cross a range's border are put together by a shuffle.

Escapes never straddle a piece: a comma is never escaped in JSON."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.sources.folders import rewritten

QUOTE, BACKSLASH = 0x22, 0x5C


def _changes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unescaped quotes, and brackets as +1 and -1, of each byte."""
    slash = data == BACKSLASH
    quote = data == QUOTE
    if slash.any():
        at = np.flatnonzero(slash)
        head = np.concatenate([[True], np.diff(at) != 1])
        run = np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))
        odd = at[(np.arange(len(at)) - run) % 2 == 0]  # these escape what follows, and are not escaped themselves
        odd = odd[odd + 1 < len(data)]
        quote[odd[quote[odd + 1]] + 1] = False
    bracket = np.zeros(len(data), np.int64)
    bracket[(data == 0x5B) | (data == 0x7B)] = 1
    bracket[(data == 0x5D) | (data == 0x7D)] = -1
    return quote, bracket


def _scan(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At the end of each piece: quotes so far, and the depth gained so far for a start outside and inside of a string."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    quote, bracket = _changes(data)
    quotes = np.cumsum(quote)
    inside = quotes & 1
    ends = offsets[1:] - offsets[0]
    at = lambda sums: np.concatenate([[0], sums])[ends]
    return at(quotes), at(np.cumsum(bracket * (inside == 0))), at(np.cumsum(bracket * (inside == 1)))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("lineSep", ",").text(path)
    return raw.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """((file, block), pieces): the parts of each batch that are of one range."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        files, blocks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(files) != 0)) + 1
        for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield (int(files[low]), int(blocks[low])), batch.column(2).slice(low, high - low)


def _range_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[tuple[int, int], list[int]] = {}
    for key, pieces in _by_range(batches):
        quotes, outside, inside = (int(x[-1]) for x in _scan(pieces))
        own = totals.setdefault(key, [0, 0, 0])
        if own[0] & 1:
            outside, inside = inside, outside
        own[0] += quotes
        own[1] += outside
        own[2] += inside
    rows = [(*key, *own) for key, own in totals.items()]
    yield pa.RecordBatch.from_pylist([dict(zip(("file", "block", "quotes", "outside", "inside"), r)) for r in rows], _TOTALS)


_TOTALS = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("quotes", pa.int64()), ("outside", pa.int64()), ("inside", pa.int64())])


def _starts(totals: list, path: str) -> dict[tuple[int, int], tuple[int, int]]:
    """Whether each range starts inside a string, and how deep; a document that ends otherwise than it starts is an error."""
    out: dict[tuple[int, int], tuple[int, int]] = {}
    file, inside, depth = None, 0, 0
    for r in [*sorted(totals), (None, 0, 0, 0, 0)]:
        if r[0] != file:
            if inside or depth:
                raise ValueError(f"a document of {path} is cut short or not JSON")
            file = r[0]
        out[r[0], r[1]] = inside, depth
        depth += r[4] if inside else r[3]
        inside = (inside + r[2]) & 1
    return out


def json_items(spark: SparkSession, path: str) -> DataFrame:
    """(pos, item): the items of the outermost array, or `"name":value` of the outermost object, of each document as they stand
    there, in the order of pos, which keeps documents apart by a hash of their path. A document without items gives no row. Compressed files cannot be cut, so one task
    reads each of them. An item must fit into a task."""
    pieces = _pieces(spark, path)
    totals = pieces.mapInArrow(_range_totals, "file long, block bigint, quotes bigint, outside bigint, inside bigint").collect()  # one row for each range
    starts = _starts([tuple(r) for r in totals], path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, nth = None, [], 0  # the pieces of an item that are there so far

        def rest():  # goes on in the next range, or ends the document
            return pa.RecordBatch.from_pylist([{"file": key[0], "block": key[1], "nth": nth, "item": ",".join(held) if held else None}], _ITEMS)

        for now, part in _by_range(batches):
            if now != key:
                if key is not None:
                    yield rest()
                key, held, nth = now, [], 0
                inside, depth = starts[key]
            quotes, outside, within = _scan(part)
            after = depth + (within if inside else outside)
            ends = np.flatnonzero((after == 1) & ((inside + quotes) & 1 == 0)) + 1
            if len(ends):
                first = pa.array([",".join(held + part[: ends[0]].to_pylist())])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), part)
                items = pa.concat_arrays([first, pc.binary_join(lists, ",")])
                n = len(items)
                yield pa.RecordBatch.from_arrays([pa.array([key[0]] * n), pa.array(np.full(n, key[1])), pa.array(np.arange(nth, nth + n)), items], schema=_ITEMS)
                held, nth = [], nth + n
                part = part.slice(ends[-1])
            held += part.to_pylist()
            inside, depth = int(inside + quotes[-1]) & 1, int(after[-1])
        if key is not None:
            yield rest()

    parts = rewritten(pieces.mapInArrow(cut, "file long, block bigint, nth bigint, item string"))
    ranges = sorted(tuple(r) for r in parts.groupBy("file", "block").agg(F.max("nth").alias("last")).collect())  # one row for each range
    owner, borders, last = None, [], {}
    for file, block, n in ranges:
        # the first part of a range goes on with the last of the one before
        owner = owner if owner and owner[0] == file else (file, block, 0)
        borders.append((file, block, 0, owner[1], owner[2]))
        if n:
            owner = (file, block, n)
            borders.append((file, block, n, block, n))
        last[file] = owner
    if not borders:
        return spark.createDataFrame([], "pos struct<file:long,block:bigint,nth:bigint>, item string")
    known = F.broadcast(spark.createDataFrame(borders, "file long, block long, nth long, own_block long, own_nth long"))
    placed = parts.join(known, ["file", "block", "nth"], "left")
    pos = lambda block, nth: F.struct("file", F.col(block).alias("block"), F.col(nth).alias("nth")).alias("pos")
    whole = placed.where("own_block is null").select(pos("block", "nth"), "item")
    # the pieces of an item that crosses borders, each but the last followed by the comma at which its range ended
    crossing = placed.where("own_block is not null").groupBy("file", "own_block", "own_nth").agg(F.array_sort(F.collect_list(F.struct("block", "nth", "item"))).alias("p"))
    joined = crossing.select(pos("own_block", "own_nth"), F.array_join(F.transform("p", lambda x: x["item"]), ",").alias("item"))
    items = whole.unionByName(joined)
    first = F.broadcast(spark.createDataFrame([(f, min(b for g, b, _ in ranges if g == f), *last[f][1:]) for f in last], "file long, first_block long, last_block long, last_nth long"))
    items = items.join(first, items["pos.file"] == first["file"])
    text = F.col("item")
    text = F.when((F.col("pos.block") == F.col("first_block")) & (F.col("pos.nth") == 0), F.regexp_replace(text, r"^[\s\x{FEFF}]*[\[{]", "")).otherwise(text)
    text = F.when((F.col("pos.block") == F.col("last_block")) & (F.col("pos.nth") == F.col("last_nth")), F.regexp_replace(text, r"[\]}]\s*$", "")).otherwise(text)
    return items.select("pos", F.trim(text, F.lit(" \t\r\n")).alias("item")).where("item <> ''").orderBy("pos")


_ITEMS = pa.schema([("file", pa.int64()), ("block", pa.int64()), ("nth", pa.int64()), ("item", pa.string())])
