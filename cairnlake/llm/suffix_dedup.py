"""Removing byte strings that occur earlier in the corpus, by a hash-compared suffix sort.

A byte goes if some string of LENGTH bytes that covers it also starts earlier (smaller id, or the same document
and an earlier start). All suffixes of a corpus are too many to shuffle, so equal strings are first brought
together by anchors: of the GRAM-byte grams of a window of LENGTH bytes, the leftmost with the least hash. Equal
windows have equal anchors at equal places, so two windows need comparing only if their anchors agree.

Each anchor owns a stretch of consecutive windows. Stretches are equal if two independent 64-bit hashes agree, the
polynomial one of the gram and one (XXH3) of all their bytes with the anchor's place in them; all but the first are covered; this already happens inside each map task, so copies do not pile up. What is left
are anchors with several different stretches, as they occur where a repeated passage begins or ends or
a near copy was edited. Their bytes are fetched, and the suffixes that start at their windows are sorted by
merge sort, all groups at once: two suffixes are compared by binary search for their common extension over
prefix polynomial hashes, and by the byte behind it. Neighbours whose extension reaches LENGTH are verified byte
by byte, and of each run of equal suffixes all but the first are covered.

Documents of equal id are taken in the order of a hash of their texts; equal rows count as one document.
Rows with a null id are left whole and cover nothing. Null texts count as empty."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.llm.common import mix64, ragged, shuffle_partitions, small_batches, text_blocks, text_bytes
from cairnlake.llm.rolling import prefix_hash, range_hash

LENGTH = 100
GRAM = 32
BLOCK_BYTES = 2 << 20
STRETCH_ENTRIES = 800_000

ANCHOR = np.dtype([("gram", "<u8"), ("stretch", "<u8"), ("doc", "<i8"), ("sign", "<u8"), ("start", "<u4"), ("windows", "u1"), ("lead", "u1")])
SPAN = np.dtype([("sign", "<u8"), ("start", "<u4"), ("stop", "<u4")])
ASK = np.dtype([("gram", "<u8"), ("sign", "<u8"), ("start", "<u4"), ("windows", "u1"), ("lead", "u1")])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """For each start, where the leftmost least of `width` values stands."""
    best, at = values, np.arange(len(values), dtype=np.int32)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        a, b = best[:-step], best[step:]
        right = b < a
        best, at = np.where(right, b, a), np.where(right, at[step:], at[:-step])
        reach += step
    return at


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document index, place of the gram, first window, number of windows) of each anchor of a block, places in
    the block; and gram hashes and stretch hashes."""
    none = np.zeros(0, np.int64)
    sizes = np.diff(offsets)
    if len(data) < LENGTH or not (sizes >= LENGTH).any():
        return (none,) * 4, none.astype(np.uint64), none.astype(np.uint64)
    prefix = prefix_hash(data)
    grams = np.arange(len(data) - GRAM + 1)
    hashes = mix64(range_hash(prefix, grams, grams + GRAM))
    place = _least(hashes, LENGTH - GRAM + 1)
    long_ = np.flatnonzero(sizes >= LENGTH)
    starts = ragged(offsets[long_], sizes[long_] - LENGTH + 1)
    doc = np.repeat(long_, sizes[long_] - LENGTH + 1)
    place = place[starts]
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(starts)))
    first, gram = starts[at], place[at].astype(np.int64)
    view, last = memoryview(data), first + count - 1 + LENGTH
    whole = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), last.tolist())), np.uint64, len(first))
    stretch = mix64(whole + (count * 256 + gram - first).astype(np.uint64))
    return (doc[at], gram, first, count), hashes[gram], stretch


def _merged(spans: np.ndarray) -> np.ndarray:
    """Spans of one document text united where they touch."""
    spans = spans[np.lexsort((spans["start"], spans["sign"]))]
    if len(spans) < 2:
        return spans
    key = np.concatenate([[0], np.cumsum(spans["sign"][1:] != spans["sign"][:-1])]).astype(np.int64) << 32
    reach = np.maximum.accumulate(key + spans["stop"])
    new = np.concatenate([[True], key[1:] + spans["start"][1:] > reach[:-1]])
    at = np.flatnonzero(new)
    out = spans[at]
    out["stop"] = (reach[np.append(at[1:], len(spans)) - 1] & 0xFFFFFFFF).astype(np.uint32)
    return out


def _rows(buckets: int | None, doc: np.ndarray, records: np.ndarray, kind: int) -> pa.RecordBatch:
    """One row for each document with its records, packed."""
    order = np.argsort(doc, kind="stable")
    doc, records = doc[order], records[order]
    at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    ends = np.append(at[1:], len(doc))
    packs = [(_merged(records[a:b]) if kind == 0 else records[a:b]).tobytes() for a, b in zip(at, ends)]
    own = doc[at]
    columns = [pa.array(np.full(len(own), kind, np.int32)), pa.array(own), pa.array(packs, pa.binary())]
    if buckets is None:
        return pa.RecordBatch.from_arrays(columns, ["kind", "doc", "pack"])
    bucket = (mix64(own.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(bucket), *columns], ["bucket", "kind", "doc", "pack"])


def _squeezed(records: np.ndarray) -> bytes:
    """Records field by field, ids as differences, compressed: most of them are small numbers in order."""
    doc = np.diff(records["doc"], prepend=np.int64(0))
    fields = [doc if name == "doc" else np.ascontiguousarray(records[name]) for name in ANCHOR.names]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(f.tobytes() for f in fields))


def _restored(pack: bytes) -> np.ndarray:
    plain = zstandard.ZstdDecompressor().decompress(pack)
    out = np.zeros(len(plain) // ANCHOR.itemsize, ANCHOR)
    at = 0
    for name in ANCHOR.names:
        field = np.frombuffer(plain, ANCHOR[name], len(out), at)
        out[name] = np.cumsum(field) if name == "doc" else field
        at += field.nbytes
    return out


def _by_bucket(bucket: np.ndarray, records: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((records["start"], records["sign"], records["doc"], bucket))
    bucket, records = bucket[order], records[order]
    at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(at[1:], len(bucket))
    n = len(at)
    return pa.RecordBatch.from_arrays([pa.array(bucket[at].astype(np.int32)), pa.array(np.ones(n, np.int32)), pa.nulls(n, pa.int64()), pa.array([_squeezed(records[a:b]) for a, b in zip(at, ends)], pa.binary())], ["bucket", "kind", "doc", "pack"])


def _firsts(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first anchor of each class of equal stretches, and all others; sorted by gram."""
    entries = entries[np.lexsort((entries["start"], entries["sign"], entries["doc"], entries["stretch"], entries["gram"]))]
    twice = np.zeros(len(entries), bool)  # rows given repeatedly are one document
    twice[1:] = np.logical_and.reduce([entries[c][1:] == entries[c][:-1] for c in ("start", "sign", "doc", "stretch", "gram")])
    entries = entries[~twice]
    same = np.zeros(len(entries), bool)
    same[1:] = (entries["gram"][1:] == entries["gram"][:-1]) & (entries["stretch"][1:] == entries["stretch"][:-1])
    return entries[~same], entries[same]


def _covered(entries: np.ndarray) -> np.ndarray:
    spans = np.zeros(len(entries), SPAN)
    spans["sign"], spans["start"] = entries["sign"], entries["start"]
    spans["stop"] = entries["start"] + entries["windows"].astype(np.uint32) + np.uint32(LENGTH - 1)
    return spans


def _sign(data: np.ndarray, a: int, b: int) -> int:
    """Tells the texts of one id apart."""
    return xxhash.xxh3_64_intdigest(data[a:b].tobytes())


def _find_anchors(documents: DataFrame, buckets: int) -> DataFrame:
    """Rows of kind 1 hold anchors of one bucket, rows of kind 0 spans of one document already covered."""

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        first, rest = _firsts(np.concatenate(held))
        if len(rest):
            yield _rows(buckets, rest["doc"], _covered(rest), 0)
        yield _by_bucket((first["gram"] % np.uint64(buckets)).astype(np.int32), first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for block in text_blocks(batches, "body", BLOCK_BYTES):
            data, offsets = text_bytes(block["body"])
            (doc, gram, first, windows), grams, stretches = anchors(data, offsets)
            if not len(doc):
                continue
            ids = block["doc"].to_numpy()
            signs = np.array([_sign(data, a, b) for a, b in zip(offsets, offsets[1:])], np.uint64)
            entry = np.zeros(len(doc), ANCHOR)
            entry["gram"], entry["stretch"], entry["doc"], entry["sign"] = grams, stretches, ids[doc], signs[doc]
            entry["start"], entry["windows"], entry["lead"] = first - offsets[doc], windows, gram - first
            held.append(entry)
            count += len(entry)
            if count >= STRETCH_ENTRIES:
                yield from flush(held)
                held, count = [], 0
        yield from flush(held)

    return documents.mapInArrow(run, "bucket int, kind int, doc bigint, pack binary")


def _match_anchors(found: DataFrame) -> DataFrame:
    """Rows (kind, doc, pack): spans of a document (0), and anchors whose bytes must be compared (1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            passed = batch.filter(pc.equal(batch.column(1), 0))
            if passed.num_rows:
                yield passed.select(["kind", "doc", "pack"])
            rest = batch.filter(pc.equal(batch.column(1), 1))
            for bucket, pack in zip(rest.column(0).to_pylist(), rest.column(3).to_pylist()):
                held.setdefault(bucket, []).append(pack)
        for bucket in list(held):
            first, rest = _firsts(np.concatenate([_restored(p) for p in held.pop(bucket)]))
            if len(rest):
                yield _rows(None, rest["doc"], _covered(rest), 0)
            again = np.zeros(len(first), bool)
            again[1:] = first["gram"][1:] == first["gram"][:-1]
            again[:-1] |= again[1:]
            first = first[again]
            if len(first):
                ask = np.zeros(len(first), ASK)
                for name in ASK.names:
                    ask[name] = first[name]
                yield _rows(None, first["doc"], ask, 1)

    return found.mapInArrow(run, "kind int, doc bigint, pack binary")


def _fetch(asked: DataFrame, documents: DataFrame, buckets: int) -> DataFrame:
    """Spans pass through by a bucket of the document; anchors get their bytes and a bucket of the gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "body", BLOCK_BYTES):
            data, offsets = text_bytes(block["body"])
            docs = block["doc"].to_pylist()
            bucket, kinds, ids, packs = [], [], [], []
            for i, rows in enumerate(block["rows"].to_pylist()):
                sign = _sign(data, offsets[i], offsets[i + 1])
                spans, asks = (b"".join(r["pack"] for r in rows if r["kind"] == k) for k in (0, 1))
                home = int(mix64(np.array([docs[i]], np.int64).view(np.uint64))[0] % np.uint64(buckets))
                if spans:
                    bucket.append(home)
                    kinds.append(0)
                    ids.append(docs[i])
                    packs.append(_merged(np.frombuffer(spans, SPAN)).tobytes())
                if asks:
                    ask = np.frombuffer(asks, ASK)
                    ask = ask[ask["sign"] == sign]
                    where = (ask["gram"] % np.uint64(buckets)).astype(np.int32)
                    for b in np.unique(where).tolist():
                        own = ask[where == b]
                        start = own["start"].astype(np.int64) + offsets[i]
                        cut = data[ragged(start, own["windows"].astype(np.int64) + LENGTH - 1)]
                        bucket.append(b)
                        kinds.append(1)
                        ids.append(docs[i])
                        packs.append(len(own).to_bytes(4, "little") + own.tobytes() + cut.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(kinds, pa.int32()), pa.array(ids, pa.int64()), pa.array(packs, pa.binary())], ["bucket", "kind", "doc", "pack"])

    each = asked.groupBy("doc").agg(F.collect_list(F.struct("kind", "pack")).alias("rows"))
    return documents.join(each, "doc").select("doc", "body", "rows").mapInArrow(run, "bucket int, kind int, doc bigint, pack binary")


class Suffixes:
    """Sorts suffixes by their first LENGTH bytes with comparisons through prefix hashes."""

    def __init__(self, data: np.ndarray, length: int = LENGTH) -> None:
        self.data, self.length = data, length
        self.prefix = prefix_hash(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension from a and from b, up to `length`, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length, np.int64)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high + 1) // 2
            same = range_hash(self.prefix, a, a + middle) == range_hash(self.prefix, b, b + middle)
            low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether the suffix at a comes before that at b, or also where both are equal."""
        shared = self.common(a, b)
        equal = shared == self.length
        step = np.minimum(shared, self.length - 1)
        return np.where(equal, or_equal, self.data[a + step] < self.data[b + step])

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The stable order of suffixes inside each group; group is sorted. Bottom-up merge sort of all groups at
        once: in a round, each element finds its place in the other run of its pair by binary search."""
        order = np.arange(len(starts))
        begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else order
        size = np.diff(np.append(begin, len(group)))
        base, total = np.repeat(begin, size), np.repeat(size, size)
        inside = np.arange(len(group)) - base
        width = 1
        while width < int(size.max(initial=0)):
            pair = inside // (2 * width) * (2 * width)
            right = inside - pair >= width
            mates = np.where(right, pair, pair + width)
            last = np.minimum(np.where(right, pair + width, pair + 2 * width), total)
            work = np.flatnonzero((mates < last) & (total > width))
            low, high = mates[work] + base[work], last[work] + base[work]
            from_ = low.copy()
            own, is_right = starts[order[work]], right[work]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                mate = starts[order[middle]]
                r = is_right[open_]
                # equal suffixes of the left run stay first
                less = np.empty(len(open_), bool)
                less[r] = self.before(mate[r], own[open_][r], True)
                less[~r] = self.before(mate[~r], own[open_][~r], False)
                low[open_] = np.where(less, middle + 1, low[open_])
                high[open_] = np.where(less, high[open_], middle)
            place = np.arange(len(group))
            offset = np.where(is_right, inside[work] - pair[work] - width, inside[work] - pair[work])
            place[work] = base[work] + pair[work] + offset + (low - from_)
            new = np.empty_like(order)
            new[place] = order
            order = new
            width *= 2
        return order

    def equal_to_previous(self, sorted_starts: np.ndarray, same_group: np.ndarray) -> np.ndarray:
        """For each sorted suffix but the first, whether it equals the one before; hash matches are verified
        against the bytes, and a false match is an error."""
        out = np.zeros(len(sorted_starts), bool)
        at = np.flatnonzero(same_group[1:]) + 1
        a, b = sorted_starts[at - 1], sorted_starts[at]
        hit = range_hash(self.prefix, a, a + self.length) == range_hash(self.prefix, b, b + self.length)
        a, b, at = a[hit], b[hit], at[hit]
        words = np.zeros(len(self.data) + 8, np.uint64)
        for k in range(8):
            words[: len(self.data) - k] |= self.data[k:].astype(np.uint64) << np.uint64(8 * k)
        for k in [*range(0, self.length - 7, 8), self.length - 8]:
            if not np.array_equal(words[a + k], words[b + k]):
                raise ValueError("prefix hashes of different bytes agree")
        out[at] = True
        return out


def _sort_suffixes(fetched: DataFrame) -> DataFrame:
    """Rows (doc, pack) of covered spans."""

    def solve(docs: list[int], packs: list[bytes]) -> Iterator[pa.RecordBatch]:
        asks, cuts, owners = [], [], []
        for doc, pack in zip(docs, packs):
            n = int.from_bytes(pack[:4], "little")
            asks.append(np.frombuffer(pack, ASK, n, 4))
            cuts.append(np.frombuffer(pack, np.uint8, offset=4 + n * ASK.itemsize))
            owners.append(np.full(n, doc, np.int64))
        ask, data, owner = np.concatenate(asks), np.concatenate(cuts), np.concatenate(owners)
        windows = ask["windows"].astype(np.int64)
        base = np.cumsum(windows + LENGTH - 1) - (windows + LENGTH - 1)
        # a row given repeatedly answers every ask again: only one answer counts
        order = np.lexsort((ask["start"], ask["sign"], owner, ask["gram"]))
        twice = np.zeros(len(ask), bool)
        twice[order[1:]] = np.logical_and.reduce([x[order[1:]] == x[order[:-1]] for x in (ask["start"], ask["sign"], owner, ask["gram"])])
        ask, owner, windows, base = (x[~twice] for x in (ask, owner, windows, base))
        entry = np.repeat(np.arange(len(ask)), windows)
        step = ragged(np.zeros(len(ask), np.int64), windows)
        gram, lead = ask["gram"][entry], ask["lead"][entry].astype(np.int64) - step
        start = ask["start"][entry].astype(np.int64) + step
        order = np.lexsort((start, ask["sign"][entry], owner[entry], lead, gram))
        gram, lead = gram[order], lead[order]
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (lead[1:] != lead[:-1])])
        group = np.cumsum(new)
        alone = new & np.append(new[1:], True)
        order, group = order[~alone], group[~alone]
        if not len(order):
            return
        work = Suffixes(data)
        starts = (base[entry] + step)[order]
        sorted_ = work.sort(starts, group)
        same = np.concatenate([[False], group[1:] == group[:-1]])  # sorting stays inside groups
        again = order[sorted_[work.equal_to_previous(starts[sorted_], same)]]
        spans = np.zeros(len(again), SPAN)
        spans["sign"], spans["start"] = ask["sign"][entry[again]], start[again]
        spans["stop"] = start[again] + LENGTH
        if len(again):
            yield _rows(None, owner[entry[again]], spans, 0).select(["doc", "pack"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[bytes]]] = {}
        for batch in batches:
            passed = batch.filter(pc.equal(batch.column(1), 0))
            if passed.num_rows:
                yield passed.select(["doc", "pack"])
            rest = batch.filter(pc.equal(batch.column(1), 1))
            for bucket, doc, pack in zip(rest.column(0).to_pylist(), rest.column(2).to_pylist(), rest.column(3).to_pylist()):
                docs, packs = held.setdefault(bucket, ([], []))
                docs.append(doc)
                packs.append(pack)
        for bucket in list(held):
            yield from solve(*held.pop(bucket))

    return fetched.mapInArrow(run, "doc bigint, pack binary")


def repeated_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, packs): packed spans of each document that has bytes to remove."""
    n = shuffle_partitions(df.sparkSession)
    small_batches(df.sparkSession)
    documents = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("body")).where("doc is not null")
    found = _find_anchors(documents, 4 * n).repartition(n, "bucket")
    fetched = _fetch(_match_anchors(found), documents, 16 * n).repartition(n, "bucket")
    return _sort_suffixes(fetched).groupBy("doc").agg(F.collect_list("pack").alias("packs"))


def remove_repeats(df: DataFrame, keep: list[str] | None = None, texts: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, n_removed, n_spans, kept_sha256) of every row, and the columns named in keep, but for those that
    share a name with these. With `texts`, also kept_text: the bytes left as text, without characters of which only
    a part is left."""
    made = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept_text"] * texts
    keep = [c for c in keep or [] if c not in (id_col, *made)]
    names = [f"keep_{i}" for i in range(len(keep))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "body", BLOCK_BYTES):
            data, offsets = text_bytes(block["body"])
            removed, counts, digests, kept = [], [], [], []
            for i, packs in enumerate(block["packs"].to_pylist()):
                text = data[offsets[i] : offsets[i + 1]]
                spans = np.zeros(0, SPAN)
                if packs:
                    spans = np.frombuffer(b"".join(packs), SPAN)
                    spans = _merged(spans[spans["sign"] == _sign(text, 0, len(text))])
                if len(spans):
                    edge = np.zeros(len(text) + 1, np.int8)
                    edge[spans["start"]] += 1
                    edge[spans["stop"]] -= 1
                    rest = text[np.cumsum(edge[:-1]) == 0].tobytes()
                else:
                    rest = text.tobytes()
                removed.append(len(text) - len(rest))
                counts.append(len(spans))
                digests.append(hashlib.sha256(rest).hexdigest())
                if texts:
                    kept.append(rest.decode(errors="ignore"))
            own = [pa.array(np.diff(offsets)), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(digests, pa.string())]
            own += [pa.array(kept, pa.string())] if texts else []
            yield pa.RecordBatch.from_arrays([block["doc"].combine_chunks(), *own, *[block[c].combine_chunks() for c in names]], ["doc", *made, *names])

    everything = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("body"), *[F.col(c).alias(k) for c, k in zip(keep, names)])
    rows = everything.where("doc is not null").join(repeated_spans(df, id_col, text_col), "doc", "left")
    rows = rows.unionByName(everything.where("doc is null").withColumn("packs", F.lit(None).cast("array<binary>")))
    schema = "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_text string" * texts + "".join(f", {k} {df.schema[c].dataType.simpleString()}" for c, k in zip(keep, names))
    out = rows.select("doc", "body", "packs", *names).mapInArrow(run, schema)
    return out.select(F.col("doc").alias(id_col), *made, *[F.col(k).alias(c) for c, k in zip(keep, names)])
