"""Byte-level BPE encoding and decoding by replaying the merge list over the words of the whole corpus.

Documents are packed into blocks, which are shuffled once. Each block lists its distinct pre-tokens, which meet by a hash
of theirs: a task gets one part of all distinct words of the corpus, lays their bytes out in one symbol array and
keeps an inverted index from pair rank to the word positions of that pair. The merges are applied in rank order
over all words at once: the positions of the lowest pending rank are merged, and only the neighbours that a
merge touched are looked up again and re-indexed. The ids of the words go back to the blocks that hold them,
where the ids of a text are its words' ids in turn. A common word is replayed once, not once in each block."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.llm.common import mix64, ragged, shuffle_partitions, small_batches, text_blocks, text_bytes
from cairnlake.llm.pairs import NONE, Vocabulary, ranked_bytes
from cairnlake.llm.rolling import prefix_hash, range_hash
from cairnlake.llm.segments import spaced_starts

#: Text of a block of documents, which lists its own words.
BLOCK_BYTES = 4 << 20


class _Pending:
    """The inverted index: by pair rank, the positions where the pair stands or stood."""

    def __init__(self) -> None:
        self.by_rank: dict[int, list[np.ndarray]] = {}
        self.heap: list[int] = []

    def add(self, at: np.ndarray, rank: np.ndarray) -> None:
        if not len(at):
            return
        if len(at) > 1:
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            cuts = np.flatnonzero(rank[1:] != rank[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(at)]
        else:
            bounds = [0, 1]
        for a, b in zip(bounds, bounds[1:]):
            r = int(rank[a])
            held = self.by_rank.get(r)
            if held is None:
                self.by_rank[r] = [at[a:b]]
                heapq.heappush(self.heap, r)
            else:
                held.append(at[a:b])

    def pop(self) -> tuple[int, np.ndarray]:
        r = heapq.heappop(self.heap)
        held = self.by_rank.pop(r)
        return r, held[0] if len(held) == 1 else np.concatenate(held)


def replay(words: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after the other, and the n + 1 offsets of the words into them."""
    n_words = len(offsets) - 1
    lengths = np.diff(offsets)
    # one gap with id -1 behind each word keeps pairs inside words
    size = len(words) + n_words
    owner = np.repeat(np.arange(n_words, dtype=np.int32), lengths + 1)
    place = np.arange(len(words)) + np.repeat(np.arange(n_words), lengths)
    symbol = np.full(size + 1, -1, np.int32)
    symbol[place] = vocabulary.first[words]
    after = np.arange(1, size + 2, dtype=np.int32)
    after[-1] = size
    before = np.arange(-1, size, dtype=np.int32)
    before[0] = size
    slots = vocabulary.pairs
    rank = np.full(size + 1, NONE, np.int32)
    got = slots.find(symbol[:-1], symbol[1:])
    rank[:-1] = np.where(got >= 0, slots.ranks[got], NONE)
    pending = _Pending()
    at = np.flatnonzero(rank != NONE).astype(np.int32)
    pending.add(at, rank[at])
    while pending.heap:
        r, at = pending.pop()
        at = at[rank[at] == r]
        if not len(at):
            continue
        if len(at) > 1 and (rank[before[at]] == r).any():  # occurrences that overlap: the leftmost goes first
            at = _leftmost(at, before)
        merged = int(slots.merged[slots.find(symbol[at[:1]], symbol[after[at[:1]]])[0]])
        if len(at) > 1 and vocabulary.early[merged]:  # a lower rank may follow: one occurrence in each word
            at = np.sort(at)
            word = owner[at]
            first = np.concatenate([[True], word[1:] != word[:-1]])
            if not first.all():
                pending.add(at[~first], np.full((~first).sum(), r, np.int32))
                at = at[first]
        gone = after[at]
        right = after[gone]
        symbol[at] = merged
        symbol[gone] = -2
        rank[gone] = NONE
        after[at] = right
        before[right] = at
        left = before[at]
        a = np.concatenate([left, at])
        got = slots.find(symbol[a], symbol[after[a]])
        new = np.where(got >= 0, slots.ranks[got], NONE)
        rank[a] = new
        found = new != NONE
        pending.add(a[found], new[found])
    live = symbol[:-1] >= 0
    ids = symbol[:-1][live]
    counts = np.add.reduceat(live, offsets[:-1] + np.arange(n_words)) if n_words else np.zeros(0, np.int64)
    return ids, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _leftmost(at: np.ndarray, before: np.ndarray) -> np.ndarray:
    taken: set[int] = set()
    for p in np.unique(at).tolist():
        if int(before[p]) not in taken:
            taken.add(p)
    return np.array(sorted(taken), at.dtype)


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The pre-tokens of the texts of a block, which cover every byte, and where each starts."""
    starts = spaced_starts(data, offsets)
    cuts = np.append(starts, len(data)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data)]), starts


def _dealt(packs: list[bytes], buckets: int) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a block of documents in the order of their buckets, and where each bucket starts (with an
    end): the same for the same block, so that ids alone need to come back."""
    seen = [pa.array([], pa.binary())]
    for pack in packs:
        data, offsets = _texts(pack)
        if len(data):
            seen.append(pre_tokens(data, offsets)[0].dictionary_encode().dictionary)
    words = pa.concat_arrays(seen).dictionary_encode().dictionary
    data, offsets = _binary(words)
    prefix = prefix_hash(data)
    bucket = mix64(range_hash(prefix, offsets[:-1], offsets[1:])) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return words.take(pa.array(order)), np.searchsorted(bucket[order], np.arange(buckets + 1))


def _word_rows(block: int, packs: list[bytes], buckets: int) -> pa.Table:
    """The words of a block of documents, packed in one row for each bucket that they fall into."""
    words, at = _dealt(packs, buckets)
    some = np.flatnonzero(at[1:] > at[:-1])
    packs = [_packed(words.slice(at[k], at[k + 1] - at[k])) for k in some]
    return pa.table([pa.array(some, pa.int64()), pa.array(np.full(len(some), block, np.int64)), pa.array(packs, pa.binary())], ["bucket", "block", "words"])


def _packed(words: pa.Array) -> bytes:
    data, offsets = _binary(words)
    return zstandard.ZstdCompressor(level=1).compress(len(words).to_bytes(8, "little") + np.diff(offsets).astype("<u4").tobytes() + data.tobytes())


def _unpacked(pack: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and bytes of packed words."""
    plain = zstandard.ZstdDecompressor().decompress(pack)
    n = int.from_bytes(plain[:8], "little")
    return np.frombuffer(plain, "<u4", n, 8), np.frombuffer(plain, np.uint8, offset=8 + 4 * n)


def _word_array(packs: list[bytes]) -> tuple[pa.Array, list[int]]:
    """All words of some packs as one array, and how many each pack has."""
    parts = [_unpacked(p) for p in packs]
    lengths = np.concatenate([n for n, _ in parts] or [np.zeros(0, np.uint32)])
    data = np.concatenate([d for _, d in parts] or [np.zeros(0, np.uint8)])
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), [len(n) for n, _ in parts]


def _replayed(table: pa.Table, vocabulary: Vocabulary) -> pa.Table:
    """The words of one bucket from all blocks of the corpus: every distinct word is replayed once, and each block
    gets back the ids of its words, in their order."""
    words, sizes = _word_array(table["words"].to_pylist())
    coded = words.dictionary_encode()
    ids, offsets = replay(*_binary(coded.dictionary), vocabulary)
    index = coded.indices.to_numpy()
    width = np.diff(offsets)[index]
    flat = ids[ragged(offsets[:-1][index], width)].astype("<u4")
    ends = np.concatenate([[0], np.cumsum(width)])
    packs, row = [], 0
    for n in sizes:
        packs.append(zstandard.ZstdCompressor(level=1).compress(width[row : row + n].astype("<u4").tobytes() + flat[ends[row] : ends[row + n]].tobytes()))
        row += n
    return pa.table([table["block"], table["bucket"], pa.array(packs, pa.binary())], ["block", "bucket", "ids"])


class WordIds:
    """The ids of a set of words."""

    def __init__(self, words: pa.Array, ids: np.ndarray, width: np.ndarray) -> None:
        self.words, self.ids, self.width = words, ids, width
        self.at = np.cumsum(width) - width

    @staticmethod
    def of(words: pa.Array, at: np.ndarray, coded: dict[int, bytes]) -> WordIds:
        """words and at as _dealt() gives them, coded by bucket."""
        widths, ids = [np.zeros(0, np.uint32)], [np.zeros(0, np.uint32)]
        for bucket, pack in sorted(coded.items()):
            plain = zstandard.ZstdDecompressor().decompress(pack)
            n = int(at[bucket + 1] - at[bucket])
            widths.append(np.frombuffer(plain, "<u4", n))
            ids.append(np.frombuffer(plain, "<u4", offset=4 * n))
        width = np.concatenate(widths).astype(np.int64)
        if len(width) != len(words):
            raise ValueError("a text changed between the two passes over it")
        return WordIds(words, np.concatenate(ids).astype(np.int32), width)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of every text of a block, and the offsets of the texts into them."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        tokens, starts = pre_tokens(data, offsets)
        coded = tokens.dictionary_encode()
        known = pc.index_in(coded.dictionary, value_set=self.words)
        if known.null_count:
            raise ValueError("a text changed between the two passes over it")
        index = known.to_numpy()[coded.indices.to_numpy()]
        width = self.width[index]
        ends = np.concatenate([[0], np.cumsum(width)])
        return self.ids[ragged(self.at[index], width)], ends[np.searchsorted(starts, offsets)]


def encode_block(data: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of every text of a block that is a corpus of its own, and the offsets of the texts into them."""
    if not len(data):
        return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
    words = pre_tokens(data, offsets)[0].dictionary_encode().dictionary
    ids, ends = replay(*_binary(words), vocabulary)
    return WordIds(words, ids, np.diff(ends)).encode(data, offsets)


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def decode_ids(ids: np.ndarray, vocabulary: Vocabulary) -> bytes:
    starts = vocabulary.token_offsets[ids]
    return vocabulary.token_bytes[ragged(starts, vocabulary.token_offsets[ids + 1] - starts)].tobytes()


def _over_corpus(df: DataFrame, path: str, id_col: str, text_col: str, finish: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, Vocabulary], list[pa.Array]], fields: str) -> DataFrame:
    """(id_col, fields) of every row: finish gets the bytes and ids of some texts, each with their offsets."""
    n = shuffle_partitions(df.sparkSession)
    small_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()
    names = [f.split()[0] for f in fields.split(", ")]
    documents = df.select(df[id_col].alias("id"), df[text_col].alias("text")).mapInArrow(_pieces, f"block bigint, ids array<{kind}>, texts binary")
    documents = documents.repartition(n, "block")  # both uses share this shuffle

    def words_of(table: pa.Table) -> pa.Table:
        return _word_rows(table["block"][0].as_py(), table["texts"].to_pylist(), n)

    def replay_bucket(table: pa.Table) -> pa.Table:
        return _replayed(table, ranked_bytes(path))

    def encode_rows(pieces: pa.Table, coded: pa.Table) -> pa.Table:
        vocabulary = ranked_bytes(path)
        known = WordIds.of(*_dealt(pieces["texts"].to_pylist(), n), dict(zip(coded["bucket"].to_pylist(), coded["ids"].to_pylist())))
        rows = []
        for ids, pack in zip(pieces["ids"], pieces["texts"].to_pylist()):
            data, offsets = _texts(pack)
            symbols, ends = known.encode(data, offsets)
            rows.append(pa.table([ids.values, *finish(data, offsets, symbols, ends, vocabulary)], ["id", *names]))
        return pa.concat_tables(rows)

    words = documents.groupBy("block").applyInArrow(words_of, "bucket bigint, block bigint, words binary")
    coded = words.groupBy("bucket").applyInArrow(replay_bucket, "block bigint, bucket bigint, ids binary")
    out = documents.groupBy("block").cogroup(coded.groupBy("block")).applyInArrow(encode_rows, f"id {kind}, {fields}")
    return out.select(F.col("id").alias(id_col), *names)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents, their texts compressed together, named by a hash of what they hold."""
    for piece in text_blocks(batches, "text", BLOCK_BYTES):
        data, offsets = text_bytes(piece["text"])
        ids = piece["id"].combine_chunks()
        pack = zstandard.ZstdCompressor(level=1).compress(np.diff(offsets).astype("<u4").tobytes() + data.tobytes())
        pack = len(ids).to_bytes(8, "little") + pack
        name = np.array([xxhash.xxh3_64_intdigest(pack)], np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(name), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([pack], pa.binary())], ["block", "ids", "texts"])


def _texts(pack: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(pack[:8], "little")
    plain = zstandard.ZstdDecompressor().decompress(pack[8:])
    return np.frombuffer(plain, np.uint8, offset=4 * n), np.concatenate([[0], np.cumsum(np.frombuffer(plain, "<u4", n), dtype=np.int64)])


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>, n_tokens, restored) of every row; restored says that decoding the ids gives the
    text's bytes again. Null and empty texts have no ids. Repeated rows and null ids pass through; other columns
    are left out."""

    def finish(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> list[pa.Array]:
        lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
        restored = [decode_ids(ids[ends[i] : ends[i + 1]], vocabulary) == data[offsets[i] : offsets[i + 1]].tobytes() for i in range(len(offsets) - 1)]
        return [lists, pa.array(np.diff(ends)), pa.array(restored, pa.bool_())]

    return _over_corpus(df, path, id_col, text_col, finish, "ids array<int>, n_tokens bigint, restored boolean")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text and decodes its ids again: (id_col, n_tokens, ids_sha256 over little-endian
    32-bit ids, decoded_sha256). Null texts count as empty; repeated rows and null ids pass through."""

    def finish(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, ends: np.ndarray, vocabulary: Vocabulary) -> list[pa.Array]:
        parts = [ids[a:b] for a, b in zip(ends.tolist(), ends.tolist()[1:])]
        coded = [hashlib.sha256(p.astype("<u4")).hexdigest() for p in parts]
        decoded = [hashlib.sha256(decode_ids(p, vocabulary)).hexdigest() for p in parts]
        return [pa.array(np.diff(ends)), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]

    return _over_corpus(df, path, id_col, text_col, finish, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
