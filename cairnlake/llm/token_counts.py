"""Token counts under a lower-casing word BPE, by rank-synchronous array merging.

The distinct words of a block are held as one ragged symbol array. In each step every word applies its own
lowest-rank pair, all occurrences at once, and the array is packed again; words without a pair left leave
it. What remains of a word is its number of tokens, and a text sums the counts of its words."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer
from tokenizers.normalizers import Normalizer

from cairnlake.llm.bpe_replay import _binary
from cairnlake.llm.common import text_blocks, text_bytes
from cairnlake.llm.pairs import NONE, Vocabulary, merged_words
from cairnlake.llm.segments import word_starts

BLOCK_BYTES = 8 << 20


def word_token_counts(words: np.ndarray, offsets: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """How many tokens each word (a non-empty range of bytes) has."""
    n = len(offsets) - 1
    counts = np.diff(offsets)
    symbol = vocabulary.first[words]
    symbol[offsets[1:] - 1] = vocabulary.final[words[offsets[1:] - 1]]
    lengths = counts.copy()
    word = np.arange(n)
    slots = vocabulary.pairs
    slot = _slots(symbol, lengths, slots)
    while True:
        rank = np.where(slot >= 0, slots.ranks[slot], NONE)
        starts = np.cumsum(lengths) - lengths
        least = np.minimum.reduceat(rank, starts) if len(starts) else rank[:0]
        going = least != NONE
        counts[word[~going]] = lengths[~going]
        if not going.any():
            return counts
        if not going.all():
            keep = np.repeat(going, lengths)
            symbol, slot, rank = symbol[keep], slot[keep], rank[keep]
            word, lengths, least = word[going], lengths[going], least[going]
        hit = rank == np.repeat(least, lengths)
        if (hit[1:] & hit[:-1]).any():  # a run of one pair: every other one, from the left
            at = np.flatnonzero(hit)
            fresh = np.concatenate([[True], np.diff(at) != 1])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            hit[at[(np.arange(len(at)) - run) % 2 == 1]] = False
        symbol[hit] = slots.merged[slot[hit]]
        gone = np.concatenate([[False], hit[:-1]])
        starts = np.cumsum(lengths) - lengths
        lengths = lengths - np.add.reduceat(hit, starts)
        changed = hit.copy()
        changed[:-1] |= hit[1:]  # the pair before a merge
        symbol, slot, changed = symbol[~gone], slot[~gone], changed[~gone]
        last = np.zeros(len(symbol), bool)
        last[np.cumsum(lengths) - 1] = True
        slot[last] = -1
        at = np.flatnonzero(changed & ~last)
        slot[at] = slots.find(symbol[at], symbol[at + 1])


def _slots(symbol: np.ndarray, lengths: np.ndarray, slots) -> np.ndarray:
    out = np.full(len(symbol), -1, np.int64)
    if len(symbol) > 1:
        out[:-1] = slots.find(symbol[:-1], symbol[1:])
        out[np.cumsum(lengths) - 1] = -1
    return out


@functools.cache
def _rules(path: str) -> tuple[re.Pattern | None, Normalizer]:
    """What the tokenizer file says of strings that are one token wherever they stand, and its normaliser."""
    special = sorted((t["content"] for t in json.loads(open(path, encoding="utf-8").read())["added_tokens"]), key=len, reverse=True)
    return re.compile("|".join(map(re.escape, special))) if special else None, Tokenizer.from_file(path).normalizer


def _prepared(texts: list[str | None], path: str) -> tuple[list[bytes], np.ndarray]:
    """The texts as the tokenizer's normaliser leaves them, and how many special strings each held."""
    pattern, normalizer = _rules(path)
    special = np.zeros(len(texts), np.int64)
    out = []
    for i, text in enumerate(texts):
        text = text or ""
        if pattern:
            text, special[i] = pattern.subn("\n", text)
        out.append((text.lower() if text.isascii() else normalizer.normalize_str(text)).encode())
    return out, special


def count_block(texts: list[str | None], vocabulary: Vocabulary, path: str) -> np.ndarray:
    """Tokens of each text."""
    ready, special = _prepared(texts, path)
    data = np.frombuffer(b"".join(ready), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in ready])]).astype(np.int64)
    if not len(data):
        return special
    starts, kept = word_starts(data, offsets)
    cuts = np.append(starts, len(data)).astype(np.int32)
    tokens = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(data)])
    coded = tokens.filter(pa.array(kept)).dictionary_encode()
    if not len(coded):
        return special
    each = word_token_counts(*_binary(coded.dictionary), vocabulary)[coded.indices.to_numpy()]
    ends = np.concatenate([[0], np.cumsum(each)])
    place = np.searchsorted(starts[kept], offsets)
    return special + ends[place[1:]] - ends[place[:-1]]


def count_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) of every row. Null texts count as empty; row order, repeated
    rows and null ids pass through; other columns are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = merged_words(path)
        for block in text_blocks(batches, "_text", BLOCK_BYTES):
            _, offsets = text_bytes(block["_text"])
            counts = count_block(block["_text"].to_pylist(), vocabulary, path)
            yield pa.RecordBatch.from_arrays([block["_id"].combine_chunks(), pa.array(np.diff(offsets)), pa.array(counts), pa.array(counts > limit)], [id_col, "n_bytes", "n_tokens", "over_limit"])

    source = df.select(df[id_col].alias("_id"), df[text_col].alias("_text"))
    return source.mapInArrow(run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, n_bytes bigint, n_tokens bigint, over_limit boolean")
