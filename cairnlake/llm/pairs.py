"""Merge tables of public byte-pair tokenizers as arrays that answer many pair lookups at once."""

from __future__ import annotations

import base64
import functools
import json
from dataclasses import dataclass

import numpy as np

NONE = np.int32(2**31 - 1)
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Open addressing over (left id, right id) -> (rank, merged id)."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(len(left) * 4 + 1))))
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NONE, np.int32)
        self.merged = np.full(size, -1, np.int32)
        self.reach = 1
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        todo = np.arange(len(keys))
        slot = self._home(keys)
        step = 0
        while len(todo):
            at = (slot[todo] + step) & (size - 1)
            free = self.keys[at] == -1
            _, chosen = np.unique(at[free], return_index=True)
            win = np.flatnonzero(free)[chosen]
            self.keys[at[win]] = keys[todo[win]]
            self.ranks[at[win]] = rank[todo[win]]
            self.merged[at[win]] = merged[todo[win]]
            keep = np.ones(len(todo), bool)
            keep[win] = False
            todo = todo[keep]
            step += 1
        self.reach = step

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, or -1; negative ids match nothing."""
        keys = (left.astype(np.int64) << 32) | right.astype(np.int64)
        mask = len(self.keys) - 1
        at = self._home(keys)
        held = self.keys[at]
        out = np.where(held == keys, at, -1)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        for _ in range(1, self.reach):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & mask
            held = self.keys[at[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = at[open_[hit]]
            open_ = open_[~hit & (held != -1)]
        out[(left < 0) | (right < 0)] = -1
        return out


@dataclass(frozen=True)
class Vocabulary:
    pairs: PairTable
    first: np.ndarray  # id of each single byte
    final: np.ndarray  # id of each single byte at the end of a word
    token_bytes: np.ndarray  # bytes of all tokens, one after the other
    token_offsets: np.ndarray
    early: np.ndarray  # by id: a pair with this token can have a lower rank than the token itself


@functools.cache
def ranked_bytes(path: str) -> Vocabulary:
    """A rank file: any two neighbours whose bytes together are a token merge into it, lowest rank first."""
    ranks: dict[bytes, int] = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    left, right, rank = [], [], []
    for token, r in ranks.items():
        for cut in range(1, len(token)):
            a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                rank.append(r)
    left_, right_, rank_ = (np.array(x, np.int64) for x in (left, right, rank))
    n = max(ranks.values()) + 1
    early = np.zeros(n, bool)
    early[left_[rank_ < left_]] = True
    early[right_[rank_ < right_]] = True
    by_id = [b""] * n
    for token, r in ranks.items():
        by_id[r] = token
    single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in by_id])]).astype(np.int64)
    return Vocabulary(PairTable(left_, right_, rank_, rank_), single, single, np.frombuffer(b"".join(by_id), np.uint8), offsets, early)


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(spare)) for b in range(256)]


@functools.cache
def merged_words(path: str) -> Vocabulary:
    """A tokenizer file with a merge list and an end-of-word suffix."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in merges], np.int64)
    right = np.array([vocab[b] for _, b in merges], np.int64)
    merged = np.array([vocab[a + b] for a, b in merges], np.int64)
    rank = np.arange(len(merges), dtype=np.int64)
    letters = byte_letters()
    made = np.full(max(vocab.values()) + 1, -1, np.int64)
    made[merged] = rank
    early = np.zeros(len(made), bool)
    early[left[rank < made[left]]] = True
    early[right[rank < made[right]]] = True
    return Vocabulary(
        PairTable(left, right, rank, merged),
        np.array([vocab[c] for c in letters], np.int32),
        np.array([vocab[c + suffix] for c in letters], np.int32),
        np.zeros(0, np.uint8),
        np.zeros(1, np.int64),
        early,
    )
