"""Words of a block of UTF-8 texts as byte ranges, and CRC-32 of many byte ranges at once.

Bytes are classified with a lookup table, words start and end where the class changes, and a table-driven CRC is
advanced by one byte in all words at the same time."""

from __future__ import annotations

import functools
import zlib

import numpy as np
import pyarrow as pa

from cairnlake.llm.common import ragged

#: Ranges longer than this are rare; the rest of each goes through zlib, which computes the same CRC.
LONG = 256


@functools.cache
def crc_table() -> np.ndarray:
    """The reflected CRC-32 of every byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


@functools.cache
def _lowered() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased; other letters stay."""
    return _lowered()[data]


@functools.cache
def _letters_digits() -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        table[low : high + 1] = True
    return table


def ascii_word_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes are of a letter or digit of ASCII, or of any character beyond ASCII."""
    return _letters_digits()[data]


def latin_word_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes are of a character in A-Z, a-z or U+00C0 to U+00FF; the latter are 0xC3 and one more byte."""
    inside = ((data | 0x20) >= 0x61) & ((data | 0x20) <= 0x7A)
    lead = data == 0xC3
    inside |= lead
    inside[1:] |= lead[:-1]
    return inside


def word_ranges(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal runs of marked bytes that cross no text, and the first word of each text
    (with an end)."""
    n = len(inside)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside])
    after = np.concatenate([inside, [False]])
    starts = np.flatnonzero(after & (edge | ~before))
    ends = np.flatnonzero(before & (edge | ~after))
    return starts, ends - starts, np.searchsorted(starts, offsets)


def crcs(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, before: np.ndarray | None = None) -> np.ndarray:
    """Unsigned CRC-32 of each range; `before` holds the CRC of what stands before each, as of zlib.crc32."""
    n = len(starts)
    state = np.full(n, 0xFFFFFFFF, np.uint32) if before is None else ~before.astype(np.uint32)
    if not n:
        return state
    table = crc_table()
    order = np.argsort(-lengths, kind="stable")
    at, size, now = starts[order], lengths[order], state[order]
    going = np.searchsorted(-size, -np.arange(min(int(size[0]), LONG)), side="left")  # ranges longer than each place
    for k, m in enumerate(going):
        own = now[:m]
        now[:m] = table[(own ^ data[at[:m] + k]) & np.uint32(255)] ^ (own >> np.uint32(8))
    for i in range(int(np.searchsorted(-size, -LONG, side="left"))):
        tail = data[at[i] + LONG : at[i] + size[i]].tobytes()
        now[i] = ~np.uint32(zlib.crc32(tail, int(~now[i])))
    out = np.empty(n, np.uint32)
    out[order] = ~now
    return out


def word_array(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The ranges as Arrow strings; they must be valid UTF-8."""
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[ragged(starts, lengths)])])
