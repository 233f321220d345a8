"""Vectorised splitting of UTF-8 text into the pre-tokens of two public tokenizers.

Both patterns only look at four classes of characters: letters, numbers, white space and the rest.
A block of many texts is classified byte by byte with lookup tables, and the token starts follow from
where the class changes, so no regular expression runs over the text."""

from __future__ import annotations

import functools

import numpy as np
import tiktoken
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def every_character() -> str:
    return "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))


def _table(letters: str, numbers: str) -> np.ndarray:
    kinds = np.zeros(0x110000, np.uint8)
    for kind, members in ((LETTER, letters), (NUMBER, numbers), (SPACE, WHITE_SPACE)):
        kinds[np.frombuffer(members.encode("utf-32-le"), np.uint32)] = kind
    return kinds


@functools.cache
def spaced_classes() -> np.ndarray:
    """The class of every code point, by the character data of the library whose pattern spaced_starts() follows.

    The libraries differ from each other and from Python in their version of Unicode. An encoding of single bytes
    drops what its pattern does not match, so one call tells all characters of a class."""
    single = {bytes([i]): i for i in range(256)}
    found = [bytes(tiktoken.Encoding("class", pat_str=p, mergeable_ranks=single, special_tokens={}).encode_ordinary(every_character())).decode() for p in (r"\p{L}+", r"\p{N}+")]
    return _table(*found)


@functools.cache
def word_classes() -> np.ndarray:
    """Like spaced_classes(), by the library whose pattern word_starts() follows."""
    found = [Split(Regex(p), "removed", invert=True).pre_tokenize_str(every_character()) for p in (r"\p{L}+", r"\p{N}+")]
    return _table(*["".join(piece for piece, _ in pieces) for pieces in found])


def byte_classes(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The class of the character that each byte belongs to."""
    ascii_only = np.zeros(256, np.uint8)
    ascii_only[:128] = table[:128]
    out = ascii_only[data]
    for low, high, width in ((0xC0, 0xE0, 2), (0xE0, 0xF0, 3), (0xF0, 0x100, 4)):
        at = np.flatnonzero((data >= low) & (data < high)) if high < 0x100 else np.flatnonzero(data >= low)
        at = at[at + width <= len(data)]
        if not len(at):
            continue
        point = (data[at] & (0xFF >> (width + 1))).astype(np.int64)
        for k in range(1, width):
            point = (point << 6) | (data[at + k] & 0x3F)
        kind = table[np.minimum(point, 0x10FFFF)]
        for k in range(width):
            out[at + k] = kind
    return out


def _runs(data: np.ndarray, kinds: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of one class start, and where texts start."""
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    first = first[: len(data)]
    run = first.copy()
    run[1:] |= kinds[1:] != kinds[:-1]
    return run, first


def _contractions(data: np.ndarray, kinds: np.ndarray, starts: np.ndarray, first: np.ndarray) -> None:
    """'s 't 'm 'd 're 've 'll at a token start are tokens of their own."""
    n = len(data)
    at = np.flatnonzero((data == 0x27) & starts)
    at = at[at + 1 < n]
    at = at[~first[at + 1] & (kinds[at + 1] == LETTER)]
    if not len(at):
        return
    one = np.isin(data[at + 1], np.frombuffer(b"stmd", np.uint8))
    rest = at[~one]
    rest = rest[rest + 2 < n]
    rest = rest[~first[rest + 2]]
    a, b = data[rest + 1], data[rest + 2]
    two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    for where, width in ((at[one], 1), (rest[two], 2)):
        starts[where + 1] = False
        after = where + 1 + width
        after = after[after < n]
        after = after[~first[after] & (kinds[after] == LETTER)]
        starts[after] = True


def spaced_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Byte positions where the tokens of `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+`
    start. The tokens cover every byte, and none crosses a text."""
    if not len(data):
        return np.zeros(0, np.int64)
    kinds = byte_classes(data, spaced_classes())
    starts, first = _runs(data, kinds, offsets)
    ends = np.flatnonzero(starts[1:] & (kinds[1:] != SPACE) & (kinds[:-1] == SPACE)) + 1
    ends = ends[~first[ends]]
    last = ends - 1
    for _ in range(3):
        last = np.where((data[last] & 0xC0) == 0x80, last - 1, last)
    starts[last] = True
    starts[ends[data[last] == 0x20]] = False
    _contractions(data, kinds, starts, first)
    return np.flatnonzero(starts)


def word_starts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the tokens of `'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+` and of the white space
    between them, and which of them are tokens."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, bool)
    kinds = byte_classes(data, word_classes())
    starts, first = _runs(data, kinds, offsets)
    starts |= (kinds == NUMBER) & ((data & 0xC0) != 0x80)
    _contractions(data, kinds, starts, first)
    at = np.flatnonzero(starts)
    return at, kinds[at] != SPACE
