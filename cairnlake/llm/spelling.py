"""Spelling variants: words of the corpus grouped with near words, by a trie self-join with active-node sets.

Two words that differ by one inserted, deleted or replaced code point, the longer of L code points, share a beginning
and an end of L - 1 code points together. So the first L // 2 or the last L - L // 2 code points agree, and the vocabulary
is cut by these beginnings and ends: a word of l code points enters the groups of L = l and L = l + 1, twice
each. A task holds the tries of its groups, for ends on reversed words, and goes down level by level. The active nodes
of a node are those within distance one: at distance zero itself, at distance one its children, the children of
its parent, and the children of active nodes that go on with the same code point. Where a node and an active
node both end a word, the pair is emitted; a pair that beginnings find is left out among the ends.

Only nodes with at least two words below start active sets, so a level costs what may still match."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.llm.byte_words import crcs, latin_word_bytes, lower_ascii, word_array, word_ranges
from cairnlake.llm.common import ragged, shuffle_partitions, small_batches, text_blocks, text_bytes, written

LEAST_CHARS = 6
LEAST_COUNT = 5
#: A form is so many times as frequent as its variant.
RATIO = 5
#: One run in so many loses a code point.
SLIP = 199
BLOCK_BYTES = 8 << 20
#: Words in the groups of one task, about.
TASK_WORDS = 400_000


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, slip: int | None = SLIP) -> DataFrame:
    """(word, n) of all texts: maximal runs of Latin letters with A-Z lower-cased, of at least least_chars code points.

    With `slip`, a run whose CRC-32 behind its row's id and a colon is divisible by it loses the code point that the CRC
    modulo its length names. Null texts have no words, null ids count as empty."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "_text", BLOCK_BYTES):
            data, offsets = text_bytes(block["_text"])
            data = lower_ascii(data)
            starts, lengths, first = word_ranges(latin_word_bytes(data), offsets)
            places = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            chars = places[starts + lengths] - places[starts]
            whole, slipped = chars >= least_chars, []
            if slip:
                ids = np.array([zlib.crc32(f"{i}:".encode()) for i in block["_id"].to_pylist()], np.uint32)
                h = crcs(data, starts, lengths, np.repeat(ids, np.diff(first)))
                for k in np.flatnonzero((h % np.uint32(slip) == 0) & (chars > least_chars)):
                    word = data[starts[k] : starts[k] + lengths[k]].tobytes().decode()
                    gone = int(h[k]) % len(word)
                    slipped.append(word[:gone] + word[gone + 1 :])
                whole &= h % np.uint32(slip) != 0
            words = pa.chunked_array([word_array(data, starts[whole], lengths[whole]), pa.array(slipped, pa.large_string())])
            counted = pc.value_counts(words)
            yield pa.RecordBatch.from_arrays([counted.field(0).cast(pa.string()), counted.field(1)], ["word", "n"])

    rows = df.select(F.coalesce(df[id_col].cast("string"), F.lit("")).alias("_id"), df[text_col].alias("_text"))
    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Level:
    """The nodes at one depth, in the order of parent and code point."""

    parent: np.ndarray
    char: np.ndarray
    words: np.ndarray  # below each node, its own included
    ends: np.ndarray  # the word that ends here, or -1
    rows: np.ndarray  # words that reach this depth
    node: np.ndarray  # and the node of each

    def children(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """If this is the next level: first child and number of children of each node."""
        low, high = np.searchsorted(self.parent, nodes), np.searchsorted(self.parent, nodes, side="right")
        return low, high - low

    def find(self, parents: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The child of each parent by its code point, or -1."""
        if not len(self.parent):
            return np.full(len(parents), -1)
        key, want = self.parent << 21 | self.char, parents << 21 | chars
        at = np.minimum(np.searchsorted(key, want), len(key) - 1)
        return np.where(key[at] == want, at, -1)


class Trie:
    """The words of some groups, as code points; levels are made when they are asked for."""

    def __init__(self, group: np.ndarray, chars: np.ndarray, offsets: np.ndarray) -> None:
        """Rows come ordered by group, then by code points; no group holds a word twice."""
        self.chars, self.offsets, self.lengths = chars, offsets, np.diff(offsets)
        node = np.unique(group, return_inverse=True)[1]
        rows = np.arange(len(group))
        self.levels = [self._level(np.zeros(0, np.int64), np.zeros(0, np.int64), rows, node, 0)]

    def _level(self, parent: np.ndarray, char: np.ndarray, rows: np.ndarray, node: np.ndarray, depth: int) -> Level:
        n = int(node[-1]) + 1 if len(node) else 0
        ends = np.full(n, -1)
        last = self.lengths[rows] == depth
        ends[node[last]] = rows[last]
        return Level(parent, char, np.bincount(node, minlength=n), ends, rows, node)

    def level(self, depth: int) -> Level:
        while len(self.levels) <= depth:
            above, at = self.levels[-1], len(self.levels) - 1
            on = self.lengths[above.rows] > at
            rows, node = above.rows[on], above.node[on]
            char = self.chars[self.offsets[rows] + at].astype(np.int64)
            new = np.ones(len(rows), bool)
            new[1:] = (node[1:] != node[:-1]) | (char[1:] != char[:-1])
            self.levels.append(self._level(node[new], char[new], rows, np.cumsum(new) - 1, at + 1))
        return self.levels[depth]

    def _go_on(self, x: np.ndarray, y: np.ndarray, below_x: Level, below_y: Level) -> tuple[np.ndarray, np.ndarray]:
        """Children of both nodes of each pair by the same code point."""
        low, n = below_x.children(x)
        child = ragged(low, n)
        other = below_y.find(np.repeat(y, n), below_x.char[child])
        return child[other >= 0], other[other >= 0]

    def near(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, rows) of words of one group at distance one. In the second half of each yield the second is longer."""
        none = np.zeros(0, np.int64)
        same, long = (none, none), (none, none)  # active pairs: of one depth, and with the second node one deeper
        depth = 0
        while True:
            here, below, deeper = self.level(depth), self.level(depth + 1), self.level(depth + 2)
            crowd = np.flatnonzero(here.words > 1)
            low, n = below.children(crowd)
            child = ragged(low, n)
            code = np.unique(np.concatenate([long[0] << 32 | long[1], np.repeat(crowd, n) << 32 | child]))  # an insertion into a run has several ways
            long = code >> 32, code & 0xFFFFFFFF
            for (x, y), level in ((same, here), (long, below)):
                ends = (here.ends[x] >= 0) & (level.ends[y] >= 0)
                if ends.any():
                    yield here.ends[x[ends]], level.ends[y[ends]]
            if not len(crowd) and not len(same[0]) and not len(long[0]):
                return
            # children of one node pair with the later ones
            later = np.repeat(low + n, n) - child - 1
            first, second = np.repeat(child, later), ragged(child + 1, later)
            x, y = self._go_on(*same, below, below)
            same = np.concatenate([first, x]), np.concatenate([second, y])
            long = self._go_on(*long, below, deeper)
            depth += 1


def _near_rows(side: np.ndarray, size: np.ndarray, words: list[str], n: np.ndarray) -> tuple[list[str], list[str], np.ndarray]:
    """(word, near word, its n), both ways, of the groups that the rows (side, size, word) form."""
    keys = []
    for s, L, w in zip(side.tolist(), size.tolist(), words):
        cut = L // 2 if not s else L - L // 2
        u = w[::-1] if s else w
        keys.append((s, L, u[:cut], u[cut:]))
    order = sorted(range(len(keys)), key=keys.__getitem__)
    head = [keys[i][:3] for i in order]
    joined = [k > 0 and head[k] == head[k - 1] for k in range(len(head))]
    kept = [k for k in range(len(head)) if joined[k] or (k + 1 < len(head) and joined[k + 1])]  # lone words drop out
    if not kept:
        return [], [], np.zeros(0, np.int64)
    group = np.cumsum([not joined[k] for k in kept])
    rows = np.array([order[k] for k in kept])
    rest = [keys[i][3] for i in rows]
    chars = np.frombuffer("".join(rest).encode("utf-32-le"), np.uint32)
    trie = Trie(group, chars, np.concatenate([[0], np.cumsum([len(r) for r in rest])]))
    left, right, counts = [], [], []
    for a, b in trie.near():
        for i, j in zip(rows[a].tolist(), rows[b].tolist()):
            x, y, L = words[i], words[j], int(size[i])
            if max(len(x), len(y)) == L and not (side[i] and x[: L // 2] == y[: L // 2]):
                left += (x, y)
                right += (y, x)
                counts += (n[j], n[i])
    return left, right, np.array(counts, np.int64)


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n) for every two words of the vocabulary (word, n), each named once, that differ by exactly one
    inserted, deleted or replaced code point; both ways."""
    spark = vocabulary.sparkSession
    small_batches(spark)
    total = vocabulary.count()
    size = F.length("word")
    uses = [F.struct(F.lit(s).cast("byte").alias("side"), (size + more).alias("size")) for s in (0, 1) for more in (0, 1)]
    rows = vocabulary.select("word", "n", F.explode(F.array(*uses)).alias("u")).select("u.side", "u.size", "word", "n")
    cut = (F.col("size") / 2).cast("int")
    key = F.when(F.col("side") == 0, F.substring("word", F.lit(1), cut)).otherwise(F.reverse(F.substring(F.reverse("word"), F.lit(1), F.col("size") - cut)))
    parts = max(shuffle_partitions(spark), -(-4 * total // TASK_WORDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        whole = pa.Table.from_batches(held)
        number = lambda c: whole[c].to_numpy()
        word, near, n = _near_rows(number("side"), number("size"), whole["word"].to_pylist(), number("n"))
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(n)], ["word", "near", "near_n"])

    return rows.repartition(parts, "size", "side", key).mapInArrow(run, "word string, near string, near_n bigint")


def with_roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every word that has a form: forms followed to a word without one. A form is several times as
    frequent as its variant, so chains are short and have no circles; each round doubles the steps that are covered."""
    now = written(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not now.join(ahead, "root", "left_semi").take(1):
            return now
        now = written(now.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")))


def variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, ratio: int = RATIO, slip: int | None = SLIP) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least least_count occurrences.

    A word's form is its most frequent near word (of equal ones the first by code points) if that is at least ratio
    times as frequent, else null. Words are cut only at the ends of runs, whatever their length. Without rows, or where all
    texts are null or empty, there are no words; rows that repeat count again."""
    words = written(word_counts(df, id_col, text_col, least_chars, slip).where(F.col("n") >= least_count))
    best = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    joined = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(-F.col("best.m") >= ratio * F.col("n"), F.col("best")).alias("best"))
    formed = written(joined.select("word", F.col("best.near").alias("form"), "n", "n_near", (-F.col("best.m")).alias("form_n")))
    out = formed.join(with_roots(formed), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
