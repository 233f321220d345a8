"""Quality scores by a vote of the nearest labelled examples in a latent-semantic space.

Terms of a text are hashed: its words, the shapes of its words (classes of characters, runs collapsed), pairs of
shapes that follow each other, and whether a word repeats one of the two before it. A bounded sample of labelled texts gives a
matrix of logarithmic term frequencies times inverse document frequencies, which count all texts; its leading right singular
vectors are the latent space. The examples' vectors are broadcast, every document is projected, and blocks of documents are
multiplied with all examples: the cosines are exact, no example is left out. The nearest vote with weights that grow with
their cosine; examples that tie for the last place share it. Votes are calibrated by isotonic regression on the examples
themselves, each without its own vote.

The sample (at most about MOST_EXAMPLES rows by a digest of the id) and the number of terms bound the model. Texts are read
whole, and every document is scored."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairnlake.llm.byte_words import lower_ascii, word_ranges
from cairnlake.llm.common import mix64, small_batches, text_blocks, text_bytes, written
from cairnlake.llm.toxicity import isotonic

MOST_EXAMPLES = 6_000
NEIGHBOURS = 15
DIMENSIONS = 48
#: A score from here on predicts label 1.
GOOD = 0.7
#: Hashed terms of each kind: words, shapes, pairs of shapes, repeats.
WORDS, SHAPES, PAIRS, REPEATS = 2048, 1024, 1024, 4
TERMS = WORDS + SHAPES + PAIRS + REPEATS
BLOCK_BYTES = 4 << 20
#: Documents whose cosines with all examples are held at once.
TILE = 256
#: Cosines that differ by less are equal.
TIE = 1e-9


def _shape_classes() -> np.ndarray:
    """The class of each byte: white space 0, small letters and what is beyond ASCII 1, capitals 2, digits 3, and each
    other byte its own."""
    table = np.arange(256, dtype=np.uint8)
    for low, high, kind in ((0x09, 0x0D, 0), (0x20, 0x20, 0), (0x61, 0x7A, 1), (0x80, 0xFF, 1), (0x41, 0x5A, 2), (0x30, 0x39, 3)):
        table[low : high + 1] = kind
    return table


_CLASSES = _shape_classes()


#: An odd base of polynomial hashes modulo 2 ** 64, and its inverse.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


@functools.lru_cache(2)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, out=out)


def _hashed(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each range of values: differences of prefix sums, moved back to a common place."""
    n = 1 << max(len(values), 1).bit_length()  # tables for blocks of about one size are made once
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers(BASE, n)[: len(values)], out=prefix[1:])
    return mix64((prefix[starts + lengths] - prefix[starts]) * _powers(INVERSE, n)[starts])


def term_matrix(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first entry of each text and the end, terms, counts): the terms of each text in rising order."""
    n = len(offsets) - 1
    kinds = _CLASSES[data]
    starts, lengths, first = word_ranges(kinds != 0, offsets)
    text = np.repeat(np.arange(n), np.diff(first))
    if not len(starts):
        return np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = _hashed(lower_ascii(data), starts, lengths)
    fresh = np.zeros(len(data), bool)
    fresh[1:] = kinds[1:] != kinds[:-1]
    fresh[starts] = True
    at = np.flatnonzero(fresh & (kinds != 0))  # one byte for each run of a class
    low = np.searchsorted(at, starts)
    # a run of marks longer than one is a mark of its own
    length = np.diff(np.append(at, len(data)))
    stop = np.repeat(starts + lengths, np.diff(np.append(low, len(at))))
    many = (np.minimum(length, stop - at) > 1) & (kinds[at] > 3)
    shape = _hashed(kinds[at].astype(np.uint64) * np.uint64(2) + many, low, np.diff(np.append(low, len(at))))
    follows = np.flatnonzero(text[1:] == text[:-1]) + 1
    again = follows[word[follows] == word[follows - 1]]
    second = np.flatnonzero(text[2:] == text[:-2]) + 2
    second = second[word[second] == word[second - 2]]
    pair = mix64(shape[follows] + shape[follows - 1] * np.uint64(3))
    modulo = lambda h, m: (h % np.uint64(m)).astype(np.int64)
    base = np.cumsum([0, WORDS, SHAPES, PAIRS])
    terms = [base[0] + modulo(word, WORDS), base[1] + modulo(shape, SHAPES), base[2] + modulo(pair, PAIRS), np.full(len(again), base[3]), np.full(len(second), base[3] + 1)]
    texts = [text, text, text[follows], text[again], text[second]]
    code, count = np.unique(np.concatenate(texts) * TERMS + np.concatenate(terms), return_counts=True)
    return np.searchsorted(code // TERMS, np.arange(n + 1)), code % TERMS, count


def _times(first: np.ndarray, columns: np.ndarray, weights: np.ndarray, dense: np.ndarray) -> np.ndarray:
    """A sparse matrix by rows times a dense one, some rows at a time."""
    out = np.zeros((len(first) - 1, dense.shape[1]), np.float64)
    for low in range(0, len(out), TILE):
        high = min(low + TILE, len(out))
        a, b = first[low], first[high]
        if b > a:
            full = low + np.flatnonzero(np.diff(first[low : high + 1]))
            out[full] = np.add.reduceat(dense[columns[a:b]] * weights[a:b, None], first[full] - a)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, size, out=np.zeros_like(rows), where=size > 1e-12)


def latent_space(first: np.ndarray, columns: np.ndarray, weights: np.ndarray, dimensions: int = DIMENSIONS, rounds: int = 4) -> np.ndarray:
    """The leading right singular vectors of a sparse matrix with TERMS columns, by subspace iteration."""
    n = len(first) - 1
    order = np.argsort(columns, kind="stable")
    down, rows = np.searchsorted(columns[order], np.arange(TERMS + 1)), np.repeat(np.arange(n), np.diff(first))[order]
    space = np.linalg.qr(np.random.default_rng(1).standard_normal((TERMS, dimensions)))[0]
    for _ in range(rounds):
        space = np.linalg.qr(_times(down, rows, weights[order], _times(first, columns, weights, space)))[0]
    return space


@dataclass
class Model:
    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray  # of the examples, of length 1 or 0
    labels: np.ndarray
    knots: tuple[np.ndarray, np.ndarray]

    def weights(self, first: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weighted(first, terms, counts, self.idf)

    def project(self, first: np.ndarray, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _unit(_times(first, terms, self.weights(first, terms, counts), self.space))

    def votes(self, rows: np.ndarray, own: np.ndarray | None = None, k: int = NEIGHBOURS) -> np.ndarray:
        """The vote of the k nearest examples of each row; `own` names an example that has none in it."""
        out = np.zeros(len(rows))
        k = min(k, len(self.labels) - (own is not None))
        if k <= 0:
            return out
        for low in range(0, len(rows), TILE):
            tile = rows[low : low + TILE]
            cosines = tile @ self.vectors.T
            if own is not None:
                cosines[np.arange(len(tile)), own[low : low + TILE]] = -2.0
            last = np.partition(cosines, -k, axis=1)[:, -k, None]
            near = cosines >= last - TIE
            row, example = np.nonzero(near)
            c = cosines[row, example]
            tied = c <= last[row, 0] + TIE
            sure, ties = np.bincount(row[~tied], minlength=len(tile)), np.bincount(row[tied], minlength=len(tile))
            weight = np.where(tied, ((k - sure) / np.maximum(ties, 1))[row], 1.0) * (np.maximum(c, 0.0) ** 2 + 1e-3)
            out[low : low + TILE] = np.bincount(row, weight * self.labels[example], len(tile)) / np.bincount(row, weight, len(tile))
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(self.votes(rows), *self.knots)


def weighted(first: np.ndarray, terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Logarithmic frequencies times inverse document frequencies; the three kinds of terms have equal lengths in a
    text, so a long text's many words leave room for the shapes. Repeats go with the share of words that are some."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    w = (1 + np.log(counts)) * idf[terms]
    kind = np.searchsorted([WORDS, WORDS + SHAPES, WORDS + SHAPES + PAIRS], terms, side="right")
    repeats = kind == 3
    length = np.sqrt(np.bincount(text * 4 + kind, w * w, minlength=4 * (len(first) - 1)))
    w = w / length[text * 4 + kind] * np.array([0.5, 1.0, 1.0, 0.0])[kind]
    words = np.bincount(text[kind == 0], counts[kind == 0], minlength=len(first) - 1)
    w[repeats] = 2 * counts[repeats] / np.maximum(words[text[repeats]], 1)
    return w


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that labels are never learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(documents: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """(id, text, label) of at most about `most` labelled ids outside the held-out part. A digest of the id draws them, so
    both tables are filtered before they meet; rows that share an id count once, with the smallest label and text."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
    rate = min(1.0, most / max(1, known.count()))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit("quality:"), F.col("doc_id").cast("string"))), 1, 8), 16, 10).cast("double") < rate * 2.0**32
    texts = documents.where(drawn & ~held_out()).join(known.where(drawn), "doc_id").groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return written(texts.select(F.col("doc_id").cast("string").alias("id"), "text", "label"))


def _document_frequencies(documents: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and how many texts hold each term: TERMS numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TERMS + 1, np.int64)
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            _, terms, _ = term_matrix(*text_bytes(block["text"]))
            total[:TERMS] += np.bincount(terms, minlength=TERMS)
            total[TERMS] += block.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1)), pa.array(total)], ["term", "n"])

    out = np.zeros(TERMS + 1, np.int64)
    for term, n in documents.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect():
        out[term] = n
    return int(out[TERMS]), out[:TERMS].astype(np.float64)


def fit(documents: DataFrame, labels: DataFrame, most: int = MOST_EXAMPLES) -> Model:
    """documents: (doc_id, text); labels: (doc_id, quality). Other columns are never looked at. Without labels every
    score is one half; with labels of one kind alone, near that label."""
    small_batches(documents.sparkSession)
    sample = _sample(documents.select("doc_id", "text"), labels.select("doc_id", "quality"), most)
    total, frequency = _document_frequencies(documents)
    idf = np.log((1 + total) / (1 + frequency)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in text_blocks(batches, "text", BLOCK_BYTES):
            first, terms, counts = term_matrix(*text_bytes(block["text"]))
            rows = list(zip(first[:-1], first[1:]))
            packed = [pa.array([a[i:j].tobytes() for i, j in rows], pa.binary()) for a in (terms.astype(np.uint16), counts.astype(np.int32))]
            yield pa.RecordBatch.from_arrays([block["id"].combine_chunks(), block["label"].combine_chunks(), *packed], ["id", "label", "terms", "counts"])

    rows = sorted(sample.mapInArrow(run, "id string, label int, terms binary, counts binary").collect(), key=lambda r: r["id"])  # bounded by `most`
    terms = [np.frombuffer(r["terms"], np.uint16) for r in rows]
    first = np.concatenate([[0], np.cumsum([len(t) for t in terms])]).astype(np.int64)
    columns = np.concatenate([*terms, np.zeros(0, np.uint16)]).astype(np.int64)
    counts = np.concatenate([np.frombuffer(r["counts"], np.int32) for r in rows] + [np.zeros(0, np.int32)]).astype(np.int64)
    label = np.array([r["label"] for r in rows], np.float64)
    w = weighted(first, columns, counts, idf)
    model = Model(idf, latent_space(first, columns, w), np.zeros((0, DIMENSIONS)), label, (np.zeros(1), np.full(1, 0.5)))
    if len(rows):
        model.vectors = model.project(first, columns, counts)
        model.knots = isotonic(model.votes(model.vectors, np.arange(len(rows))), label)
    return model


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", good: float = GOOD) -> DataFrame:
    """(id_col, score, predicted, vote) of every row; vote is what the neighbours say before calibration.

    Null, empty and blank texts have no direction: all examples are equally far, and their vote is the rate of the sample.
    Repeated rows and null ids pass through; other columns are left out."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by the sample and TERMS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for block in text_blocks(batches, "_text", BLOCK_BYTES):
            votes = model.votes(model.project(*term_matrix(*text_bytes(block["_text"]))))
            scores = np.interp(votes, *model.knots)
            yield pa.RecordBatch.from_arrays([block["_id"].combine_chunks(), pa.array(scores), pa.array((scores >= good).astype(np.int32)), pa.array(votes)], [id_col, "score", "predicted", "vote"])

    rows = df.select(df[id_col].alias("_id"), df[text_col].alias("_text"))
    return rows.mapInArrow(run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, score double, predicted int, vote double")
