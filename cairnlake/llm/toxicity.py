"""Toxicity scores from the nearest labelled examples.

Terms are word beginnings of 3 to 8 characters and whole words. From a bounded sample of labelled texts all those
terms are chosen that toxic texts use far more densely than others. A text's vector holds, for each term, its
occurrences per word times the term's inverse document frequency over the whole corpus, and one constant
coordinate for the rest of the text, so that a chance occurrence in a long text stays near texts without
any. Examples are searched by exact cosine through an inverted index whose posting lists are cut into
blocks with their largest weights: blocks are scored in the order of their bounds until no bound can reach the k
best. The neighbours vote with weights that fall with their distance; examples that tie for the last places
share them evenly, whatever their labels. The votes are calibrated by isotonic regression on the examples
themselves, each left out of its own vote.

The sample (at most about MOST_EXAMPLES rows by a digest of the id, one for each id) is the only bound, and with it
go the terms, the index and what the driver holds and sends out. Document frequencies are counted over all texts,
and every text is scored whole."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.llm.common import ragged, small_batches, written

MOST_EXAMPLES = 12_000
NEIGHBOURS = 15
#: Neighbours that a result names.
EVIDENCE = 5
BLOCK = 64
#: Cosines that differ by less are equal.
TIE = 1e-12
SHORT, LONG = 3, 8
#: Occurrences per word at which a term counts in full when terms are chosen.
DENSE = 1 / 40

_WORD = re.compile(r"\w+")


def word_total(text: str) -> int:
    """Words of a text, taken as white-space gaps and one."""
    return text.count(" ") + text.count("\n") + 1


def term_counts(text: str) -> Counter:
    """Occurrences of every term; whole words end with a space."""
    out: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower())).items():
        for k in range(SHORT, min(LONG, len(word)) + 1):
            out[word[:k]] += n
        out[word + " "] += n
    return out


class Finder:
    """Counts the chosen terms of a text in one pass of an Aho-Corasick automaton."""

    def __init__(self, terms: list[str]) -> None:
        by_text: dict[str, list[tuple[int, bool]]] = {}
        for i, term in enumerate(terms):
            by_text.setdefault(term.rstrip(" "), []).append((i, term.endswith(" ")))
        self.automaton = ahocorasick.Automaton()
        for word, uses in by_text.items():
            self.automaton.add_word(word, (len(word), uses))
        if by_text:
            self.automaton.make_automaton()
        self.some = bool(by_text)

    def counts(self, text: str | None) -> tuple[int, dict[int, int]]:
        """Words, and occurrences by term number."""
        if not text:
            return 1, {}
        found: dict[int, int] = {}
        if self.some:
            low = text.lower()
            size = len(low)
            for last, (length, uses) in self.automaton.iter(low):
                first = last - length
                if first >= 0 and (low[first].isalnum() or low[first] == "_"):
                    continue
                for i, whole in uses:
                    if not whole or last + 1 == size or not (low[last + 1].isalnum() or low[last + 1] == "_"):
                        found[i] = found.get(i, 0) + 1
        return word_total(text), found


@dataclass
class Postings:
    """Inverted index of example vectors; coordinate 0 is the constant one."""

    ids: np.ndarray
    labels: np.ndarray
    starts: np.ndarray  # of the postings, by term and block, and where the last block's end
    examples: np.ndarray
    weights: np.ndarray
    limits: np.ndarray  # largest weight, by term and block

    @staticmethod
    def build(vectors: list[dict[int, float]], ids: np.ndarray, labels: np.ndarray, n_terms: int) -> Postings:
        # examples with the same leading terms stand together, which keeps the block limits tight
        lead = [tuple(sorted(v, key=lambda t: (-v[t], t))[:3]) for v in vectors]
        order = sorted(range(len(vectors)), key=lambda i: (lead[i], ids[i]))
        term = np.concatenate([np.fromiter(vectors[i], np.int64, len(vectors[i])) for i in order])
        weight = np.concatenate([np.fromiter(vectors[i].values(), np.float64, len(vectors[i])) for i in order])
        example = np.repeat(np.arange(len(order)), [len(vectors[i]) for i in order])
        by_term = np.lexsort((example, term))
        term, weight, example = term[by_term], weight[by_term], example[by_term]
        n_blocks = -(-len(order) // BLOCK)
        limits = np.zeros((n_terms, n_blocks))
        np.maximum.at(limits, (term, example // BLOCK), weight)
        starts = np.searchsorted(term * (n_blocks + 1) + example // BLOCK, np.arange(n_terms * (n_blocks + 1))).reshape(n_terms, n_blocks + 1)
        return Postings(ids[order], labels[order], starts, example, weight, limits)

    def nearest(self, query: dict[int, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of largest cosine and all that tie with the last of them, best first, and their cosines."""
        terms = np.fromiter(query, np.int64, len(query))
        values = np.fromiter(query.values(), np.float64, len(query))
        bounds = values @ self.limits[terms]
        order = np.argsort(-bounds, kind="stable")
        best, cosines = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, max(8, -(-k // BLOCK))
        while at < len(order):
            if len(cosines) >= k and bounds[order[at]] < cosines[k - 1] - TIE:
                break
            blocks = np.sort(order[at : at + step])
            at, step = at + step, step * 4
            scores = np.zeros(len(blocks) * BLOCK)
            shift = (np.arange(len(blocks)) - blocks) * BLOCK
            for t, v in zip(terms, values):
                low, high = self.starts[t, blocks], self.starts[t, blocks + 1]
                own = ragged(low, high - low)
                if len(own):
                    scores[self.examples[own] + np.repeat(shift, high - low)] += v * self.weights[own]
            ids = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            real = ids < len(self.labels)
            best, cosines = np.concatenate([best, ids[real]]), np.concatenate([cosines, scores[real]])
            by = np.lexsort((best, -cosines))
            best, cosines = best[by], cosines[by]
            if len(cosines) > k:
                keep = cosines >= cosines[k - 1] - TIE
                best, cosines = best[keep], cosines[keep]
        return best, cosines


def vote(labels: np.ndarray, cosines: np.ndarray, k: int) -> tuple[float, float]:
    """Share of toxic neighbours among k, weighted by closeness, and their number. Examples come best first; those that
    tie with the k-th share the places that are left."""
    if not len(labels):
        return 0.0, 0.0
    places = np.ones(len(labels))
    if len(labels) > k:
        tied = cosines <= cosines[k - 1] + TIE
        places[tied] = (k - (~tied).sum()) / tied.sum()
    weight = places / (1.0 - np.minimum(cosines, 1.0) + 0.02)
    return float((weight * labels).sum() / weight.sum()), float((places * labels).sum())


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a rising map from votes to rates (pool adjacent violators, each pool with one prior row)."""
    base = (labels.sum() + 0.5) / (len(labels) + 1)
    pools: list[list[float]] = []  # sum of labels, rows, sum of votes
    for v in np.unique(votes):
        own = labels[votes == v]
        pools.append([float(own.sum()), float(len(own)), float(v * len(own))])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    x = np.array([p[2] / p[1] for p in pools])
    y = np.array([(p[0] + base) / (p[1] + 1) for p in pools])
    return x, np.maximum.accumulate(y)


@dataclass
class Model:
    terms: list[str]
    idf: np.ndarray
    rest: float
    index: Postings
    knots: tuple[np.ndarray, np.ndarray]

    def vector(self, words: int, found: dict[int, int]) -> dict[int, float]:
        return unit_vector(words, found, self.idf, self.rest)

    def score(self, words: int, found: dict[int, int]) -> tuple[float, float, list[dict]]:
        """(score, toxic examples among the neighbours, ties in parts, and the nearest of them)."""
        rows, cosines = self.index.nearest(self.vector(words, found), NEIGHBOURS)
        labels = self.index.labels[rows]
        share, toxic = vote(labels, cosines, NEIGHBOURS)
        shown = [{"doc_id": int(self.index.ids[i]), "toxic": int(self.index.labels[i]), "cosine": float(c)} for i, c in zip(rows[:EVIDENCE], cosines)]
        return float(np.interp(share, *self.knots)), toxic, shown


def unit_vector(words: int, found: dict[int, int], idf: np.ndarray, rest: float) -> dict[int, float]:
    total = sum(found.values())
    # a lone occurrence is weak evidence whatever the length of the text
    share = {t + 1: n / words * idf[t] * total / (total + 1) for t, n in found.items()}
    norm = (sum(v * v for v in share.values()) + rest * rest) ** 0.5
    return {0: rest / norm} | {t: v / norm for t, v in share.items()}


def held_out(id_col: str = "doc_id"):
    """Rows that labels are never learnt from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, label) of at most about MOST_EXAMPLES labelled ids outside the held-out part; of the rows that
    share an id, the first by its text. The sample is written, so documents are read once for it."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("label"))
    rate = min(1.0, MOST_EXAMPLES / max(1, known.count()))
    drawn = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("double") < rate * 2.0**32
    texts = documents.where(drawn & ~held_out()).join(known.where(drawn), "doc_id").groupBy("doc_id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    return written(texts.select("doc_id", "text", "label"))


def _choose_terms(sample: DataFrame, n_toxic: int, n_other: int) -> list[str]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use: dict[str, list[float]] = {}
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = word_total(text)
                for term, n in term_counts(text).items():
                    use.setdefault(term, [0.0, 0.0])[label] += min(1.0, n / words / DENSE)
        # a term that no toxic text of this partition uses still counts against itself
        terms = list(use)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([use[t][1] for t in terms], pa.float64()), pa.array([use[t][0] for t in terms], pa.float64())], ["term", "toxic", "other"])

    each = sample.select("text", "label").mapInArrow(run, "term string, toxic double, other double")
    rate = lambda c, n: F.col(c) / max(1, n)
    sums = each.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    good = sums.where((F.col("toxic") >= max(1.5, 0.002 * n_toxic)) & (rate("toxic", n_toxic) >= 5 * rate("other", n_other)))
    return sorted(r[0] for r in good.select("term").collect())  # terms of the sample, which is bounded


def _document_frequencies(documents: DataFrame, terms: list[str]) -> tuple[int, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, seen, rows = Finder(terms), Counter(), 0
        for batch in batches:
            for text in batch.column(0):
                seen.update(finder.counts(text.as_py())[1].keys())
                rows += 1
        seen[-1] = rows
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["term", "n"])

    got = {r[0]: r[1] for r in documents.select("text").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n")).collect()}
    return int(got.get(-1, 0) or 0), np.array([got.get(t, 0) for t in range(len(terms))], np.float64)


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """documents: (doc_id, text); labels: (doc_id, toxic). Without toxic or without other examples, every score
    is the rate of the sample."""
    sample = _sample(documents.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    sizes = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    terms = _choose_terms(sample, n_toxic, n_other) if n_toxic and n_other else []
    total, frequency = _document_frequencies(documents, terms)
    idf = np.log((1 + total) / (1 + frequency)) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(terms)
        for batch in batches:
            made = [finder.counts(text) for text in batch.column(1).to_pylist()]
            pairs = pa.array([list(found.items()) for _, found in made], pa.map_(pa.int32(), pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([w for w, _ in made], pa.int64()), pairs], ["doc_id", "label", "words", "found"])

    rows = sample.mapInArrow(run, "doc_id bigint, label int, words bigint, found map<int,int>").collect()
    rows.sort(key=lambda r: r["doc_id"])
    label, ids = np.array([r["label"] for r in rows], np.float64), np.array([r["doc_id"] for r in rows], np.int64)
    size = lambda r: sum((n / r["words"] * idf[t]) ** 2 for t, n in r["found"].items()) ** 0.5
    toxic = [s for r in rows if r["label"] == 1 and (s := size(r)) > 0]
    rest = 0.5 * float(np.median(toxic)) if toxic else 1.0
    vectors = [unit_vector(r["words"], r["found"], idf, rest) for r in rows] or [{0: 1.0}]
    label, ids = (label, ids) if len(rows) else (np.zeros(1), np.full(1, -1))
    index = Postings.build(vectors, ids, label, len(terms) + 1)
    votes = []
    known: dict[tuple, float] = {}  # equal vectors of equal labels have equal votes
    for v, own in zip(vectors, label):
        key = (own, *sorted(v.items()))
        if key not in known:
            rows_, cosines = index.nearest(v, NEIGHBOURS + 1)
            same = np.flatnonzero((index.labels[rows_] == own) & (cosines > 1 - 1e-9))
            drop = same[0] if len(same) else len(rows_) - 1  # itself, or one that equals it
            known[key] = vote(np.delete(index.labels[rows_], drop), np.delete(cosines, drop), NEIGHBOURS)[0]
        votes.append(known[key])
    return Model(terms, idf, rest, index, isotonic(np.array(votes), label))


RESULT = "score double, predicted int, toxic_neighbours double, terms array<string>, evidence array<struct<doc_id: bigint, toxic: int, cosine: double>>"


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(id_col, score, predicted, toxic_neighbours, terms, evidence) of every row, and the columns named in keep, but
    for those that share a name with these. terms lists the densest terms found, evidence the nearest examples.
    Null and empty texts are scored like texts without terms; repeated rows and null ids pass through."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by MOST_EXAMPLES
    own = [id_col, "score", "predicted", "toxic_neighbours", "terms", "evidence"]
    kept = [c for c in keep or [] if c not in own]
    names = [f"keep_{i}" for i in range(len(kept))]
    shown = pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.int32()), ("cosine", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        finder = Finder(model.terms)
        plain = model.score(1, {})
        for batch in batches:
            scores, near, terms, evidence = [], [], [], []
            for text in batch.column(1):
                words, found = finder.counts(text.as_py())
                s, n, e = model.score(words, found) if found else plain
                scores.append(s)
                near.append(n)
                terms.append([model.terms[t] for t in sorted(found, key=lambda t: (-found[t], t))[:8]])
                evidence.append(e)
            values = np.array(scores)
            made = [pa.array(values), pa.array((values >= 0.5).astype(np.int32)), pa.array(near, pa.float64()), pa.array(terms, pa.list_(pa.string())), pa.array(evidence, shown)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, *[batch.column(2 + i) for i in range(len(names))]], ["id", "score", "predicted", "toxic_neighbours", "terms", "evidence", *names])

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *[F.col(c).alias(k) for c, k in zip(kept, names)])
    schema = f"id {df.schema[id_col].dataType.simpleString()}, {RESULT}" + "".join(f", {k} {df.schema[c].dataType.simpleString()}" for c, k in zip(kept, names))
    out = rows.mapInArrow(run, schema)
    return out.select(F.col("id").alias(id_col), "score", "predicted", "toxic_neighbours", "terms", "evidence", *[F.col(k).alias(c) for c, k in zip(kept, names)])
