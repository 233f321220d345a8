"""Importance resampling of documents towards a target distribution, on hashed word n-grams.

A byte automaton reads the UTF-8 buffers of a block of texts: a lookup table marks the bytes of words, differences give
their ends, and the CRC-32 of every feature is advanced at once, through its words and the spaces between them. Bucket
counts of the corpus and of the target are sums over all texts; each task adds up its own first. A document's weight
is the mean log ratio of its features, its score adds noise that depends on its id alone, and the highest scores are drawn.

Ranks need no global sort: the scores are whole numbers of a range that grows with the logarithm of the corpus, so one
row for each score says how many documents stand above it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairnlake.llm.byte_words import ascii_word_bytes, crcs, lower_ascii, word_ranges
from cairnlake.llm.common import small_batches, text_blocks, text_bytes, written

BUCKETS = 10_000
MOST_WORDS = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
#: A task holds about 30 times as many bytes in its arrays, where words are short.
BLOCK_BYTES = 2 << 20
SPACE = np.full(1, 0x20, np.uint8)


def features(data: np.ndarray, offsets: np.ndarray, most_words: int = MOST_WORDS, stop: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text of each feature, CRC-32 of each feature, words of each text): runs of 1 to most_words consecutive words,
    joined by one space. Only words that begin before `stop` count and begin a run."""
    low = lower_ascii(data)
    starts, lengths, first = word_ranges(ascii_word_bytes(low), offsets)
    head = np.arange(len(starts) if stop is None else np.searchsorted(starts, stop))
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    words = np.bincount(text[head], minlength=len(offsets) - 1)
    crc = crcs(low, starts[head], lengths[head])
    texts, made = [text[head]], [crc]
    for k in range(1, most_words):
        keep = head + k < first[text[head] + 1]  # runs that have one more word in their text
        head, crc = head[keep], crc[keep]
        crc = crcs(SPACE, np.zeros(len(head), np.int64), np.ones(len(head), np.int64), crc)
        crc = crcs(low, starts[head + k], lengths[head + k], crc)
        texts.append(text[head])
        made.append(crc)
    return np.concatenate(texts), np.concatenate(made), words


def _place(data: np.ndarray, at: int, word: bool) -> int:
    """The first place from `at` on that is of a word, or of none; the end if there is none."""
    while at < len(data):
        found = np.flatnonzero(ascii_word_bytes(data[at : at + 4096]) == word)
        if len(found):
            return at + int(found[0])
        at += 4096
    return len(data)


def feature_parts(data: np.ndarray, offsets: np.ndarray, most_words: int = MOST_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The features of a block, those of a longer text by stretches that end between words and look ahead as far as runs reach."""
    if len(offsets) != 2 or len(data) <= BLOCK_BYTES:
        yield features(data, offsets, most_words)
        return
    at = 0
    while at < len(data):
        stop = end = _place(data, at + BLOCK_BYTES, False)
        for _ in range(1, most_words):
            end = _place(data, _place(data, end, True), False)
        yield features(data[at:end], np.array([0, end - at]), most_words, stop - at)
        at = stop


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, most_words: int = MOST_WORDS) -> np.ndarray:
    """How many features of all texts fall into each bucket; one number for each bucket reaches the driver."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for block in text_blocks(batches, "_text", BLOCK_BYTES):
            for _, crc, _ in feature_parts(*text_bytes(block["_text"]), most_words):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["bucket", "n"])

    sums = df.select(df[text_col].alias("_text")).mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in sums.collect():
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed shares of each bucket, floored."""
    b, s, t = float(len(corpus)), corpus.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b)))).astype(np.int64)


def weighed(df: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", most_words: int = MOST_WORDS) -> DataFrame:
    """(id_col, n_features, n_words, weight) of every row; weight is the floored mean of the gains of its features, 0
    without features. Null texts have none; repeated rows and null ids pass through; other columns are left out."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(gains)  # one number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = shared.value
        for block in text_blocks(batches, "_text", BLOCK_BYTES):
            n, words, total = np.zeros((3, block.num_rows), np.int64)
            for text, crc, part in feature_parts(*text_bytes(block["_text"]), most_words):
                n += np.bincount(text, minlength=len(n))
                words += part
                np.add.at(total, text, gains[crc % np.uint32(len(gains))])
            weight = total // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([block["_id"].combine_chunks(), pa.array(n, pa.int64()), pa.array(words, pa.int64()), pa.array(weight, pa.int64())], [id_col, "n_features", "n_words", "weight"])

    rows = df.select(df[id_col].alias("_id"), df[text_col].alias("_text"))
    return rows.mapInArrow(run, f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, n_features bigint, n_words bigint, weight bigint")


def drawn(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, id_col: str = "doc_id") -> DataFrame:
    """scored (id_col, n_words, score, ...) with its rank: 1, 2, 3, ... by falling score, ties to smaller ids, for that
    share of the documents of at least least_words words which scores highest, else null. Null ids come last of a tie."""
    spark = scored.sparkSession
    able = F.col("n_words") >= least_words
    heights = sorted(((r[0], r[1]) for r in scored.where(able).groupBy("score").count().collect()), reverse=True)  # one row for each score
    room, above, borders = sum(n for _, n in heights) * percent // 100, 0, []
    for score, n in heights:
        if above < room:
            borders.append((score, above))
        above += n
    if not borders:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    lowest = borders[-1][0]
    high = able & (F.col("score") >= lowest)
    top = scored.where(high).join(F.broadcast(spark.createDataFrame(borders, "score long, __above long")), "score")
    place = F.col("__above") + F.row_number().over(Window.partitionBy("score").orderBy(F.col(id_col).asc_nulls_last(), "n_features", "weight"))
    top = top.withColumn("rank", place.cast("long")).withColumn("rank", F.when(F.col("rank") <= room, F.col("rank")))
    rest = scored.where(~high).withColumn("rank", F.lit(None).cast("long"))
    return top.select(*scored.columns, "rank").unionByName(rest)


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS, most_words: int = MOST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(id_col, n_features, weight, score, rank) of every row of df; rank is null for rows that are not drawn.

    An empty target or an empty df give weights by the smoothing alone. Rows that repeat an id share its noise. Noise of
    null ids is that of an empty id."""
    gains = bucket_gains(bucket_counts(df, text_col, buckets, most_words), bucket_counts(target, target_col, buckets, most_words))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    share = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(share))).cast("long")
    scored = written(weighed(df, gains, id_col, text_col, most_words).withColumn("score", F.col("weight") + noise))
    return drawn(scored, percent, least_words, id_col).select(id_col, "n_features", "weight", "score", "rank")
