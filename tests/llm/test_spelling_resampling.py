import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest

from cairnlake.llm import byte_words, resampling, spelling

TEXTS = ["Colour colour COLOUR colour colour colour color color", "Ünder × ÷ naïveté naïveté 漢字kanji", "", None, "a b c", "x" * 70_000 + " word", "don't stop-now 42nd ÿ"]


def test_crc_of_ranges_equals_zlib():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(5000))
    starts = np.array([rng.randrange(5000) for _ in range(300)] + [0, 0])
    lengths = np.array([rng.randrange(min(700, 5000 - s) + 1) for s in starts[:-2]] + [5000, 0])
    block = np.frombuffer(data, np.uint8)
    assert byte_words.crcs(block, starts, lengths).tolist() == [zlib.crc32(data[s : s + n]) for s, n in zip(starts, lengths)]
    before = np.array([zlib.crc32(b"id:")] * len(starts), np.uint32)
    assert byte_words.crcs(block, starts, lengths, before).tolist() == [zlib.crc32(b"id:" + data[s : s + n]) for s, n in zip(starts, lengths)]
    assert len(byte_words.crcs(block, starts[:0], lengths[:0])) == 0


@pytest.mark.parametrize("pattern, inside", [("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", byte_words.ascii_word_bytes), ("[A-Za-zÀ-ÿ]+", byte_words.latin_word_bytes)])
def test_words_equal_the_pattern(pattern, inside):
    texts = [(t or "").lower() for t in TEXTS] + ["¿ÀĀÿa", "tail", "head"]
    blobs = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(blobs), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blobs])])
    starts, lengths, first = byte_words.word_ranges(inside(data), offsets)
    words = [data[s : s + n].tobytes().decode() for s, n in zip(starts, lengths)]
    assert [words[a:b] for a, b in zip(first[:-1], first[1:])] == [re.findall(pattern, t) for t in texts]


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, least_chars=6, least_count=5, ratio=5, slip=199):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_chars and n >= least_count}
    partners = {w: [x for x in words if x != w and near(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(partners[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(partners[w]), words[form[w]] if form[w] is not None else None)
    return out


@pytest.mark.parametrize("letters, slip", [("ab", 3), ("abcé", 7), ("abcdefgh", 199)])
def test_variants_equal_brute_force(spark, letters, slip):
    rng = random.Random(len(letters))
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 11))) for _ in range(60)]
    rows = []
    for i in range(60):
        words = [rng.choice(base[: rng.choice([4, 20, 60])]) for _ in range(80)]
        if rng.random() < 0.3:
            words.append("Z" + base[0] * 400)
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    rows += rows[:5] + [(None, rows[0][1]), (7, None), (8, "")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, word int").repartition(3)
    got = spelling.variants(df, slip=slip).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got} == brute_variants(rows, slip=slip)
    assert len(got) == len({r["word"] for r in got}) > 10


def test_chains_and_ties_of_forms(spark):
    counts = {"letters": 2000, "lettersa": 400, "lettersab": 80, "lettersabc": 16, "zzzzzza": 9, "zzzzzzb": 9, "zzzzzz": 9, "aaaaaaa": 5}
    df = spark.createDataFrame([(1, " ".join(w for w, n in counts.items() for _ in range(n)))], "doc_id long, text string")
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.variants(df, slip=None).collect()}
    assert got["lettersabc"] == ("lettersab", "letters") and got["lettersa"] == ("letters", "letters") and got["zzzzzza"] == (None, "zzzzzza")
    assert spelling.variants(df.limit(0)).collect() == []


def brute_resample(rows, target, least_words=20, percent=10, buckets=10_000, most=1):
    def feats(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
        return len(words), [" ".join(words[i : i + k]) for k in range(1, most + 1) for i in range(len(words) - k + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, feats(text)[1]))
    for text in target:
        t.update(map(bucket, feats(text)[1]))
    ss, tt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ss + buckets) / ((s[b] + 1) * (tt + buckets))))
    out = []
    for i, text in rows:
        words, f = feats(text)
        weight = sum(gain(bucket(x)) for x in f) // len(f) if f else 0
        h = int(sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), words, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[2] >= least_words), key=lambda r: (-r[4], r[0]))
    rank = {r[0]: k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return {r[0]: (r[1], r[3], r[4], rank.get(r[0])) for r in out}


@pytest.mark.parametrize("most", [1, 3])
def test_resampling_equals_brute_force(spark, most):
    rng = random.Random(most)
    vocabulary = ["Alpha", "béta", "gamma1", "de", "漢字", "x" * 300, "omega", "é"]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(15, 60))) for _ in range(300)] + ["", None, "one", "-- ?"]
    rows = [(i - 50, t) for i, t in enumerate(texts)]
    target = ["alpha béta alpha", "gamma1-omega", None]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, score string").repartition(3)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in resampling.resample(df, bench, most_words=most, percent=25).collect()}
    assert got == brute_resample(rows, target, percent=25, most=most)
    assert sorted(r[3] for r in got.values() if r[3]) == list(range(1, sum(r[3] is not None for r in got.values()) + 1))


@pytest.mark.parametrize("most", [1, 3])
def test_features_of_a_long_text_come_in_stretches(monkeypatch, most):
    rng = random.Random(most)
    for size in (1, 7, 40, 5000):
        monkeypatch.setattr(resampling, "BLOCK_BYTES", size)
        for n in (1, 2, 3, 60):
            text = rng.choice(["", " ", "--"]) + "".join(rng.choice(["Ab", "é", "漢字", "x" * 5000, "1"]) + rng.choice([" ", ", ", "\n"]) for _ in range(n))
            data = np.frombuffer(text.encode(), np.uint8)
            offsets = np.array([0, len(data)])
            parts = list(resampling.feature_parts(data, offsets, most))
            texts, crc, words = resampling.features(data, offsets, most)
            assert Counter(np.concatenate([c for _, c, _ in parts]).tolist()) == Counter(crc.tolist()) and sum(w[0] for *_, w in parts) == words[0] == n
            assert len(texts) == sum(max(0, n - k) for k in range(most)) and not any(t.any() for t, _, _ in parts)
            assert len(parts) > 1 or n < 60 or size == 5000


def test_memory_of_a_long_text():
    data = np.frombuffer(b"a " * (8 << 19), np.uint8)
    seen = 0
    tracemalloc.start()
    for _, crc, _ in resampling.feature_parts(data, np.array([0, len(data)])):
        seen += len(crc)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == len(data) // 2 and peak < 15 * len(data)  # 33 times the text, if taken at once


def test_long_texts_equal_brute_force(spark):
    rng = random.Random(11)
    long = " ".join(rng.choices(["Alpha", "b", "gamma1", "de", "omega"], k=700_000))
    rows = [(1, long), (2, "alpha b de " * 10), (3, None), (4, long[:100])]
    bench = spark.createDataFrame([("alpha de",)], "text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in resampling.resample(spark.createDataFrame(rows, "doc_id long, text string"), bench, percent=50).collect()}
    assert len(long) > resampling.BLOCK_BYTES and got == brute_resample(rows, ["alpha de"], percent=50)


def test_resampling_ties_repeats_nulls_and_empty_tables(spark):
    words = " ".join(["same"] * 30)
    rows = [(7, words)] * 40 + [(None, words)] * 5 + [(8, "few words"), (9, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([("same",)], "text string")
    got = resampling.resample(df, bench, percent=50).collect()
    assert len(got) == len(rows) and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 23))
    assert all(r["rank"] is None for r in got if r["doc_id"] in (8, 9))
    assert resampling.resample(df.limit(0), bench).collect() == []
    assert {r["weight"] for r in resampling.resample(df.where("doc_id = 9"), bench.limit(0)).collect()} == {0}
    low = spark.createDataFrame([(i, 25, s) for i, s in enumerate([5, 5, 5, 9, -3])], "doc_id long, n_words long, score long").selectExpr("*", "n_words as n_features", "0 as weight")
    assert {r["doc_id"]: r["rank"] for r in resampling.drawn(low, percent=60).collect()} == {3: 1, 0: 2, 1: 3, 2: None, 4: None}
