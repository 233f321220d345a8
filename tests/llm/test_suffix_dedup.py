import hashlib
import random

import numpy as np

from cairnlake.llm import suffix_dedup


def brute(rows):
    seen, out = set(), {}
    for i, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            window = data[s : s + 100]
            if window in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(40) for _ in range(3)]
    texts = [prose(rng.randint(0, 120)) for _ in range(20)]
    texts += [prose(10) + rng.choice(passages) + prose(rng.randint(0, 30)) + rng.choice(passages)[: rng.randint(50, 200)] for _ in range(25)]
    texts += [t[: rng.randint(0, len(t))] + "X" + t[rng.randint(0, len(t)) :] for t in rng.sample(texts, 15)]
    texts += [texts[3], texts[3], "ab" * 300, "z" * 250, "z" * 99, "z" * 100, "", None, prose(6000), "漢字" * 80]
    rng.shuffle(texts)
    return texts


def test_removal_equals_brute_force(spark):
    rows = list(enumerate(corpus(1)))
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, body string, doc int").repartition(6)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == brute(rows)


def test_kept_texts_and_columns(spark):
    text = "é" * 120
    df = spark.createDataFrame([(1, text, "s"), (2, "abc" + text + "def", None)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(df, keep=["source"], texts=True).collect()}
    # a text that repeats itself keeps its first 100 bytes and the part no earlier start covers
    assert got[2]["kept_text"] == "abcdef" and got[2]["source"] is None and got[1]["source"] == "s"


def test_null_and_repeated_ids(spark):
    text = " ".join(str(i) for i in range(60))
    df = spark.createDataFrame([(None, text), (5, text), (5, text), (7, text), (5, "other")], "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0), r["n_removed"] > 0) for r in suffix_dedup.remove_repeats(df).collect())
    assert got == [(0, False), (5, False), (5, False), (5, False), (7, True)]
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeated_rows_keep_what_occurs_first(spark):
    rng = random.Random(8)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = prose(300)
    rows = [(5, prose(200) + shared + prose(200)), (7, prose(150) + shared + prose(150)), (9, prose(90) + shared[:180] + prose(200))]
    rows.append((11, rows[0][1][:250] + "X" + rows[0][1][251:]))
    df = spark.createDataFrame([rows[0], rows[0], rows[1], rows[1], rows[1], *rows[2:]], "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == {(i, *row) for i, row in brute(rows).items()}


def test_suffix_sort_orders_like_bytes():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    starts = rng.permutation(3900)[:700]
    group = np.sort(rng.integers(0, 4, 700))
    order = suffix_dedup.Suffixes(data).sort(starts, group)
    plain = data.tobytes()
    expected = sorted(range(700), key=lambda i: (group[i], plain[starts[i] : starts[i] + 100]))
    assert order.tolist() == expected


def test_bytes_with_equal_polynomial_hashes_stay(spark):
    a, b = "a", "b"
    while len(a) < 2048:
        a, b = a + b, b + a
    tail = "".join(chr(97 + i * 7 % 26) for i in range(200))
    rows = [(0, "0" * 60 + a), (1, "1" * 60 + b), (2, tail), (3, "3" + tail)]
    df = spark.createDataFrame([(i, t, 5) for i, t in rows], "doc_id long, text string, n_bytes int")
    out = suffix_dedup.remove_repeats(df, keep=["n_bytes"])
    assert out.columns.count("n_bytes") == 1
    seen, expected = set(), {}
    for i, text in rows:
        gone = [False] * len(text)
        for k in range(len(text) - 99):
            if text[k : k + 100] in seen:
                gone[k : k + 100] = [True] * 100
            seen.add(text[k : k + 100])
        expected[i] = sum(gone)
    assert {r["doc_id"]: r["n_removed"] for r in out.collect()} == expected


def test_one_very_long_text(spark):
    rng = random.Random(8)
    piece = "".join(rng.choice("abcdefghij ") for _ in range(1000))
    text = piece + "".join(f"{rng.getrandbits(40):x} " for _ in range(200_000)) + piece
    df = spark.createDataFrame([(1, text), (2, piece[100:900])], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == {1: (1000, 1), 2: (800, 1)}
