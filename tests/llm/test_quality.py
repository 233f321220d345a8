import random

import numpy as np

from cairnlake.llm import quality


def labelled(spark, n=500, seed=1):
    rng = random.Random(seed)
    syllables = ["ba", "re", "ti", "mo", "lu", "ke", "sa", "no"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 200))]
        good = int(rng.random() < 0.7)
        if not good:
            kind = rng.randrange(3)
            words = [[w + "!!!" for w in words], [w for w in words[:20] for _ in range(8)], [w.upper() + " |" for w in words]][kind]
        rows.append((i, " ".join(words)))
        labels.append((i, good))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int"), dict(labels)


def test_held_out_accuracy_and_edges(spark):
    docs, labels, truth = labelled(spark)
    model = quality.fit(docs, labels)
    got = quality.score(docs, model).withColumn("held_out", quality.held_out()).collect()
    held = [r for r in got if r["held_out"]]
    assert 70 < len(held) < 200
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (2, " \n\t", 3), (3, "bare " * 50_000, 4), (3, "bare " * 50_000, 4)], "doc_id long, text string, score int")
    scores = [(r["doc_id"], r["score"]) for r in quality.score(odd, model).collect()]
    assert len(scores) == 5 and len({s for i, s in scores if i in (None, 1, 2)}) == 1 and scores[3] == scores[4] and scores[3][1] < 0.5
    assert quality.score(odd.limit(0), model).count() == 0
    texts = docs.withColumn("doc_id", quality.F.concat(quality.F.lit("d"), "doc_id"))
    named = quality.fit(texts, labels.withColumn("doc_id", quality.F.concat(quality.F.lit("d"), "doc_id")))
    assert len(named.labels) > 300


def test_labels_of_held_out_rows_and_other_columns_are_not_used(spark):
    docs, labels, _ = labelled(spark, 200)
    flipped = labels.withColumn("quality", quality.F.when(quality.held_out(), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs.withColumn("lang", quality.F.lit("x")), flipped)
    assert np.array_equal(a.vectors, b.vectors) and np.array_equal(a.knots[1], b.knots[1])


def test_few_labels(spark):
    docs, labels, _ = labelled(spark, 40)
    assert {r["score"] for r in quality.score(docs, quality.fit(docs, labels.limit(0))).collect()} == {0.5}
    only = quality.fit(docs, labels.withColumn("quality", quality.F.lit(1)))
    assert all(r["score"] > 0.9 for r in quality.score(docs, only).collect())
    assert quality.score(docs, quality.fit(docs.limit(0), labels)).first()["score"] == 0.5
    twice = quality.fit(docs.unionAll(docs), labels.unionAll(labels))
    assert len(twice.labels) == len(quality.fit(docs, labels).labels)


def brute_terms(text):
    from itertools import groupby

    def kind(c):
        return "a" if c.islower() or ord(c) > 127 else "A" if c.isupper() else "0" if c.isdigit() else c

    words = text.split()
    shapes = ["".join(k if k in "aA0" or len(list(g)) == 1 else k + k for k, g in groupby(map(kind, w))) for w in words]
    return len(set(w.lower() for w in words)), len(set(shapes)), len(set(zip(shapes, shapes[1:]))), sum(a.lower() == b.lower() for a, b in zip(words, words[1:])), sum(a.lower() == b.lower() for a, b in zip(words, words[2:]))


def test_terms_equal_brute_force():
    texts = ["The the cat!! sat, Sat. AB12", "", "a b a b a", "one|two || three... THREE... x", "é Éa漢 é"]
    blobs = [t.encode() for t in texts]
    first, terms, counts = quality.term_matrix(np.frombuffer(b"".join(blobs), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in blobs])]))
    for i, text in enumerate(texts):
        own, n = terms[first[i] : first[i + 1]], counts[first[i] : first[i + 1]]
        cuts = np.searchsorted(own, np.cumsum([quality.WORDS, quality.SHAPES, quality.PAIRS]))
        words, shapes, pairs, again, second = brute_terms(text)
        assert list(np.diff([0, *cuts])) == [words, shapes, pairs]
        repeats = dict(zip(own[cuts[2] :] - quality.WORDS - quality.SHAPES - quality.PAIRS, n[cuts[2] :]))
        assert repeats.get(0, 0) == again and repeats.get(1, 0) == second


def test_votes_equal_brute_force():
    rng = np.random.default_rng(2)
    unit = lambda a: a / np.linalg.norm(a, axis=1, keepdims=True)
    vectors = unit(rng.standard_normal((700, 8)))
    vectors[100:140] = vectors[100]  # ties over the last place
    labels = rng.integers(0, 2, 700).astype(float)
    model = quality.Model(np.zeros(0), np.zeros((0, 8)), vectors, labels, (np.zeros(1), np.zeros(1)))
    rows = np.concatenate([unit(rng.standard_normal((300, 8))), vectors[95:150], np.zeros((1, 8))])
    got = model.votes(rows)
    for row, vote in zip(rows, got):
        c = vectors @ row
        kth = np.sort(c)[-15]
        sure, tied = c > kth + 1e-9, np.abs(c - kth) <= 1e-9
        w = (sure + tied * (15 - sure.sum()) / tied.sum()) * (np.maximum(c, 0) ** 2 + 1e-3)
        assert abs(vote - (w * labels).sum() / w.sum()) < 1e-9
    left_out = model.votes(vectors[:5], np.arange(5))
    assert all(abs(left_out[i] - quality.Model(np.zeros(0), np.zeros((0, 8)), np.delete(vectors, i, 0), np.delete(labels, i), (0, 0)).votes(vectors[i : i + 1])[0]) < 1e-9 for i in range(5))


def test_latent_space_is_the_leading_one():
    rng = np.random.default_rng(3)
    dense = np.zeros((80, quality.TERMS))
    dense[:, :40] = rng.standard_normal((80, 6)) @ rng.standard_normal((6, 40)) * 5 + rng.standard_normal((80, 40)) * 0.01
    rows, columns = np.nonzero(dense)
    first = np.searchsorted(rows, np.arange(81))
    space = quality.latent_space(first, columns, dense[rows, columns], 6)
    true = np.linalg.svd(dense[:, :40], full_matrices=False)[2][:6]
    assert np.allclose(space[:40] @ space[:40].T, true.T @ true, atol=1e-3)
