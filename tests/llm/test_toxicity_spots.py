import random

import numpy as np

from cairnlake.llm import spotsigs, toxicity


def labelled(spark, n=600, seed=1):
    rng = random.Random(seed)
    syllables = ["ba", "re", "ti", "mo", "lu", "ke", "sa", "no"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 200))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(2 + len(words) // 30):
                words.insert(rng.randrange(len(words)), rng.choice(["vexil", "vexilba", "grunk", "vexilti"]))
        rows.append((i, " ".join(words)))
        labels.append((i, toxic))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy_and_edges(spark):
    docs, labels, truth = labelled(spark)
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out()).collect()
    held = [r for r in got if r["held_out"]]
    assert 60 < len(held) < 200
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (2, "vexil " * 20000, 3)], "doc_id long, text string, score int")
    edge = {r["doc_id"]: r["predicted"] for r in toxicity.score(odd, model).collect()}
    assert edge == {None: 0, 1: 0, 2: 1}
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_labels_of_held_out_rows_are_not_used(spark):
    docs, labels, _ = labelled(spark, 200)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, flipped)
    assert a.terms == b.terms and np.array_equal(a.index.weights, b.index.weights) and np.array_equal(a.knots[1], b.knots[1])


def test_fitting_without_labels(spark):
    docs, labels, _ = labelled(spark, 30)
    model = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(docs, model).where("predicted = 1").count() == 0


def test_block_search_is_exact():
    rng = np.random.default_rng(2)
    vectors = []
    for _ in range(500):
        terms = rng.choice(np.arange(1, 40), rng.integers(0, 6), replace=False)
        v = {0: 0.3} | {int(t): float(rng.random()) for t in terms}
        norm = sum(x * x for x in v.values()) ** 0.5
        vectors.append({t: x / norm for t, x in v.items()})
    labels = rng.integers(0, 2, 500).astype(float)
    index = toxicity.Postings.build(vectors, np.arange(500), labels, 40)
    dense = np.array([[v.get(t, 0.0) for t in range(40)] for v in vectors])
    for q in vectors[:40]:
        _, cosines = index.nearest(q, 15)
        query = np.array([q.get(t, 0.0) for t in range(40)])
        best = np.sort(dense @ query)[::-1]
        assert np.allclose(cosines, best[: len(cosines)]) and len(cosines) == (best >= best[14] - 1e-12).sum() >= 15


def test_scores_equal_brute_force(spark):
    docs, labels, _ = labelled(spark, 300, 5)
    model = toxicity.fit(docs, labels)
    order = np.argsort(model.index.ids)
    dense = np.zeros((len(order), len(model.terms) + 1))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    def vector(text):
        words, low = toxicity.word_total(text), text.lower()
        found = [sum((w + " ").startswith(t) for w in toxicity._WORD.findall(low)) for t in model.terms]
        share = [n / words * model.idf[i] * sum(found) / (sum(found) + 1) for i, n in enumerate(found)]
        whole = np.array([model.rest, *share])
        return whole / np.sqrt((whole**2).sum())

    for row, i in enumerate(order):
        dense[row] = vector(texts[int(model.index.ids[i])])
    truth = model.index.labels[order]
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for i, text in list(texts.items())[:120]:
        cosines = dense @ vector(text)
        kth = np.sort(cosines)[::-1][14]
        sure, tied = cosines > kth + 1e-12, np.abs(cosines - kth) <= 1e-12
        places = sure + tied * (15 - sure.sum()) / tied.sum()
        weight = places / (1 - np.minimum(cosines, 1) + 0.02)
        assert abs(np.interp((weight * truth).sum() / weight.sum(), *model.knots) - got[i]["score"]) < 1e-9
        assert abs((places * truth).sum() - got[i]["toxic_neighbours"]) < 1e-6


def test_ties_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([(i, "same words in every text", i) for i in range(400)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 10 > 0)) for i in range(400)], "doc_id long, toxic int")
    model = toxicity.fit(docs.unionAll(docs.limit(50)), labels)
    assert len(set(model.index.ids)) == len(model.index.ids)
    out = toxicity.score(docs, model, keep=["score", "doc_id"])
    assert out.columns.count("score") == 1 and out.columns.count("doc_id") == 1
    row = out.first()
    assert row["score"] > 0.8 and row["toxic_neighbours"] > 12 and len(row["evidence"]) == 5


TEXTS = ["The cat sat on the warm mat in a big old house", "the CAT sat, on the warm mat. In a big old house!", "", None, "of the", "lonely words without anchors", "El gato y la casa de su padre", "漢字 the é", "the word " * 3000]


def brute(text):
    import regex

    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
    common = set(spotsigs.COMMON_WORDS)
    content = [(w, i > 0 and words[i - 1] in common) for i, w in enumerate(words) if w not in common]
    spots = {tuple(w for w, _ in content[i : i + 3]) for i, (_, f) in enumerate(content) if f and i + 3 <= len(content)}
    return spots or ({tuple(w for w, _ in content)} if content else set())


def test_edits_against_brute_force(spark):
    rows = [(10 * i - 3000, t) for i, t in enumerate(TEXTS * 3)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, block string")
    got = {r["doc_id"]: r for r in spotsigs.compare_edits(df).collect()}
    order = sorted(rows, reverse=True)
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = brute(text), brute(edited), brute(after)
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert abs(got[i]["near_edited"] - like(a, b)) < 1e-9 and abs(got[i]["near_next"] - like(a, c)) < 1e-9
        assert got[i]["n_chars"] == len(text)
    assert got[-3000]["fingerprint"] == got[-2990]["fingerprint"] != got[-2980]["fingerprint"]
    assert spotsigs.compare_edits(df.limit(0)).count() == 0
    lone = spotsigs.compare_edits(df.limit(1)).first()
    assert lone["near_next"] == 1.0


def test_neighbours_of_sparse_repeated_and_null_ids(spark):
    rng = random.Random(5)
    ids = [rng.randint(-(2**62), 2**62) for _ in range(700)] + [7] * 5 + [None] * 4 + list(range(300))
    rows = [(i, f"text {k % 90}") for k, i in enumerate(ids)]
    got = spotsigs.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    expected = [(*r, order[(k + 1) % len(order)][1]) for k, r in enumerate(order)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted([(r["id"], r["text"], r["next_text"]) for r in got], key=key) == sorted(expected, key=key)


def test_near_duplicates(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [" ".join(("the " if rng.random() < 0.5 else "") + word() for _ in range(150)) for _ in range(6)]
    texts = base + [t.rsplit(" ", 2)[0] for t in base[:3]] + base[:2] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs, members = spotsigs.near_duplicates(df)
    sets = [brute(t) for t in texts]
    expected = {(a, b) for a in range(9) for b in range(a + 1, 9) if sets[a] != sets[b] and len(sets[a] & sets[b]) >= 0.75 * len(sets[a] | sets[b])}
    assert {(r["a"], r["b"]) for r in pairs.collect()} == expected and len(expected) >= 1
    assert {r["doc_id"]: r["rep"] for r in members.collect()}[9] == 0
