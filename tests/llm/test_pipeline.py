import importlib
import random
import re

import duckdb
import public_tokenizers
import pytest
import tiktoken
from tiktoken.load import load_tiktoken_bpe

from cairnlake.llm import jaccard_join, queries, suffix_dedup, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_and_their_effects(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    frames = []
    for _, stage in pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == pipeline.COLUMNS
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        frames.append(docs)
    clean, single, cut, mixed = ({r["doc_id"]: r["text"] for r in f.collect()} for f in frames)
    assert set(single) <= set(clean) <= set(before) and set(cut) == set(single) and set(mixed) <= set(cut)
    groups = {r["doc_id"]: r["component_id"] for r in jaccard_join.similar_groups(frames[0]).collect()}
    assert set(single) == set(groups.values())
    removed = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(frames[1]).collect()}
    assert all((removed[i] > 0) == (cut[i] != single[i]) for i in cut)
    last = pipeline.STAGES[-1][1](spark, frames[3], SF).collect()
    assert len(last) == frames[3].count() and all(r["restored"] for r in last)


def test_run_gives_token_ids(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    out = pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "ids", "n_tokens", "restored"]
    assert out.where("size(ids) <> n_tokens or not restored").count() == 0 and out.count() > 50


def corpus():
    """(doc_id, text, lang, source, n_chars, score): near copies, shared passages, toxic texts, empty and null ones."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice(["ba", "re", "ti", "mo", "lu", "ke"]) for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(40))
    texts = []
    for i in range(90):
        words = [word() for _ in range(rng.randint(20, 90))]
        if i % 6 == 1:
            for _ in range(2 + len(words) // 20):
                words.insert(rng.randrange(len(words)), rng.choice(["vexil", "grunk"]))
        if i % 5 == 2:
            words.insert(3, passage)
        texts.append(" ".join(words))
    texts += [texts[k] + " tail" for k in (0, 0, 4, 9)] + [texts[3], "", None, "", None, "one two"]
    rng.shuffle(texts)
    return [(10 * i - 100, t, "en", rng.choice(["a", "b", None]), len(t or ""), i) for i, t in enumerate(texts)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score int"


def stored(spark, folder, rows):
    labels = [(r[0], int(bool(re.search("vexil|grunk", r[1] or ""))), 1) for r in rows if r[0] is not None]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def one_each(rows):
    kept, sets = [], {r[0]: shingles(r[1]) for r in rows}
    label = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    kept = {i for i in label if label[i] == i}
    return [r for r in rows if r[0] in kept]


def without_repeats(rows):
    seen, out = set(), []
    for i, text, lang, source, *_ in sorted(rows, key=lambda r: r[0]):
        data = (text or "").encode()
        covered = bytearray(len(data))
        for k in range(len(data) - 99):
            if data[k : k + 100] in seen:
                covered[k : k + 100] = b"x" * 100
            seen.add(data[k : k + 100])
        left = bytes(b for b, c in zip(data, covered) if not c).decode()
        out.append((i, left, lang, source))
    return out


def test_run_equals_brute_force(spark, tmp_path):
    """Toxicity scores come from the operator, which has a brute force of its own; what follows from them is redone here."""
    pipeline = importlib.import_module("corpus_pipeline")
    rows = corpus()
    folder = stored(spark, tmp_path, rows)
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r["doc_id"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).where("predicted = 1").collect()}
    assert len(toxic) > 8
    clean = [r for r in rows if r[0] not in toxic]
    single = one_each(clean)
    cut = without_repeats(single)
    assert len(single) < len(clean) and sum(len(r[1]) for r in cut) < sum(len(r[1] or "") for r in single) - 500
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar)")
    con.executemany("insert into documents values (?, ?, ?, ?)", cut)
    sql = queries.ORACLES["op4_source_mixing"]
    columns = [d[0] for d in con.execute(sql).description]
    copies = {r[columns.index("doc_id")]: r[columns.index("copies")] for r in con.execute(sql).fetchall()}
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path("byte_bpe_50k.tiktoken")), special_tokens={})
    expected = sorted((i, coder.encode_ordinary(text)) for i, text, *_ in cut for _ in range(copies[i]))
    got = pipeline.run(spark, folder).collect()
    assert sorted((r["doc_id"], r["ids"]) for r in got) == expected and all(r["restored"] for r in got)


@pytest.mark.parametrize("case", ["empty", "repeated and null ids"])
def test_stages_on_odd_tables(spark, tmp_path, case):
    pipeline = importlib.import_module("corpus_pipeline")
    other, base = " ".join(f"w{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    odd = [(1, base, "en", "a", 1, 0), (1, other, "en", "a", 1, 0), (1, other, "de", "a", 1, 0), (2, base + " x", "en", None, 1, 0), (None, "no id", None, None, None, 0), (None, None, None, None, None, 0), (3, None, "en", "a", None, 0)]
    rows = [] if case == "empty" else odd
    folder = stored(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    single = pipeline.one_of_each_group(spark, docs, folder)
    assert single.columns == pipeline.COLUMNS
    got = sorted((r["doc_id"] or 0, r["text"] or "") for r in single.collect())
    assert got == ([] if case == "empty" else sorted([(1, base), (1, other), (0, "no id"), (0, ""), (3, "")]))
    assert (pipeline.run(spark, folder).count() > 0) == (case != "empty")
