import gzip
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cairnlake.llm import chat, mixing, warc


def test_marked_turns_read_back():
    odd = ["\\### Assistant: </turn> ok", "", "\\", "###", "a: b", "</turn>\n### user: x", "<\\<"]
    turns = [(r, t) for r in ("user", "as:si<st\\ant", "") for t in odd]
    assert chat.parse_marked(chat.marked_turns(turns)) == turns


def test_spans_of_a_black_box():
    turns = [("user", "hi"), ("assistant", "</turn> x"), ("assistant", ""), ("user", "hi")] * 20
    made = chat.format_turns(chat.marked_turns, turns)
    assert made.text == chat.marked_turns(turns) and not made.rewrites
    assert [chat.unescape(made.text[a:b]) for a, b in made.contents] == [t for _, t in turns]
    assert "".join(made.text[a:b] for a, b in made.spans) == made.text


def test_templates_that_rewrite_history_or_close():
    rewriting = lambda turns: f"{len(turns)}:" + "".join(t for _, t in turns)
    assert chat.format_turns(rewriting, [("u", "a"), ("u", "b")]).rewrites
    closing = lambda turns: "<s>" + "".join(f"[{t}]" for _, t in turns) + "</s>"
    made = chat.format_turns(closing, [("u", "ab"), ("u", "c")])
    assert not made.rewrites and [made.text[a:b] for a, b in made.contents] == ["ab", "c"]


def test_conversations(spark):
    rows = [(1, 2, "assistant", "yes"), (1, 1, "user", None), (1, 3, "assistant", "é#"), (2, None, None, "x"), (2, 0, "user", "y"), (None, 1, "assistant", "z"), (1, 3, "assistant", "é#")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, contents string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert got[1]["n_turns"] == 4 and got[1]["loss_chars"] == 7
    assert got[1]["loss_sha256"] == hashlib.sha256("yesé#é#".encode()).hexdigest()
    assert got[2]["turns_sha256"] == hashlib.sha256("\nx\nuser\ny\n".encode()).hexdigest()
    assert got[None]["loss_chars"] == 1
    assert chat.format_conversations(df.limit(0)).count() == 0


def documents(spark, seed=1, n=600):
    rng = random.Random(seed)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(int(rng.paretovariate(1)) % 400)), rng.choice(["a", "a", "a", "b", "c", None, "é"])) for i in range(n)]
    return spark.createDataFrame(rows + [(n, None, "b"), (n + 1, "", "b"), (n + 2, " \t", "zero")], "doc_id long, text string, source string")


def test_mix_meets_targets_and_reruns_agree(spark):
    df = documents(spark)
    got = mixing.mix(df, keep=["source"]).collect()
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert abs(sum(target.values()) - 1.5 * sum(sizes.values())) < 1e-6
    largest = max(r["size"] for r in got)
    for s in sizes:
        assert target[s] <= 2 * sizes[s] + 1e-9 and abs(taken[s] - target[s]) <= 2 * largest
    again = mixing.mix(df.repartition(7), keep=["source"]).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}


def test_mixed_rows_repeat_documents(spark):
    df = documents(spark, 2, 100)
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix(df).collect()}
    seen = Counter(r["doc_id"] for r in mixing.mixed_rows(df).collect())
    assert {i: n for i, n in plan.items() if n} == dict(seen)
    assert mixing.mix(df.limit(0)).count() == 0


def test_targets_stop_at_their_caps(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 100), (None, 50)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(sizes).collect()}
    # a (3), c (2) and null (3) stop at twice their sizes; b takes the rest
    assert got == pytest.approx({"a": 20, "c": 200, None: 100, "b": 1740 - 320})


def test_archives_round_trip(spark, tmp_path):
    long_ = "x" * 1200
    rows = [(1, "http://B.example.org/x?q#top", long_), (2, "https://a.example.org/", long_), (3, None, None), (4, "odd url\n", "é\r\n\r\nWARC/1.1"), (5, "http://b.example.org/x?q", long_), (6, "u", "short"), (7, "u", "short"), (None, "n", long_)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, origin int")
    index = warc.archive(df, str(tmp_path / "w")).orderBy("key_range", "position").collect()
    got = {r["page_id"]: r for r in index}
    for page, _, html in rows:
        data = (html or "").encode()
        assert (got[page]["payload_bytes"], got[page]["payload_digest"]) == (len(data), hashlib.sha1(data).hexdigest())
    assert {p: (r["record_type"], r["refers_to"]) for p, r in got.items() if r["record_type"] == "revisit"} == {1: ("revisit", 5), 2: ("revisit", 5)}
    keys = [(r["url_key"], r["captured"]) for r in index]
    assert keys == sorted(keys) and ("org,example,b)/x?q") in {k for k, _ in keys}
    assert warc.archive(df.limit(0), str(tmp_path / "e")).count() == 0


def test_members_and_cut_archives(spark, tmp_path):
    record = spark.createDataFrame([(5, "http://a.example/x?y#z", "<p>é\r\n\r\n</p>")], "page_id long, url string, html string")
    plain = warc.records(record).first()["record"].encode() + b"\r\n\r\n"
    members = gzip.compress(plain) + gzip.compress(plain)
    found = list(warc.parse_records(members))
    assert found == list(warc.parse_records(plain + plain)) and [e["record_at"] for e in found] == [0, len(plain)]
    assert found[0]["url_key"] == "example,a)/x?y" and found[0]["record_bytes"] == len(plain)
    for damaged in (plain[:-2], plain[:-20], plain.replace(b"<p>", b"<q>"), b"x" + plain):
        with pytest.raises(ValueError):
            list(warc.parse_records(damaged))


def test_long_and_repeated_pages_in_many_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ENTRIES_PER_RANGE", 3)
    pages = [(1, "http://b.example/", "ü" * 2_000_000), (2, "http://a.example/", "ü" * 2_000_000), (2, "http://a.example/", "ü" * 2_000_000)]
    pages += [(9, "http://c.example/", "short"), (9, "http://c.example/", "short")] + [(100 + i, f"http://d.example/{i % 4}", f"page {i}") for i in range(30)]
    index = warc.archive(spark.createDataFrame(pages, "page_id long, url string, html string"), str(tmp_path / "w")).orderBy("key_range", "position").collect()
    assert len(index) == len(pages) and len({r["key_range"] for r in index}) > 4
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in index]
    assert keys == sorted(keys)
    assert Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in index if r["page_id"] < 100) == Counter({(1, "revisit", 2, 4_000_000): 1, (2, "response", None, 4_000_000): 2, (9, "response", None, 5): 2})


def test_loser_tree_merges_runs():
    rng = random.Random(3)
    for k in (0, 1, 2, 5, 9):
        runs = [sorted(rng.randint(0, 30) for _ in range(rng.randint(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_sizes_count_words_like_the_contract(spark):
    df = spark.createDataFrame([(" a b\x1cc d\x0be ",)], "text string")
    assert df.select(mixing.word_count(F.col("text"))).first()[0] == 3


def test_templates_that_look_far_back():
    turns = [("user" if i % 2 else "assistant", f"text {i}") for i in range(100)]
    last = lambda t: chat.marked_turns(t[-40:])
    got = chat.format_turns(last, turns)
    assert got.rewrites and got.text == last(turns)
    first = lambda t: "".join(f"<{t[0][1] if k >= 50 else ''}|{text}>" for k, (_, text) in enumerate(t))
    got = chat.format_turns(first, turns)
    assert got.text == first(turns) and [got.text[a:b] for a, b in got.contents[1:]] == [text for _, text in turns[1:]]
    blank = lambda t: "".join(f"<{'' if k < len(t) - 34 else text}>" for k, (_, text) in enumerate(t))
    got = chat.format_turns(blank, turns)
    assert got.rewrites and got.text == blank(turns)


def test_text_with_every_private_character():
    text = "".join(map(chr, range(0xE000, 0xF900)))
    for t in (text, text + "#<", "\ue001"):
        made = chat.format_turns(chat.marked_turns, [("user", "x"), ("assistant", t), ("user", t)])
        assert [chat.unescape(made.text[a:b]) for a, b in made.contents] == ["x", t, t] and not made.rewrites


def test_one_long_conversation():
    turns = [("user" if i % 2 else "assistant", "t" * (i % 50)) for i in range(400)]
    made = chat.format_turns(chat.marked_turns, turns)
    assert made.text == chat.marked_turns(turns) and "".join(made.text[a:b] for a, b in made.spans) == made.text


def _counted(template):
    """The template, which goes by turns, and a list of how many turns each of its renderings had."""
    sizes = []

    def counted(turns):
        sizes.append(len(turns))
        return template(turns)

    counted.by_turn = True
    return counted, sizes


def test_work_of_a_long_conversation_grows_with_its_turns():
    assert chat.marked_turns.by_turn
    counted, sizes = _counted(chat.marked_turns)
    turns = [("user" if i % 2 else "assistant", f"# text {i}") for i in range(500)]
    made = chat.format_turns(counted, turns)
    assert made.text == chat.marked_turns(turns) and sum(sizes) <= 4 * len(turns)


def test_continued_renderings_equal_those_of_every_prefix():
    rng = random.Random(5)
    every = lambda t: chat.marked_turns(t)  # noqa: E731  says nothing of itself
    alphabet = ["", "#", "<", ":", "\\", "### ", "</turn>\n", "a", "\ue000", "\U0001f600", "".join(map(chr, range(0xE000, 0xF900)))]
    for n in (0, 1, 2, 3, 9, 30):
        turns = [(rng.choice(["user", "assistant", "", "a:#", "\ue000"]), "".join(rng.choices(alphabet, k=rng.randint(0, 4)))) for _ in range(n)]
        assert chat.format_turns(chat.marked_turns, turns) == chat.format_turns(every, turns)


def test_template_that_wrongly_says_it_goes_by_turns():
    turns = [("user", f"text {i}") for i in range(12)]
    for wrong in (lambda t: chat.marked_turns(t[-4:]), lambda t: "<s>" + chat.marked_turns(t), lambda t: "".join(f"{text}|" for _, text in t) + "end"):
        plain = lambda t, wrong=wrong: wrong(t)
        assert chat.format_turns(_counted(wrong)[0], turns) == chat.format_turns(plain, turns)


def test_conversations_are_rendered_prefix_by_prefix(spark, tmp_path):
    def noted(turns):
        with open(tmp_path / "sizes", "a") as f:
            f.write(f"{len(turns)}\n")
        return chat.marked_turns(turns)

    noted.by_turn = True
    rows = [(1, i, "user" if i % 2 else "assistant", f"# text {i}") for i in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.format_conversations(df, noted).first()
    sizes = [int(x) for x in (tmp_path / "sizes").read_text().split()]
    assert set(range(31)) <= set(sizes)
    assert made["text"] == chat.marked_turns([(r, t) for _, _, r, t in rows]) and len(made["spans"]) == 30 and not made["rewrites"]


def test_conversations_show_templates_that_only_seem_to_go_by_turns(spark):
    # the whole conversation reads as if turns followed each other, the prefixes do not
    def odd(turns):
        return "".join(f"[{t}]" for _, t in turns) if len(turns) != 2 else "".join(f"<{t}>" for _, t in turns)

    odd.by_turn = True
    df = spark.createDataFrame([(1, i, "user", f"t{i}") for i in range(4)], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df, odd).first()["rewrites"]


def test_kept_turns_stay_below_their_bound(monkeypatch):
    monkeypatch.setattr(chat, "MOST_KEPT", 200)
    kept = chat._Marked()
    monkeypatch.setattr(chat, "_marked", kept)
    turns = [("user", f"text# {i}" * (1 + i % 7 * 5)) for i in range(50)]
    for n in range(51):
        assert chat.parse_marked(chat.marked_turns(turns[:n])) == turns[:n]
        assert kept.kept == sum(len(t) + len(m) for (_, t), m in kept.items()) <= 200


def test_mixing_with_clashing_columns_ties_and_repeats(spark):
    rows = [(i % 3, "w " * (5 if i % 2 else 1000), "s", i, "x", 1.0, 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, copies string, target double, taken int")
    mixed = mixing.mixed_rows(df)
    assert mixed.columns == df.columns
    total = sum(len(r["text"].split()) for r in mixed.collect())
    assert abs(total - 1.5 * sum(len(r[1].split()) for r in rows)) <= 2000
    assert mixing.mix(df, keep=["size"]).columns.count("size") == 1


def test_repeated_page_ids_keep_their_own_payloads(spark, tmp_path):
    pages = [(1, "x" * 2000), (1, "tiny"), (1, "y" * 3000), (5, "x" * 2000), (6, "y" * 3000), (6, "y" * 3000), (None, "x" * 2000)]
    df = spark.createDataFrame([(i, f"http://h/{k}", html) for k, (i, html) in enumerate(pages)], "page_id long, url string, html string")
    got = sorted(((r["page_id"] or 0, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive(df, str(tmp_path / "w")).collect()), key=str)
    assert got == sorted([(1, 2000, "revisit", 5), (1, 4, "response", None), (1, 3000, "revisit", 6), (5, 2000, "response", None), (6, 3000, "response", None), (6, 3000, "response", None), (0, 2000, "response", None)], key=str)
