import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from cairnlake.llm import bpe_replay, pairs, segments, token_counts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = [*"aaabcde'strevmdl  \n\t12.,!éÉß　\xa0漢😀\x1cΣİ", "<|endoftext|>", "<|startoftext|>", "the ", "ing", " hello", "'ll", "aaaa"]
EDGES = [None, "", " ", "\n\n ", "x" * 3000, "don't 've 'll's", "word " * 5000, "same", "same"]


def texts(n, seed):
    rng = random.Random(seed)
    return EDGES + ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 80))) for _ in range(n)]


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library_and_decodes(spark):
    rows = list(enumerate(texts(300, 1)))
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, ids string")
    got = {r["doc_id"]: r for r in bpe_replay.encode(df, RANKS).collect()}
    trips = {r["doc_id"]: r for r in bpe_replay.round_trip(df, RANKS).collect()}
    enc = reference()
    for i, text in rows:
        ids = enc.encode_ordinary(text or "")
        assert list(got[i]["ids"]) == ids and got[i]["restored"] and got[i]["n_tokens"] == len(ids)
        assert trips[i]["n_tokens"] == len(ids)
        assert trips[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert trips[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_counts_equal_the_library(spark):
    rows = list(enumerate(texts(300, 2)))
    df = spark.createDataFrame([(i, t, 7) for i, t in rows], "doc_id long, text string, n_tokens int")
    got = {r["doc_id"]: r for r in token_counts.count_tokens(df, WORDS, limit=20).collect()}
    library = Tokenizer.from_file(WORDS)
    for i, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (got[i]["n_tokens"], got[i]["over_limit"], got[i]["n_bytes"]) == (n, n > 20, len((text or "").encode()))


def test_empty_tables_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_replay.round_trip(empty, RANKS).count() == 0
    assert token_counts.count_tokens(empty, WORDS).count() == 0
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(r["n_tokens"] for r in bpe_replay.round_trip(df, RANKS).collect()) == [0, 2]


def test_tables_of_merges():
    words = pairs.merged_words(WORDS)
    assert not words.early.any()  # merges only ever build on earlier merges
    found = words.pairs.find(np.array([-1, 5]), np.array([3, -2]))
    assert (found == -1).all()


def test_every_character_counts_as_in_the_library():
    library, words = Tokenizer.from_file(WORDS), pairs.merged_words(WORDS)
    characters = segments.every_character()
    for at in range(0, len(characters), 50_000):
        few = [f"ab{c}cd {c}1e\u0301{c}\u0307" for c in characters[at : at + 50_000]]
        expected = [len(e.ids) for e in library.encode_batch(few, add_special_tokens=False)]
        assert token_counts.count_block(few, words, WORDS).tolist() == expected


def test_every_character_is_encoded_as_in_the_library(spark):
    characters = [c for c in segments.every_character() if c != "\x00"]
    rows = [(i, "".join(f"ab{c}cd {c}1 " for c in characters[i : i + 5_000])) for i in range(0, len(characters), 5_000)]
    got = {r["doc_id"]: r["ids"] for r in bpe_replay.encode(spark.createDataFrame(rows, "doc_id long, text string"), RANKS).collect()}
    enc = reference()
    for i, text in rows:
        assert list(got[i]) == enc.encode_ordinary(text)
