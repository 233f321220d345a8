"""The registered query of each operator: production parameters, whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from cairnlake.llm import bpe_replay, chat, jaccard_join, lattice, mixing, quality, resampling, spelling, spotsigs, suffix_dedup, token_counts, toxicity, warc
from cairnlake.llm.common import table


def op1_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, table(spark, sf_dir, "labels"))
    return toxicity.score(documents, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "toxic_neighbours", "terms", "evidence")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_bpe_merge_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_replay.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_lattice_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat.read_back(chat.format_conversations(rows))


def op8_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compare_edits(table(spark, sf_dir, "documents"))


def op9_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_groups(table(spark, sf_dir, "documents"))


def op11_quality_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.fit(documents, table(spark, sf_dir, "labels"))
    return quality.score(documents, model).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted", "vote")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_toxic_neighbours, op2_suffix_dedup, op3_bpe_merge_replay, op4_source_mixing, op5_token_counts, op6_lattice_vectors, op7_chat_formatting, op8_spot_signatures, op9_warc_archive, op10_jaccard_join, op11_quality_neighbours, op12_spelling_variants, op13_importance_resampling)}


def _crc_sql(text: str) -> str:
    """CRC-32 of a text's UTF-8, with a table `crc` that holds the list `tab` in reach."""
    each = f"list_transform(range(0, strlen({text})), lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::INTEGER, 2))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {each}), lambda s, b: xor(s // 256, tab[(xor(s, b) % 256 + 1)::INTEGER])), 4294967295)"


_CRC_TABLE = "crc AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i)))"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The rest is not expressible in SQL; tests compare them with brute force, exact round trips or held-out labels.
ORACLES: dict[str, str] = {
    "op4_source_mixing": r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
b AS (SELECT *, len(bin(size)) * 32 + (size >> greatest(len(bin(size)) - 5, 0)) AS band, ('0x' || h[1:2])::INTEGER % 64 AS bucket FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM b GROUP BY source),
c AS (SELECT *, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, ((sum(source_size) OVER ()) * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target, CASE WHEN source_size > 0 THEN least(cap, weight * max(level) OVER ()) / source_size ELSE 0.0::DOUBLE END AS rate,
  ('0x' || md5(concat_ws('#', '0', source))[1:3])::INTEGER / 4096.0::DOUBLE AS u FROM l),
r AS (SELECT b.doc_id, b.size, t.source_size, t.target, t.rate, t.u, row_number() OVER (PARTITION BY b.source ORDER BY b.band, b.bucket, b.size, b.h, b.doc_id) AS place FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, (floor(place * rate + u) - floor((place - 1) * rate + u))::BIGINT AS copies FROM r)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM k""",
    "op7_chat_formatting": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(4 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + 2 + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')) + 8)::BIGINT AS formatted_chars, false AS rewrites
FROM c GROUP BY conv_id""",
    "op9_warc_archive": r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, max(page_id) AS origin FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT p.page_id, payload_bytes::BIGINT AS payload_bytes, p.payload_digest, CASE WHEN origin <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN origin <> p.page_id THEN origin END AS refers_to FROM p LEFT JOIN f ON f.payload_digest = p.payload_digest AND payload_bytes >= 1000""",
    "op10_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')] ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS s FROM g),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS k FROM e a JOIN e b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c WHERE 100 * k >= 75 * (nx + ny - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT g.doc_id, len(sh)::BIGINT AS n_shingles, m.component_id FROM g JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) m ON m.x = g.doc_id""",
    "op12_spelling_variants": rf"""
WITH RECURSIVE {_CRC_TABLE},
r AS (SELECT doc_id, run, count(*) AS k FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents) GROUP BY ALL),
k AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS t, run, k FROM r WHERE length(run) >= 6),
h AS (SELECT run, k, {_crc_sql("t")} AS h FROM k, crc),
c AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INTEGER) || substr(run, (h % length(run) + 2)::INTEGER) ELSE run END AS word, k FROM h),
v AS (SELECT word, sum(k)::BIGINT AS n FROM c WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
d AS (SELECT word, i, substr(word, 1, (i - 1)::INTEGER) || substr(word, (i + 1)::INTEGER) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
e AS (SELECT a.word AS x, b.word AS y FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT d.word, v.word FROM d JOIN v ON d.rest = v.word UNION SELECT v.word, d.word FROM d JOIN v ON d.rest = v.word),
m AS (SELECT x, y, v.n, count(*) OVER (PARTITION BY x) AS n_near, row_number() OVER (PARTITION BY x ORDER BY v.n DESC, y) AS place FROM e JOIN v ON v.word = e.y),
f AS (SELECT v.word, v.n, coalesce(m.n_near, 0) AS n_near, CASE WHEN m.n >= 5 * v.n THEN m.y END AS form, CASE WHEN m.n >= 5 * v.n THEN m.n END AS form_n FROM v LEFT JOIN m ON m.x = v.word AND m.place = 1),
w AS (SELECT word, word AS place FROM f UNION ALL SELECT w.word, f.form FROM w JOIN f ON f.word = w.place AND f.form IS NOT NULL)
SELECT f.word, f.form, w.place AS root, f.n, f.n_near, f.form_n FROM f JOIN w ON w.word = f.word JOIN f g ON g.word = w.place AND g.form IS NULL""",
    "op13_importance_resampling": rf"""
WITH {_CRC_TABLE},
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
x AS (SELECT doc_id, unnest(ws) AS word FROM d),
q AS (SELECT unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
u AS (SELECT word, {_crc_sql("word")} % 10000 AS bucket FROM (SELECT word FROM x UNION SELECT word FROM q), crc),
s AS (SELECT bucket, count(*)::DOUBLE AS s FROM x JOIN u USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*)::DOUBLE AS t FROM q JOIN u USING (word) GROUP BY bucket),
z AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS ss, (SELECT coalesce(sum(t), 0) FROM t) AS tt),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (ss + 10000) / ((coalesce(s, 0) + 1) * (tt + 10000)))) AS gain FROM s FULL JOIN t USING (bucket), z),
w AS (SELECT doc_id, floor(sum(gain) / count(*))::BIGINT AS weight FROM x JOIN u USING (word) JOIN g USING (bucket) GROUP BY doc_id),
c AS (SELECT d.doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
  + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(d.doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN w ON w.doc_id = d.doc_id),
o AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM c WHERE n_features >= 20)
SELECT c.*, CASE WHEN place <= (SELECT count(*) FROM o) * 10 // 100 THEN place END AS rank FROM c LEFT JOIN o ON o.doc_id = c.doc_id""",
}
