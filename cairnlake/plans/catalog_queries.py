"""Registered queries of the catalog operators over the driver's tables, each with the SQL that gives the same rows.

The tables stand in for catalog data: events for the event log, orders for package versions of a customer,
lineitem for rows to merge, documents and pages for package contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions import scalars
from cairnlake.functions.canonical_json import canonical_json
from cairnlake.operators import checks, edges, events, frameworks, merge, ranks, repositories, reprocess, universe
from cairnlake.plans import drivers
from cairnlake.plans.registry import TABLES
from cairnlake.sources import archives
from cairnlake.sources.asset_store import AssetStore
from cairnlake.sources.bucket_tables import BucketTable
from cairnlake.sources.folders import rewritten, shared_dir
from cairnlake.sources.ledger import Ledger
from cairnlake.sources.reference_counts import ReferenceCounts
from cairnlake.streaming import incremental, keyed_state

QUERIES: dict = {}
ORACLES: dict = {}


def _query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LOW, HIGH = "2024-01-05 00:00:00", "2024-01-20 00:00:00"


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


@_query("""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1""")
def latest_event_per_key(spark, sf_dir):
    log = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return events.latest(log, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@_query(f"SELECT event_id, event_type FROM events WHERE ts > TIMESTAMP '{LOW}' AND ts <= TIMESTAMP '{HIGH}'")
def commit_range(spark, sf_dir):
    return _t(spark, sf_dir, "events").where(events.in_bounds(F.col("ts"), _ntz(LOW), _ntz(HIGH))).select("event_id", "event_type")


@_query("""
WITH pages AS (SELECT strftime(o_orderdate, '%Y-%m') AS page, count(*) AS leaves FROM orders GROUP BY 1),
     l AS (SELECT *, lag(page) OVER (ORDER BY page) AS b FROM pages WHERE page > '1996-03')
SELECT page, leaves FROM l WHERE b IS NULL OR b <= '1998-06'""")
def page_pruning(spark, sf_dir):
    pages = _t(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("page")).agg(F.count("*").alias("leaves"))
    return events.prune_pages(pages, "page", "1996-03", "1998-06").select("page", "leaves")


@_query("""
SELECT user_id, strftime(ts, '%Y-%m-%d') AS page, event_type, max_by(event_id, (ts, event_id)) AS event_id
FROM events GROUP BY 1, 2, 3""")
def redundant_leaves(spark, sf_dir):
    log = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd").alias("page"))
    return events.drop_redundant(log, "page", ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "page", "event_type", "event_id")


@_query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS version_order FROM orders),
f AS (SELECT *,
  max(CASE WHEN o_orderstatus <> 'F' THEN version_order END) OVER w AS a,
  max(CASE WHEN o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW' THEN version_order END) OVER w AS b,
  max(CASE WHEN o_orderstatus = 'O' THEN version_order END) OVER w AS c,
  max(CASE WHEN o_orderstatus = 'O' AND o_orderpriority <> '5-LOW' THEN version_order END) OVER w AS d
  FROM r WINDOW w AS (PARTITION BY o_custkey))
SELECT o_orderkey, o_custkey, version_order, coalesce(a = version_order, false) AS is_latest_any, coalesce(b = version_order, false) AS is_latest_stable_any,
  coalesce(c = version_order, false) AS is_latest, coalesce(d = version_order, false) AS is_latest_stable FROM f""")
def rank_and_latest_flags(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    listed, first, stable = F.col("o_orderstatus") != "F", F.col("o_orderstatus") == "O", F.col("o_orderpriority") != "5-LOW"
    flags = {"is_latest_any": listed, "is_latest_stable_any": listed & stable, "is_latest": first, "is_latest_stable": first & stable}
    out = ranks.latest_flags(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], flags, "version_order")
    return out.select("o_orderkey", "o_custkey", F.col("version_order").cast("long").alias("version_order"), *flags)


@_query("""
WITH r AS (SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate, CASE WHEN l_orderkey % 2 = 0 THEN NULL ELSE l_suppkey END AS scanned, l_suppkey % 7 AS batch FROM lineitem),
k AS (SELECT *, rank() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, scanned DESC NULLS LAST, batch) AS n FROM r)
SELECT DISTINCT l_partkey, l_orderkey, l_linenumber FROM k WHERE n = 1""")
def merge_prune(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_shipdate", F.when(F.col("l_orderkey") % 2 != 0, F.col("l_suppkey")).alias("scanned"), (F.col("l_suppkey") % 7).alias("batch"))
    existing, new = rows.where("scanned is null"), rows.where("scanned is not null")
    return merge.newest_batch(existing.unionByName(new), ["l_partkey"], "l_shipdate", "scanned", "batch").select("l_partkey", "l_orderkey", "l_linenumber").distinct()


@_query("""
SELECT l_partkey, max_by(l_returnflag, (l_shipdate, l_orderkey, l_linenumber)) AS l_returnflag,
  max_by(l_quantity, (l_orderkey, l_shipdate, l_orderkey, l_linenumber)) AS l_quantity,
  max_by(l_tax, (l_suppkey, l_shipdate, l_orderkey, l_linenumber)) AS l_tax
FROM lineitem GROUP BY l_partkey HAVING NOT bool_or(l_discount = 0.1 AND l_tax = 0.08 AND l_linestatus = 'F')""")
def max_block_merge(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", "l_shipdate", "l_linenumber", F.col("l_orderkey").alias("signed"), "l_quantity", F.col("l_suppkey").alias("stamped"), "l_tax", "l_orderkey", ((F.col("l_discount") == 0.1) & (F.col("l_tax") == 0.08) & (F.col("l_linestatus") == "F")).alias("gone"))
    out = merge.block_merge(rows, "l_partkey", ["l_shipdate", "l_orderkey", "l_linenumber"], {"signed": ["l_quantity"], "stamped": ["l_tax"]}, "gone")
    return out.select("l_partkey", "l_returnflag", "l_quantity", "l_tax")


@_query("""
SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM (
 SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity DESC, l_orderkey, l_linenumber) n FROM lineitem) WHERE n = 1""")
def most_downloads(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity")
    return merge.greatest_row(rows, ["l_partkey"], "l_quantity", ["l_orderkey", "l_linenumber"])


@_query("""
SELECT p_partkey, coalesce(q, 0)::BIGINT AS downloads, sum(coalesce(q, 0)) OVER (PARTITION BY p_brand)::BIGINT AS total_downloads
FROM part LEFT JOIN (SELECT l_partkey, sum(l_quantity)::BIGINT AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON p_partkey = l_partkey""")
def totals_with_universe(spark, sf_dir):
    known = _t(spark, sf_dir, "part").select("p_partkey", "p_brand")
    facts = _t(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").cast("long").alias("downloads"))
    rows = universe.with_defaults(known, facts, ["p_partkey"], {"downloads": 0})
    totals = rows.groupBy("p_brand").agg(F.sum("downloads").alias("total_downloads"))
    return rows.join(totals, "p_brand").select("p_partkey", "downloads", "total_downloads")


@_query("""
WITH m AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS f FROM events WINDOW w AS (ORDER BY event_id)),
r AS (SELECT *, sum(f) OVER (ORDER BY event_id) AS run FROM m),
l AS (SELECT run, event_type, user_id, max_by(event_id % 1000, event_id) AS downloads FROM r GROUP BY 1, 2, 3)
SELECT run::BIGINT AS run, event_type, user_id, downloads, sum(downloads) OVER (PARTITION BY run)::BIGINT AS total FROM l""")
def contiguous_run_totals(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select("event_id", "event_type", "user_id", (F.col("event_id") % 1000).alias("downloads"))
    return universe.run_totals(rows, "event_id", "event_type", "user_id", "downloads").withColumn("run", F.col("run").cast("long"))


@_query("""
WITH e AS (SELECT event_id, event_type AS key, user_id::BIGINT AS part, event_id % 1000 AS value FROM events),
m AS (SELECT *, CASE WHEN lag(key) OVER (ORDER BY event_id) IS NOT DISTINCT FROM key THEN 0 ELSE 1 END AS f FROM e),
r AS (SELECT *, (sum(f) OVER (ORDER BY event_id))::BIGINT AS run FROM m),
l AS (SELECT run, key, part, max_by(value, event_id) AS value FROM r GROUP BY 1, 2, 3),
t AS (SELECT run, any_value(key) AS key, sum(value)::BIGINT AS total FROM l GROUP BY 1),
k AS (SELECT DISTINCT key, part FROM e UNION SELECT c_mktsegment, c_custkey FROM customer),
s AS (SELECT key, part, min(run) AS seen FROM r GROUP BY 1, 2)
SELECT run, key, part, value::BIGINT AS value, total FROM l JOIN t USING (run, key)
UNION ALL SELECT t.run, k.key, k.part, 0, t.total FROM k JOIN t ON t.key = k.key LEFT JOIN s ON s.key = k.key AND s.part = k.part WHERE s.seen IS NULL OR t.run < s.seen
UNION ALL SELECT NULL, key, part, 0, 0 FROM k WHERE key NOT IN (SELECT key FROM t)""")
def run_totals_with_unseen(spark, sf_dir):
    """Totals of runs, and the known parts that a run has not named, with 0 and its total."""
    rows = _t(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("key"), F.col("user_id").cast("long").alias("part"), (F.col("event_id") % 1000).cast("long").alias("value"))
    known = rows.select("key", "part").unionAll(_t(spark, sf_dir, "customer").select("c_mktsegment", F.col("c_custkey").cast("long")))
    return universe.run_totals(rows, "event_id", "key", "part", "value", known)


@_query("SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS place FROM orders")
def global_rank(spark, sf_dir):
    """Every order's place among all of them by price."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return events.ranked(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], name="place").select("o_orderkey", "o_custkey", "place")


@_query("""
SELECT c_custkey, coalesce(string_agg(v, '|' ORDER BY v), '') AS owners FROM customer
LEFT JOIN (SELECT DISTINCT o_custkey, lower(o_orderpriority) AS v FROM orders WHERE o_orderstatus = 'F') ON o_custkey = c_custkey GROUP BY 1""")
def owners_set(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"), F.lower("o_orderpriority").alias("owner"))
    sets = universe.sorted_set(rows, "c_custkey", "owner", name="owners")
    out = universe.with_defaults(_t(spark, sf_dir, "customer").select("c_custkey"), sets, ["c_custkey"], {"owners": F.array().cast("array<string>")})
    return out.select("c_custkey", F.array_join("owners", "|").alias("owners"))


@_query("""
SELECT p_partkey, coalesce(l_suppkey, -1) AS supplier, CASE WHEN l_suppkey IS NULL THEN 'NoDependent' ELSE 'Dependent' END AS result_type FROM part
LEFT JOIN (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem WHERE l_linenumber = 7) ON p_partkey = l_partkey""")
def dependents(spark, sf_dir):
    uses = _t(spark, sf_dir, "lineitem").where("l_linenumber = 7").select("l_suppkey", F.col("l_partkey").cast("string").alias("package"), "l_partkey")
    pairs = universe.dependents(uses, "l_suppkey", "package", ["l_partkey"]).select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("supplier"), F.lit("Dependent").alias("result_type"))
    return universe.with_defaults(_t(spark, sf_dir, "part").select("p_partkey"), pairs, ["p_partkey"], {"supplier": -1, "result_type": "NoDependent"})


@_query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P') AS is_verified FROM customer")
def verified_flags(spark, sf_dir):
    named = _t(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT' and o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return universe.flagged(_t(spark, sf_dir, "customer").select("c_custkey"), named, "c_custkey", "is_verified")


@_query("""
WITH l AS (SELECT DISTINCT c_custkey AS k FROM customer), r AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'),
a AS (SELECT k FROM l EXCEPT SELECT k FROM r), b AS (SELECT k FROM r EXCEPT SELECT k FROM l)
SELECT (SELECT count(*) FROM a) AS left_only, (SELECT count(*) FROM b) AS right_only,
 coalesce((SELECT string_agg(k::VARCHAR, ',' ORDER BY k) FROM (SELECT k FROM a ORDER BY k LIMIT 5)), '') AS left_sample,
 coalesce((SELECT string_agg(k::VARCHAR, ',' ORDER BY k) FROM (SELECT k FROM b ORDER BY k LIMIT 5)), '') AS right_sample""")
def set_compare_full_outer(spark, sf_dir):
    left = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    right = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"))
    out = checks.compare_sets(left, right, "k")
    return out.select("left_only", "right_only", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("left_sample", "right_sample")])


_KEYS = {"customer": "c_custkey", "lineitem": "l_suppkey", "orders": "o_custkey", "part": "p_partkey", "supplier": "s_suppkey"}


def _pair_sql(a: str, b: str) -> str:
    only = lambda x, y: f"(SELECT {_KEYS[x]} AS k FROM {x} EXCEPT SELECT {_KEYS[y]} FROM {y})"
    few = lambda x, y: f"coalesce((SELECT string_agg(k::VARCHAR, ',' ORDER BY k) FROM (SELECT k FROM {only(x, y)} ORDER BY k LIMIT 5)), '')"
    return f"SELECT '{a}' AS left_table, '{b}' AS right_table, (SELECT count(*) FROM {only(a, b)}) AS left_only, (SELECT count(*) FROM {only(b, a)}) AS right_only, {few(a, b)} AS left_sample, {few(b, a)} AS right_sample"


@_query(" UNION ALL ".join(_pair_sql(a, b) for a in _KEYS for b in _KEYS if a < b))
def set_compare_many(spark, sf_dir):
    """The keys of five tables, each with each other."""
    out = checks.compare_all({t: _t(spark, sf_dir, t).select(F.col(c).alias("k")) for t, c in _KEYS.items()}, "k")
    return out.select("left_table", "right_table", "left_only", "right_only", *[F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("left_sample", "right_sample")])


@_query("SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def subset_check(spark, sf_dir):
    return checks.missing(_t(spark, sf_dir, "documents"), ["doc_id"], _t(spark, sf_dir, "labels").select("doc_id"), "doc_id")


@_query("SELECT count(*) AS n FROM (SELECT DISTINCT unnest([l_partkey, l_suppkey, l_orderkey]) AS k FROM lineitem) WHERE k NOT IN (SELECT p_partkey FROM part)")
def orphan_count(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey")
    return checks.missing(lines, ["l_partkey", "l_suppkey", "l_orderkey"], _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("k")), "k").agg(F.count("*").alias("n"))


@_query("""
SELECT 'customer' AS table_name, count(DISTINCT c_custkey) AS n FROM customer UNION ALL SELECT 'orders', count(DISTINCT o_custkey) FROM orders
UNION ALL SELECT 'lineitem', count(DISTINCT l_orderkey) FROM lineitem UNION ALL SELECT 'part', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'events', count(DISTINCT user_id) FROM events""")
def distinct_counts_union(spark, sf_dir):
    named = {"customer": "c_custkey", "orders": "o_custkey", "lineitem": "l_orderkey", "part": "p_brand", "events": "user_id"}
    return checks.distinct_counts({t: (_t(spark, sf_dir, t), c) for t, c in named.items()})


@_query("""
WITH v AS (SELECT DISTINCT event_id FROM events), n AS (
 SELECT * FROM (SELECT event_id FROM v WHERE event_id <= 500 ORDER BY 1 DESC LIMIT 2) UNION SELECT * FROM (SELECT event_id FROM v WHERE event_id >= 500 ORDER BY 1 LIMIT 2))
SELECT CASE WHEN event_id < 500 THEN 'before' WHEN event_id = 500 THEN 'same' ELSE 'after' END AS label, min(event_id) AS low, max(event_id) AS high FROM n GROUP BY 1""")
def adjacent_commits(spark, sf_dir):
    return checks.adjacent(_t(spark, sf_dir, "events").select("event_id"), "event_id", 500)


@_query("""
SELECT coalesce((SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'O'), -1) AS new_max, coalesce((SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'X'), -1) AS old_max,
 coalesce((SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'O'), -1) > coalesce((SELECT max(o_orderkey) FROM orders WHERE o_orderstatus = 'X'), -1) AS is_newer""")
def newness(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    return checks.newer(orders.where("o_orderstatus = 'O'"), orders.where("o_orderstatus = 'X'"), "o_orderkey", F.lit(-1).cast("long"))


@_query("""
WITH h AS (SELECT c_custkey, c_name, sha256(lower(c_name)) AS d FROM customer)
SELECT c_custkey, (('0x' || d[15:16] || d[13:14] || d[11:12] || d[9:10] || d[7:8] || d[5:6] || d[3:4] || d[1:2])::UBIGINT % 1000)::INTEGER AS bucket FROM h""")
def bucket_assign(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select("c_custkey", scalars.bucket(F.lower("c_name"), 1000).alias("bucket"))


@_query("""
WITH f AS (SELECT doc_id, source, lang, sha256(text) AS d, strlen(text) AS size FROM documents),
g AS (SELECT *, row_number() OVER (PARTITION BY source, d ORDER BY doc_id) > 1 AS is_duplicate FROM f),
b AS (SELECT *, coalesce(sum(CASE WHEN is_duplicate THEN 0 ELSE size END) OVER (PARTITION BY source, lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used FROM g),
k AS (SELECT *, CASE WHEN is_duplicate THEN 0 ELSE least(size, 16384, greatest(0, 16384 - used)) END AS kept FROM b),
t AS (SELECT *, NOT is_duplicate AND kept < size AS truncated FROM k)
SELECT doc_id, is_duplicate, kept::BIGINT AS kept_size, truncated, bool_or(truncated) OVER (PARTITION BY source) AS package_truncated FROM t""")
def content_budget(spark, sf_dir):
    files = _t(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.sha2("text", 256).alias("digest"), F.octet_length("text").alias("size"))
    return ranks.content_budget(files, ["source"], "lang", ["doc_id"], "size", "digest").select("doc_id", "is_duplicate", "kept_size", "truncated", "package_truncated")


@_query("""
WITH u AS (SELECT url, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host FROM pages)
SELECT CASE WHEN host = '' THEN 'invalid' ELSE host END AS repo, count(*) AS n, min(url) AS example FROM u GROUP BY 1""")
def url_repo_summary(spark, sf_dir):
    host = F.regexp_extract("url", r"^https?://([^/?#:]+)", 1)
    return _t(spark, sf_dir, "pages").select("url", F.when(host == "", "invalid").otherwise(host).alias("repo")).groupBy("repo").agg(F.count("*").alias("n"), F.min("url").alias("example"))


@_query("""
SELECT o_orderkey, o_custkey FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS m FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
WHERE coalesce(o_orderdate, m) >= TIMESTAMP '1997-01-01 00:00:00' ORDER BY coalesce(o_orderdate, m), o_orderkey LIMIT 100""")
def keyset_page(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    firsts = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_shipdate")
    return checks.keyset_page(orders, firsts, "o_orderkey", "l_shipdate", "o_orderdate", _ntz("1997-01-01 00:00:00"), 100).select("o_orderkey", "o_custkey")


@_query("SELECT p_partkey, p_name FROM part WHERE NOT (regexp_matches(lower(p_name), '^red ') AND p_size BETWEEN 10 AND 20) AND NOT (regexp_matches(lower(p_name), 'bolt$') AND p_size BETWEEN 30 AND 50)")
def ignored_filter(spark, sf_dir):
    return events.without_ignored(_t(spark, sf_dir, "part"), "p_name", "p_size", [("^RED ", 10, 20), ("bolt$", 30, 50)]).select("p_partkey", "p_name")


@_query("""
SELECT bucket FROM (SELECT c_custkey AS bucket, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal END AS last_processed FROM customer)
WHERE (last_processed IS NULL OR last_processed < 3000) AND bucket <= 400 ORDER BY last_processed ASC NULLS FIRST, bucket LIMIT 50""")
def stale_buckets(spark, sf_dir):
    buckets = _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("bucket"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal")).alias("last_processed"))
    return reprocess.due_buckets(buckets, 3000.0, 400).select("bucket")


@_query("""
SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) n FROM events) WHERE n <= 3""")
def newest_runs(spark, sf_dir):
    return reprocess.newest_runs(_t(spark, sf_dir, "events").select("user_id", "event_id"), 3, ["user_id"], "event_id")


@_query("""
WITH o AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem WHERE l_returnflag <> 'N'), n AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem WHERE l_returnflag <> 'A')
SELECT a, b, 'kept' AS change FROM (SELECT * FROM o INTERSECT SELECT * FROM n) UNION ALL SELECT a, b, 'removed' FROM (SELECT * FROM o EXCEPT SELECT * FROM n) UNION ALL SELECT a, b, 'added' FROM (SELECT * FROM n EXCEPT SELECT * FROM o)""")
def edge_diff(spark, sf_dir):
    pairs = _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), F.col("l_suppkey").alias("b"), "l_returnflag")
    return edges.edge_changes(pairs.where("l_returnflag <> 'N'"), pairs.where("l_returnflag <> 'A'"), ["a", "b"])


@_query("""
SELECT DISTINCT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 1 AND l_returnflag = 'N')""")
def orphan_subjects(spark, sf_dir):
    lines = _t(spark, sf_dir, "lineitem").select("l_suppkey", "l_quantity", "l_returnflag")
    return edges.orphans(lines.where("l_quantity = 50"), lines.where("l_quantity = 1 and l_returnflag = 'N'"), "l_suppkey")


@_query("""
WITH o AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem WHERE l_returnflag <> 'N'), n AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 40)
SELECT s.b AS supplier, count(n.a) AS owners FROM (SELECT b FROM o UNION SELECT b FROM n) s LEFT JOIN n ON n.b = s.b GROUP BY 1""")
def owner_counts(spark, sf_dir):
    """Owners of each subject after two runs of edge changes: all edges of one age, then what differs in the next."""
    pairs = _t(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("owner"), F.col("l_suppkey").alias("subject"), "l_returnflag", "l_quantity")
    old, new = pairs.where("l_returnflag <> 'N'"), pairs.where("l_returnflag = 'R' and l_quantity > 40")
    kept = ReferenceCounts.at(spark, shared_dir(spark))
    kept.apply(edges.edge_changes(old.limit(0), old, ["owner", "subject"]), 1)
    kept.apply(edges.edge_changes(old, new, ["owner", "subject"]), 2)
    return kept.counts().select(F.col("subject").cast("long").alias("supplier"), F.col("n").alias("owners"))


@_query("SELECT event_id, (json_extract(props, '$.k'))::BIGINT AS k FROM events")
def json_explode(spark, sf_dir):
    props = F.from_json("props", "map<string,bigint>")
    return _t(spark, sf_dir, "events").select("event_id", F.posexplode(props).alias("pos", "name", "k")).where("name = 'k'").select("event_id", "k")


@_query("""
SELECT user_id, count(*) AS n, arg_max(event_type, event_id) AS last_type, min(CASE WHEN event_type = 'purchase' THEN event_id END) AS first_purchase FROM events GROUP BY 1""")
def catalog_minimums(spark, sf_dir):
    log = _t(spark, sf_dir, "events")
    return log.groupBy("user_id").agg(F.count("*").alias("n"), F.max_by("event_type", "event_id").alias("last_type"), F.min(F.when(F.col("event_type") == "purchase", F.col("event_id"))).alias("first_purchase"))


@_query("""
SELECT c_nationkey, bit_or(1 << (CASE c_mktsegment WHEN 'BUILDING' THEN 0 WHEN 'AUTOMOBILE' THEN 1 WHEN 'MACHINERY' THEN 2 WHEN 'HOUSEHOLD' THEN 3 ELSE 4 END))::BIGINT AS flags FROM customer GROUP BY 1""")
def flags_by_key(spark, sf_dir):
    bit = F.create_map(*[F.lit(x) for pair in (("BUILDING", 1), ("AUTOMOBILE", 2), ("MACHINERY", 4), ("HOUSEHOLD", 8)) for x in pair])[F.col("c_mktsegment")]
    return _t(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.bit_or(F.coalesce(bit, F.lit(16)).cast("long")).alias("flags"))


@_query("""
SELECT page_id, regexp_extract(u, '([^/]*)$', 1) AS file_name, CASE WHEN regexp_extract(regexp_extract(u, '([^/]*)$', 1), '(\\.[^.]*)$', 1) = '' THEN NULL ELSE regexp_extract(regexp_extract(u, '([^/]*)$', 1), '(\\.[^.]*)$', 1) END AS extension,
 regexp_extract(u, '^([^/]*)/', 1) AS top_folder FROM (SELECT page_id, regexp_replace(url, '^https?://', '') AS u FROM pages) WHERE contains(u, '/')""")
def path_parts(spark, sf_dir):
    u = F.regexp_replace("url", "^https?://", "")
    rows = _t(spark, sf_dir, "pages").select("page_id", u.alias("u")).where(F.contains("u", F.lit("/")))
    return rows.select("page_id", scalars.file_name(F.col("u")).alias("file_name"), scalars.file_extension(F.col("u")).alias("extension"), scalars.top_folder(F.col("u")).alias("top_folder"))


@_query("""
SELECT e.user_id, count(*) AS n FROM events e LEFT JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 90) c ON c.user_id = e.user_id
WHERE c.user_id IS NULL OR ts <= (SELECT to_timestamp((epoch(min(ts)) + epoch(max(ts))) / 2)::TIMESTAMP FROM events) GROUP BY 1""")
def as_of_existence(spark, sf_dir):
    """Events that count at the middle of the log's time: of users who are not checked, all."""
    log = _t(spark, sf_dir, "events")
    history = log.select(F.col("user_id").alias("lower_id"), F.col("ts").alias("created"))
    first, last = log.agg(F.min("ts"), F.max("ts")).first()
    checked = log.where("event_type = 'purchase' and value > 90").select(F.col("user_id").alias("lower_id"))
    middle = F.lit(None).cast("timestamp_ntz") if first is None else F.lit(first + (last - first) / 2)
    return events.version_set_as_of(history, middle, checked).groupBy(F.col("lower_id").alias("user_id")).agg(F.count("*").alias("n"))


@_query("""
WITH f AS (SELECT date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS as_of, l_suppkey AS supplier, lower(l_returnflag || l_linestatus || l_linenumber) AS part, sum(l_quantity)::BIGINT AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3),
h AS (SELECT l_suppkey AS supplier, lower(l_returnflag || l_linestatus || l_linenumber) AS part, min(l_shipdate) AS created FROM lineitem GROUP BY 1, 2),
k AS (SELECT f.* FROM f JOIN h USING (supplier, part) WHERE created <= as_of),
t AS (SELECT as_of, supplier, sum(n)::BIGINT AS total FROM k GROUP BY 1, 2),
m AS (SELECT DISTINCT as_of FROM f),
i AS (SELECT supplier, min(created) AS created FROM h GROUP BY 1),
u AS (SELECT as_of, supplier FROM m, i WHERE created <= as_of EXCEPT SELECT as_of, supplier FROM f),
r AS (SELECT as_of, supplier, part, n, total FROM k JOIN t USING (as_of, supplier)
  UNION ALL SELECT t.as_of, t.supplier, h.part, 0, t.total FROM t JOIN h ON h.supplier = t.supplier AND created <= as_of LEFT JOIN f ON f.as_of = t.as_of AND f.supplier = t.supplier AND f.part = h.part WHERE f.part IS NULL
  UNION ALL SELECT as_of, supplier, part, 0, 0 FROM u JOIN h USING (supplier))
SELECT as_of, supplier, count(*) AS parts, count(CASE WHEN n > 0 THEN 1 END) AS named, sum(n)::BIGINT AS n, max(total)::BIGINT AS total, md5(string_agg(part, ',' ORDER BY part)) AS digest FROM r GROUP BY 1, 2""")
def history_backfill(spark, sf_dir):
    """A snapshot of each month of orders, with the parts that existed at its end."""
    part = F.lower(F.concat("l_returnflag", "l_linestatus", "l_linenumber")).alias("part")
    lines = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("supplier"), part, "l_quantity", F.col("l_shipdate").alias("created"))
    month = F.timestamp_add("MONTH", F.lit(1), F.date_trunc("month", "o_orderdate")).cast("timestamp_ntz").alias("as_of")
    months = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), month)
    facts = rewritten(lines.join(months, "l_orderkey").groupBy("as_of", "supplier", "part").agg(F.sum("l_quantity").cast("long").alias("n")))
    out = events.backfill(lines, facts, facts, "supplier", "part", "n")
    digest = F.md5(F.array_join(F.array_sort(F.collect_list("part")), ",")).alias("digest")
    named = F.count(F.when(F.col("n") > 0, 1)).alias("named")
    return out.groupBy("as_of", "supplier").agg(F.count("*").alias("parts"), named, F.sum("n").alias("n"), F.max("total").alias("total"), digest)


@_query("""
WITH e AS (SELECT user_id::VARCHAR AS id, ts AS commit_at, hour(ts) < 12 AS early FROM events),
a AS (SELECT id, max(commit_at) AS c FROM e WHERE early GROUP BY 1),
p AS (SELECT e.id, e.commit_at, a.c IS NOT NULL AND e.commit_at <= a.c AS reused FROM e LEFT JOIN a ON a.id = e.id WHERE NOT early),
f AS (SELECT id, count(*) AS items, count(CASE WHEN reused THEN 1 END) AS n_reused, max(CASE WHEN NOT reused THEN commit_at END) AS late FROM p GROUP BY 1),
d AS (SELECT doc_id::VARCHAR AS id, sha256(coalesce(text, '')) AS digest FROM documents)
SELECT f.id, items, n_reused, CASE WHEN late IS NULL THEN 1 ELSE 2 END AS newest_run, digest FROM f LEFT JOIN d ON d.id = f.id""")
def asset_reuse(spark, sf_dir):
    """Two runs over the events before and after noon: digests of documents are fetched where no earlier fetch answers."""
    items = _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("id"), F.col("ts").alias("commit"))
    texts = _t(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    store = AssetStore.at(spark, shared_dir(spark), "id", "timestamp_ntz", "digest string")
    store.resolve(items.where(F.hour("commit") < 12), lambda keys: keys.join(texts, "id"), 1)
    out = store.resolve(items.where(F.hour("commit") >= 12), lambda keys: keys.join(texts, "id"), 2)
    return out.groupBy("id").agg(F.count("*").alias("items"), F.count_if("reused").alias("n_reused"), F.max("run").cast("int").alias("newest_run"), F.max("digest").alias("digest"))


@_query("""
SELECT user_id, event_type, max_by(event_id, event_id) % 3 = 0 AS is_deleted FROM events GROUP BY 1, 2""")
def version_set(spark, sf_dir):
    log = _t(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("version"), "event_id")
    return events.version_set(log, "id", "version", F.col("event_id") % 3 == 0, ["event_id"]).select(F.col("lower_id").cast("long").alias("user_id"), F.col("lower_version").alias("event_type"), "is_deleted")


@_query(ORACLES["latest_event_per_key"])
def catalog_stream(spark, sf_dir):
    """The latest event of each key, kept by a stream over the event files, as a batch finds it."""
    root = shared_dir(spark)
    schema = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    run, table = incremental.merge_bucket_stream(stream, f"{root}/t", f"{root}/cp", ["user_id", "event_type"], ["ts", "event_id"], 16)
    run.awaitTermination()
    return table.read().select("user_id", "event_type", "event_id", "value")


@_query("""
WITH e AS (SELECT *, user_id || '/' || event_type AS identity, CASE WHEN hour(ts) < 12 THEN 1 ELSE 2 END AS scan, date_trunc('day', ts) AS commit_day FROM events),
k AS (SELECT *, rank() OVER (PARTITION BY identity ORDER BY commit_day DESC, scan DESC) AS n FROM e)
SELECT DISTINCT identity, event_id::VARCHAR AS advisory, (event_id % 4)::INTEGER AS severity, commit_day FROM k WHERE n = 1""")
def bucket_merge(spark, sf_dir):
    """Two scans of the events, before and after noon, merged one after the other into a bucketed table."""
    log = _t(spark, sf_dir, "events")
    table = BucketTable.of(spark, shared_dir(spark), TABLES["PackageVulnerabilities"], 32)
    lower = F.col("user_id").cast("string")
    for scan, rows in (("1", log.where(F.hour("ts") < 12)), ("2", log.where(F.hour("ts") >= 12))):
        shaped = rows.select(
            F.lit(scan).alias("ScanId"), F.lit(f"2024-03-0{scan}").cast("timestamp").alias("ScanTimestamp"), lower.alias("LowerId"),
            F.concat_ws("/", lower, "event_type").alias("Identity"), lower.alias("Id"), F.col("event_type").alias("Version"),
            F.date_trunc("day", "ts").cast("timestamp").alias("CatalogCommitTimestamp"), F.lit(None).cast("timestamp").alias("Created"), F.lit("Vulnerable").alias("ResultType"),
            F.lit(None).cast("int").alias("GitHubDatabaseKey"), F.col("event_id").cast("string").alias("AdvisoryUrl"), (F.col("event_id") % 4).cast("int").alias("Severity"),
        )
        table.append(shaped, f"scan-{scan}")
        table.compact()
    return table.read().select(F.col("Identity").alias("identity"), F.col("AdvisoryUrl").alias("advisory"), F.col("Severity").alias("severity"), F.col("CatalogCommitTimestamp").cast("timestamp_ntz").alias("commit_day"))


@_query("""
WITH o AS (SELECT * FROM orders WHERE o_orderstatus <> 'P')
SELECT 'customers' AS table_name, 2 AS version, count(*) AS n, max(o_orderdate) AS newest FROM (SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1)
UNION ALL SELECT 'orders', 2, count(*), max(o_orderdate) FROM orders UNION ALL SELECT 'settled', 1, count(*), max(o_orderdate) FROM o""")
def published_tables(spark, sf_dir):
    """Three tables published together: first of settled orders, then of all; an older set, a set that breaks a check and an unchanged one
    do not take their place."""
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    settled = orders.where("o_orderstatus <> 'P'")
    ledger = Ledger(spark, shared_dir(spark))
    by_customer = lambda df: lambda: df.groupBy("o_custkey").agg(F.max("o_orderdate").alias("o_orderdate"))
    known = {"customers of orders": lambda t: t["orders"].join(t["customers"], "o_custkey", "left_anti")}
    gate = ("orders", "o_orderkey", F.lit(-1).cast("long"))
    least = settled.where(F.col("o_orderkey") < orders.agg(F.max("o_orderkey")).first()[0])
    ledger.publish({"orders": ("a", lambda: least), "customers": ("a", by_customer(least)), "settled": ("a", lambda: settled)}, known, gate)
    ledger.publish({"orders": ("b", lambda: orders), "customers": ("b", by_customer(orders)), "settled": ("a", lambda: settled)}, known, gate)
    ledger.publish({"orders": ("c", lambda: settled), "customers": ("c", by_customer(settled))}, known, gate)
    ledger.publish({"customers": ("d", by_customer(orders.where("o_orderstatus = 'P'")))}, known, gate)
    ledger.publish({"orders": ("b", lambda: orders)}, known, gate)
    parts = [df.agg(F.count("*").alias("n"), F.max("o_orderdate").alias("newest")).select(F.lit(name).alias("table_name"), F.lit(ledger._pointer()[1][name][0]).cast("int").alias("version"), "n", "newest") for name, df in ledger.tables().items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query(r"""
SELECT CASE WHEN host = '' OR host = 'raw.githubusercontent.com' THEN 'Invalid' ELSE 'Unknown' END AS kind,
       nullif(host, '') AS host, count(*) AS n_files, min(url) AS example
FROM (SELECT url, lower(coalesce(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1), '')) AS host FROM pages)
GROUP BY 1, 2""")
def page_repositories(spark, sf_dir):
    """Repositories that the URLs of pages name; none of the pages is a raw file."""
    found = repositories.source_repositories(_t(spark, sf_dir, "pages"), [], "url")
    return found.select("kind", "host", "n_files", "example")


def _json_text(text: str) -> str:
    """SQL of a JSON string: each code point by itself."""
    code = "unicode(c)"
    return rf"""('"' || array_to_string(list_transform(string_split({text}, ''), lambda c: CASE WHEN c = '\' THEN '\\' WHEN {code} = 8 THEN '\b' WHEN {code} = 9 THEN '\t'
 WHEN {code} = 10 THEN '\n' WHEN {code} = 12 THEN '\f' WHEN {code} = 13 THEN '\r' WHEN {code} BETWEEN 32 AND 126 AND c NOT IN ('"', '&', '''', '+', '<', '>', '`') THEN c
 WHEN {code} < 65536 THEN '\u' || printf('%04X', {code}) ELSE '\u' || printf('%04X', 55296 + ({code} - 65536) // 1024) || '\u' || printf('%04X', 56320 + ({code} - 65536) % 1024) END), '') || '"')"""


@_query(rf"""
SELECT conv_id, turn, '{{"body":{{' || CASE WHEN role IS NULL THEN '' ELSE '"role":' || {_json_text("role")} || CASE WHEN text IS NULL THEN '' ELSE ',' END END
 || CASE WHEN text IS NULL THEN '' ELSE '"text":' || {_json_text("text")} END || '}}'
 || CASE WHEN conv_id IS NULL THEN '' ELSE ',"conv_id":' || conv_id END || ',"marks":[' || coalesce(CASE WHEN turn % 2 = 0 THEN 'true' ELSE 'false' END, 'null') || ',null]'
 || CASE WHEN turn IS NULL THEN '' ELSE ',"numbers":{{"next":' || (turn + 1) || ',"turn":' || turn || '}}' END || '}}' AS json
FROM conversations""")
def canonical_turns(spark, sf_dir):
    """The turns of conversations as canonical JSON with structs, arrays and maps in it."""
    rows = _t(spark, sf_dir, "conversations")
    item = F.struct(
        "conv_id", F.struct("text", "role").alias("body"), F.array(F.col("turn") % 2 == 0, F.lit(None)).alias("marks"),
        F.when(F.col("turn").isNotNull(), F.create_map(F.lit("turn"), F.col("turn").cast("long"), F.lit("next"), F.col("turn").cast("long") + 1)).alias("numbers"),
    )
    df = rows.select("conv_id", "turn", item.alias("item"))
    return df.select("conv_id", "turn", canonical_json(F.col("item"), df.schema["item"].dataType).alias("json"))


@_query(rf"""
SELECT event_id, '{{"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || rtrim(rtrim(strftime(ts, '.%f'), '0'), '.') || '","props":{{' || coalesce('"k":' || (props::JSON->>'k'), '') || '}},"type":' || {_json_text("event_type")}
 || ',"user":{{"id":' || user_id || '}},"value":' || regexp_replace(value::VARCHAR, '\.0$', '') || '}}' AS json FROM events""")
def canonical_events(spark, sf_dir):
    """Events, their parsed properties among them, as canonical JSON."""
    item = F.struct(F.col("value"), F.struct(F.col("user_id").alias("id")).alias("user"), F.col("event_type").alias("type"), F.from_json("props", "k long").alias("props"), F.col("ts").alias("at"))
    df = _t(spark, sf_dir, "events").select("event_id", item.alias("item"))
    return df.select("event_id", canonical_json(F.col("item"), df.schema["item"].dataType).alias("json"))


# Names of frameworks by number, and which can use which.
FRAMEWORK_NAMES = ["netstandard2.0", "net6.0", "net472", "netcoreapp3.1", "any", "net6.0-windows10.0.19041", "uap10.0", "portable-net45+win8", "wp8", "NET45", "net8.0", "netmf"]
FRAMEWORK_MATRIX = [
    ("netstandard2.0", "netstandard2.0"), ("netstandard2.0", "netstandard2.1"), ("netstandard2.0", "net472"), ("netstandard2.0", "net6.0"), ("netstandard2.0", "net8.0"),
    ("net6.0", "net6.0"), ("net6.0", "net8.0"), ("net45", "net45"), ("net45", "net472"), ("net472", "net472"), ("netcoreapp3.1", "netcoreapp3.1"), ("netcoreapp3.1", "net6.0"),
    ("netcoreapp3.1", "net8.0"), ("net6.0-windows", "net6.0-windows"), ("net6.0-windows", "net8.0-windows"), ("net8.0", "net8.0"),
]


@_query(f"""
WITH names(i, name) AS (VALUES {", ".join(f"({i}, '{n}')" for i, n in enumerate(FRAMEWORK_NAMES))}), matrix(base, project) AS (VALUES {", ".join(map(str, FRAMEWORK_MATRIX))}),
facts(name, product, place, sort) AS (VALUES ('net6.0', '.NET', 0, 1), ('net6.0-windows10.0.19041', '.NET', 0, 2), ('net8.0', '.NET', 0, 3), ('net8.0-windows', '.NET', 0, 4), ('netcoreapp3.1', '.NET Core', 1, 1),
 ('netstandard2.0', '.NET Standard', 2, 1), ('netstandard2.1', '.NET Standard', 2, 2), ('net45', '.NET Framework', 3, 1), ('net472', '.NET Framework', 3, 2), ('netmf', '.NET Micro Framework', 4, 1),
 ('uap10.0', 'Universal Windows Platform', 5, 1), ('wp8', 'Windows Phone', 6, 1)),
own AS (SELECT DISTINCT l_suppkey, lower(name) AS name FROM lineitem JOIN names ON i = (l_partkey * 7 + l_suppkey * l_suppkey) % 31 WHERE name NOT IN ('any', 'portable-net45+win8')),
found AS (SELECT l_suppkey, own.name AS own, coalesce(project, own.name) AS name FROM own LEFT JOIN matrix ON base = replace(own.name, '10.0.19041', '')),
every AS (SELECT DISTINCT l_suppkey, CASE WHEN name = 'net6.0-windows' THEN own ELSE name END AS name FROM found),
marked AS (SELECT every.l_suppkey, facts.*, own.name IS NULL AS computed FROM every JOIN facts USING (name) LEFT JOIN own ON own.l_suppkey = every.l_suppkey AND own.name = every.name)
SELECT l_suppkey, (row_number() OVER (PARTITION BY l_suppkey ORDER BY place) - 1)::INTEGER AS position, product, string_agg(name || CASE WHEN computed THEN '*' ELSE '' END, ' ' ORDER BY sort) AS frameworks,
 CASE WHEN place < 4 THEN min_by(name, sort) FILTER (NOT computed) END AS badge FROM marked GROUP BY l_suppkey, product, place""")
def framework_products(spark, sf_dir):
    """Product tables of packages whose frameworks the lines of suppliers name."""
    pick = (F.col("l_partkey") * 7 + F.col("l_suppkey") * F.col("l_suppkey")) % 31
    assets = _t(spark, sf_dir, "lineitem").select("l_suppkey", F.get(F.array(*[F.lit(n) for n in FRAMEWORK_NAMES]), pick.cast("int")).alias("framework"))
    matrix = spark.createDataFrame(FRAMEWORK_MATRIX, "package_framework string, project_framework string")
    found = frameworks.product_table(frameworks.usable_frameworks(assets, matrix, "l_suppkey"), "l_suppkey")
    shown = F.array_join(F.transform("frameworks", lambda f: F.concat(f["framework"], F.when(f["is_computed"], "*").otherwise(""))), " ")
    return found.select("l_suppkey", "position", "product", shown.alias("frameworks"), "badge")


@_query("""
WITH e AS (SELECT l_orderkey, count(*)::INTEGER AS entries, min(l_linenumber) FILTER (l_returnflag = 'R') AS n FROM lineitem GROUP BY 1),
m AS (SELECT e.l_orderkey, entries, '{"fullName":"lib/' || min(l_linenumber) || '.NuSpec","length":' || min(l_partkey) || '}' AS entry
  FROM e LEFT JOIN lineitem l ON l.l_orderkey = e.l_orderkey AND l_linenumber = n AND l_returnflag = 'R' GROUP BY e.l_orderkey, entries)
SELECT o_custkey || '/1.' || o_orderkey || '.0' AS "Identity", CASE WHEN o_orderstatus = 'P' THEN 'PackageDelete' ELSE 'PackageDetails' END AS "Type",
 CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority <> '1-URGENT' END AS "IsListed",
 CASE WHEN o_orderstatus <> 'P' AND o_orderpriority = '5-LOW' THEN '{"reasons":["' || o_orderstatus || '"]}' END AS "Deprecation",
 CASE WHEN o_orderstatus <> 'P' THEN entries END AS "PackageEntryCount", CASE WHEN o_orderstatus <> 'P' THEN entry END AS "NuspecPackageEntry"
FROM orders LEFT JOIN m ON l_orderkey = o_orderkey""")
def leaf_items(spark, sf_dir):
    """Rows of the table of leaf items: orders as leaves, their lines as the entries of packages, returned ones as manifests."""
    name = F.concat(F.lit("lib/"), F.col("l_linenumber"), F.when(F.col("l_returnflag") == "R", ".NuSpec").otherwise(".txt"))
    lines = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", name.alias("fullName"), F.col("l_partkey").alias("length")))).alias("entries"))
    orders = _t(spark, sf_dir, "orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    at, key = F.col("o_orderdate").cast("timestamp"), F.col("o_orderkey").cast("string")
    leaves = orders.select(
        key.alias("commit_id"), at.alias("commit_timestamp"), F.col("o_custkey").cast("string").alias("id"), F.concat(F.lit("1."), key).alias("version"), (F.col("o_orderstatus") == "P").alias("deleted"),
        key.alias("url"), key.alias("page_url"), at.alias("published"), (F.col("o_orderpriority") != "1-URGENT").alias("listed"), at.alias("created"), at.alias("last_edited"), F.lit(1).cast("long").alias("package_size"),
        key.alias("package_hash"), key.alias("package_hash_algorithm"), F.when(F.col("o_orderpriority") == "5-LOW", F.struct(F.array("o_orderstatus").alias("reasons"), F.lit(None).cast("string").alias("message"))).alias("deprecation"),
        F.lit(None).cast("array<struct<severity:string>>").alias("vulnerabilities"), F.lit(None).cast("string").alias("repository"),
        F.transform("entries", lambda e: F.struct(e["length"].alias("length"), e["fullName"].alias("fullName"))).alias("package_entries"),
    )
    return drivers.leaf_items(leaves).select("Identity", "Type", "IsListed", "Deprecation", "PackageEntryCount", "NuspecPackageEntry")


@_query("""
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'Deleted' WHEN doc_id % 5 = 0 OR text IS NULL THEN 'None' WHEN source IS NULL THEN 'Legacy' ELSE 'Embedded' END AS kind,
 CASE WHEN doc_id % 7 <> 0 AND doc_id % 5 <> 0 THEN strlen(text)::INTEGER END AS size, CASE WHEN doc_id % 7 <> 0 AND doc_id % 5 <> 0 THEN to_base64(unhex(sha256(text))) END AS digest,
 CASE WHEN doc_id % 7 <> 0 AND doc_id % 5 <> 0 THEN text END AS content FROM documents""")
def readmes(spark, sf_dir):
    """Documents as the readmes of packages, some deleted, some without one."""
    docs = _t(spark, sf_dir, "documents").select("doc_id", "text", "source")
    leaves = docs.select(F.col("doc_id").alias("identity"), (F.col("doc_id") % 7 == 0).alias("deleted"))
    kind = F.when((F.col("doc_id") % 5 == 0) | F.col("text").isNull(), "None").when(F.col("source").isNull(), "Legacy").otherwise("Embedded")
    stored = docs.select(F.col("doc_id").alias("identity"), kind.alias("readme_type"), F.col("text").cast("binary").alias("data"), F.lit(None).cast("timestamp").alias("last_modified"))
    return drivers.package_readmes(leaves, stored).select(F.col("identity").alias("doc_id"), F.col("ResultType").alias("kind"), F.col("Size").alias("size"), F.col("SHA256").alias("digest"), F.col("Content").alias("content"))


@_query(ORACLES["latest_event_per_key"])
def keyed_state_stream(spark, sf_dir):
    """The latest event of each key, read back from the state store of a stream over the event files."""
    schema = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]")
    checkpoint = f"{shared_dir(spark)}/cp"
    keyed_state.latest_state_stream(stream, checkpoint, ["user_id", "event_type"], ["ts", "event_id"]).awaitTermination()
    return keyed_state.latest_state(spark, checkpoint).select("user_id", "event_type", "event_id", "value")


@_query("""
SELECT event_id, upper(event_type[1]) || event_type[2:] AS id FROM events WHERE event_type <> 'error'""")
def spelled_ids(spark, sf_dir):
    """Events with their types as the known ones are spelled; unknown ones drop out."""
    log = _t(spark, sf_dir, "events").select("event_id", F.upper("event_type").alias("id"))
    known = _t(spark, sf_dir, "events").where("event_type <> 'error'").select(F.initcap("event_type").alias("id")).distinct()
    return universe.cased(log, known, "id")


@_query("""
WITH s AS (SELECT event_type, user_id, max(event_id) % 3 = 0 AS gone FROM events WHERE hour(ts) < 12 GROUP BY 1, 2),
n AS (SELECT event_type, user_id, max(event_id) % 3 = 0 AS gone FROM events WHERE hour(ts) >= 12 GROUP BY 1, 2)
SELECT CASE WHEN event_type IN (SELECT event_type FROM n) THEN event_type ELSE upper(event_type) END AS id, user_id, coalesce(n.gone, s.gone) AS is_deleted
FROM s FULL JOIN n USING (event_type, user_id)""")
def version_set_merge(spark, sf_dir):
    """The version set of the events before noon merged with that of the later ones, which spell ids otherwise."""
    log = _t(spark, sf_dir, "events").select("event_id", F.hour("ts").alias("hour"), "event_type", F.col("user_id").cast("string").alias("version"))
    of = lambda rows, id_: events.version_set(rows.withColumn("id", id_), "id", "version", F.col("event_id") % 3 == 0, ["event_id"])
    stored, new = of(log.where("hour < 12"), F.upper("event_type")), of(log.where("hour >= 12"), F.col("event_type"))
    return events.merged_version_set(stored, new, 1, 2).select("id", F.col("version").cast("long").alias("user_id"), "is_deleted")


@_query(r"""
WITH p AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS path FROM pages),
e AS (SELECT page_id, lower(path) AS path, length(regexp_extract(path, '(\.[^.]*)$', 1)) <= 1 OR regexp_extract(path, '([^/\\]*)$', 1) NOT LIKE '%.%' AS bare FROM p)
SELECT page_id, CASE WHEN path LIKE '%1.html' THEN '1.HTML' WHEN path LIKE '%.html' THEN '.html' WHEN bare THEN '' WHEN path LIKE '%.com' THEN '.com' END AS extension,
 CASE WHEN path LIKE '%1.html' THEN 0 WHEN path LIKE '%.html' THEN 1 WHEN bare THEN 2 WHEN path LIKE '%.com' THEN 3 END::INTEGER AS "order" FROM e""")
def page_extensions(spark, sf_dir):
    """The first of some endings that the path of each page has."""
    pages = _t(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("path"))
    return pages.select("page_id", scalars.configured_extension(F.col("path"), ["1.HTML", ".html", "", ".com"]).alias("e")).select("page_id", "e.extension", "e.order")


@_query("""
WITH d AS (SELECT doc_id, text, CASE WHEN n_chars < 200 THEN 'LICENSE' END AS file, upper(lang) || ' OR MIT' AS expression, source AS url FROM documents)
SELECT doc_id, CASE WHEN file IS NOT NULL THEN 'File' WHEN expression IS NOT NULL THEN 'Expression' WHEN coalesce(url, '') <> '' THEN 'Url' ELSE 'None' END AS kind,
 CASE WHEN file IS NOT NULL THEN 'file' ELSE 'license/' || replace(expression, ' ', '%20') END AS generated,
 '["' || array_to_string(list_sort(list_distinct([replace(expression, ' OR MIT', ''), 'MIT'])), '","') || CASE WHEN expression IS NULL THEN NULL ELSE '"]' END AS licenses,
 CASE WHEN file IS NOT NULL THEN strlen(text) END AS length FROM d""")
def licenses(spark, sf_dir):
    """Documents as packages with license files, expressions that their languages name, and URLs."""
    file = F.when(F.col("n_chars") < 200, "LICENSE")
    docs = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("identity"), F.lit(False).alias("deleted"), file.alias("license_file"), F.concat(F.upper("lang"), F.lit(" OR MIT")).alias("license_expression"), F.col("source").alias("license_url"), "text")
    named = docs.select("license_expression").where("license_expression is not null").distinct().withColumn("id", F.col("license_expression"))
    parsed = archives.license_rows(named, "id", "license_expression").withColumnRenamed("id", "expression")
    files = docs.where("license_file is not null").select("identity", F.col("text").cast("binary").alias("data"))
    out = drivers.package_licenses(docs, parsed, files, "license/", "file")
    return out.select(F.col("identity").alias("doc_id"), F.col("ResultType").alias("kind"), F.col("GeneratedUrl").alias("generated"), F.col("ExpressionLicenses").alias("licenses"), F.col("FileLength").alias("length"))
