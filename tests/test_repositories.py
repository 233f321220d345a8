from pyspark.sql import functions as F

from cairnlake.operators.repositories import source_repo, source_repositories

CASES = {
    "https://raw.githubusercontent.com/Own/Rep/abc/src/a.cs": ("GitHub", None, "Own", "Rep", "abc"),
    "https://RAW.githubusercontent.com/o/r/main/": ("GitHub", None, "o", "r", "main"),
    "https://raw.githubusercontent.com/o/r/main": ("Invalid", None, None, None, None),
    "https://raw.githubusercontent.com/o/r?x=/a/b/c/": ("Invalid", None, None, None, None),
    "http://me@Example.org:8080/a/b/c/d": ("Unknown", "example.org", None, None, None),
    "https://example.org": ("Unknown", "example.org", None, None, None),
    "a/b/c": ("Invalid", None, None, None, None),
    "": ("Invalid", None, None, None, None),
    None: ("Invalid", None, None, None, None),
}


def test_kinds_of_urls(spark):
    rows = spark.createDataFrame([(u,) for u in CASES], "url string").select("url", source_repo(F.col("url")).alias("r")).collect()
    assert {r["url"]: tuple(r["r"]) for r in rows} == CASES


def test_counts_by_key(spark):
    raw = "https://raw.githubusercontent.com/o/r/1/"
    rows = [("p", raw + "b"), ("p", raw + "a"), ("p", raw + "a"), ("p", "https://x.org/1"), ("q", raw + "c"), ("q", None)]
    found = source_repositories(spark.createDataFrame(rows, "p string, url string"), ["p"], "url").collect()
    assert {(r["p"], r["kind"], r["repo"], r["n_files"], r["example"]) for r in found} == {
        ("p", "GitHub", "r", 3, raw + "a"), ("p", "Unknown", None, 1, "https://x.org/1"), ("q", "GitHub", "r", 1, raw + "c"), ("q", "Invalid", None, 1, None)}
