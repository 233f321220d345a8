import pytest
from pyspark.sql import functions as F

from cairnlake.functions import scalars
from cairnlake.operators import events, universe
from cairnlake.plans import drivers
from cairnlake.streaming.incremental import Cursors, run_all


def test_extensions(spark):
    order = [".md", "", ".targets", ".s.md"]
    cases = {"a/B.MD": (".md", 0), "LICENSE": ("", 1), "a.b/LICENSE": ("", 1), "x.": ("", 1), "x.Targets": (".targets", 2), "x.s.md": (".md", 0), "x.cs": None, "": ("", 1), None: None}
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    rows = df.select("p", scalars.configured_extension(F.col("p"), order).alias("e"), scalars.has_extension(F.col("p"), [".md", ".dll"]).alias("h")).collect()
    assert {r["p"]: r["e"] and tuple(r["e"]) for r in rows} == cases
    assert {r["p"] for r in rows if r["h"]} == {"a/B.MD", "x.s.md"}


def test_spelling_of_ids(spark):
    known = spark.createDataFrame([("Foo.Bar",), ("foo.bar",), ("Baz",), (None,)], "id string")
    facts = spark.createDataFrame([("FOO.bar", "x"), ("foo.bar", "x"), ("baz", None), ("none", "y"), (None, "z")], "id string, owner string")
    assert sorted(map(tuple, universe.cased(facts, known, "id").collect()), key=str) == [("Baz", None), ("Foo.Bar", "x"), ("Foo.Bar", "x")]


def test_version_set_with_a_later_one(spark):
    ddl = "lower_id string, id string, lower_version string, version string, is_deleted boolean"
    stored = spark.createDataFrame([("a", "A", "1.0-b", "1.0-B", False), ("a", "A", "2.0", "2.0", False), ("b", "B", "1.0", "1.0", True)], ddl)
    new = spark.createDataFrame([("a", "a", "1.0-b", "1.0-b", True), ("c", "C", "1.0", "1.0", False)], ddl)
    rows = lambda df: sorted(map(tuple, df.collect()))
    merged = events.merged_version_set(stored, new, 5, 5)
    assert rows(merged) == [("a", "a", "1.0-b", "1.0-b", True), ("a", "a", "2.0", "2.0", False), ("b", "B", "1.0", "1.0", True), ("c", "C", "1.0", "1.0", False)]
    assert rows(events.merged_version_set(stored, new, 5, 4)) == rows(stored)
    assert rows(events.merged_version_set(stored.limit(0), new, None, 4)) == rows(new)
    assert rows(events.merged_version_set(merged, new, 5, 6)) == rows(merged)


def test_licenses(spark):
    leaves = spark.createDataFrame(
        [("a", False, "LICENSE.txt", "MIT", "u"), ("b", False, " ", "MIT OR X", "u"), ("c", False, None, "", "u"), ("d", False, None, None, ""), ("e", True, "f", "MIT", "u"), ("f", False, "", "((", None)],
        "identity string, deleted boolean, license_file string, license_expression string, license_url string",
    )
    parsed = spark.createDataFrame([("MIT", ["MIT"], [], True), ("MIT OR X", ["MIT", "X"], [], True), ("((", None, None, False)], "expression string, licenses array<string>, exceptions array<string>, is_valid boolean")
    files = spark.createDataFrame([("a", b"\xef\xbb\xbfhi"), ("e", b"gone")], "identity string, data binary")
    got = {r["identity"]: r for r in drivers.package_licenses(leaves, parsed, files, "l/", "d").collect()}
    assert {k: (r["ResultType"], r["GeneratedUrl"], r["ExpressionLicenses"], r["FileContent"], r["FileLength"]) for k, r in got.items()} == {
        "a": ("File", "d", '["MIT"]', "hi", 5), "b": ("Expression", "d", '["MIT","X"]', None, None), "c": ("Url", None, None, None, None), "d": ("None", None, None, None, None),
        "e": ("Deleted", None, None, None, None), "f": ("Expression", None, None, None, None)}
    assert (got["a"]["ExpressionExceptions"], got["e"]["Url"], got["c"]["Url"]) == ("[]", None, "u")


def test_titles():
    assert [drivers.title(n) for n in ("LoadPackageReadme", "PackageFileToCsv", "X")] == ["Load package readme", "Package file to CSV", "X"]


def test_dependents_run_after_what_they_need(spark, tmp_path):
    log = spark.createDataFrame([(i,) for i in range(1, 6)], "at long")
    seen, cursors = {}, Cursors(spark, str(tmp_path / "cursors"))
    deps = {"a": [], "b": ["a"], "c": ["b", "a"], "other": []}

    def step(name, fails=False):
        def run(df):
            if fails:
                raise RuntimeError(name)
            seen.setdefault(name, []).extend(r["at"] for r in df.orderBy("at").collect())

        return run

    with pytest.raises(RuntimeError):
        run_all(cursors, deps, ["c"], log, "at", {n: step(n, n == "b") for n in deps})
    assert seen == {"a": [1, 2, 3, 4, 5]}
    assert run_all(cursors, deps, ["c"], log, "at", {n: step(n) for n in deps}) == {"a": "FullyCaughtUpWithDependency", "b": "NewStarted", "c": "NewStarted"}
    assert seen == {n: [1, 2, 3, 4, 5] for n in "abc"}
