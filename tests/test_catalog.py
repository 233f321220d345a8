import datetime
import gzip
import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from cairnlake.functions import scalars
from cairnlake.operators import checks, edges, events, merge, ranks, reprocess, universe
from cairnlake.plans import drivers
from cairnlake.plans.registry import TABLES, TableSpec, history_of
from cairnlake.sources import archives, catalog_log, csv_tables, snapshots
from cairnlake.streaming import incremental


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_bucket_of_the_documented_key(spark):
    assert one(spark, scalars.bucket(F.lit("newtonsoft.json"), 1000)) == 892


def test_version_order(spark):
    ordered = ["1.0.0-alpha", "1.0.0-alpha.1", "1.0.0-alpha.beta", "1.0.0-beta", "1.0.0-beta.2", "1.0.0-beta.11", "1.0.0-rc.1", "1.0.0", "1.0.0.1", "1.0.1-A.99999999999999999999", "1.2", "10.0"]
    df = spark.createDataFrame([(v,) for v in reversed(ordered)], "v string")
    assert [r["v"] for r in df.orderBy(scalars.version_key(F.col("v"))).collect()] == ordered
    assert one(spark, scalars.version_key(F.lit("foo"))) is None
    assert one(spark, scalars.normalized_version(F.lit("01.2.0.0-Beta.1+meta"))) == "1.2.0-Beta.1"
    assert one(spark, scalars.normalized_version(F.lit("1.2.3.4"))) == "1.2.3.4"


def test_semver_flags(spark):
    assert one(spark, scalars.semver_flags(F.lit("1.0.0-a.b+c"))) == 3
    assert one(spark, scalars.semver_flags(F.lit("1.0.0-a"))) == 0
    assert one(spark, scalars.range_flags(F.lit("[1.0.0-a.b, 2.0.0+x)"))) == scalars.SEMVER_MIN_PRERELEASE_DOTS | scalars.SEMVER_MAX_BUILD
    assert one(spark, scalars.range_flags(F.lit("oops ["))) == scalars.SEMVER_ALL
    assert one(spark, scalars.range_flags(F.lit(None).cast("string"))) == 0


def test_ticks_keep_seven_digits(spark):
    a, b = (one(spark, scalars.ticks(F.lit(t))) for t in ("2015-02-01T06:22:45.8546849Z", "2015-02-01T06:22:45.8546841Z"))
    assert a - b == 8
    for text in ("2015-02-01T06:22:45.8546849Z", "2015-02-01T06:22:45.85Z", "2015-02-01T06:22:45Z"):
        assert one(spark, scalars.ticks_text(scalars.ticks(F.lit(text)))) == text


def test_paths_tags_and_listing(spark):
    p = F.lit("lib/net45/A.B.dll")
    assert (one(spark, scalars.file_name(p)), one(spark, scalars.file_extension(p)), one(spark, scalars.top_folder(p))) == ("A.B.dll", ".dll", "lib")
    assert one(spark, scalars.file_extension(F.lit("a.b/c"))) is None and one(spark, scalars.top_folder(F.lit("c"))) is None
    assert one(spark, scalars.unescaped_path(F.lit("/a%20b+c"))) == "a b+c"
    assert one(spark, scalars.split_tags(F.lit(" a,b; c|\td "))) == ["a", "b", "c", "d"]
    assert one(spark, scalars.split_tags(F.lit(" \t"))) == []
    old = F.lit("1900-01-01").cast("timestamp")
    none = F.lit(None).cast("boolean")
    assert [one(spark, scalars.is_listed(*x)) for x in ((none, old), (F.lit(True), old), (none, F.lit(None).cast("timestamp")))] == [False, True, False]
    assert one(spark, scalars.image_format(F.lit(b"GIF89a...").cast("binary"))) == "Gif89"
    assert one(spark, scalars.image_format(F.lit(b"<?xml?><svg>").cast("binary"))) == "Svg"
    assert one(spark, scalars.advisory_key(F.lit("https://x/#vulnerability/GitHub/123"))) == 123
    assert one(spark, scalars.join_flags(F.lit(5), ["None", "A", "B", "C"])) == "A, C"


def test_bucket_ranges():
    assert scalars.bucket_ranges("1-3, 7") == [1, 2, 3, 7] and scalars.ranges_text([7, 2, 1, 3, 3]) == "1-3,7"
    with pytest.raises(ValueError):
        scalars.bucket_ranges("3-1")


def test_half_open_bounds_and_pages(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "at int")
    assert [r[0] for r in df.where(events.in_bounds(F.col("at"), 2, 5)).collect()] == [3, 4, 5]
    assert sorted(r[0] for r in events.prune_pages(df, "at", 2, 5).collect()) == [3, 4, 5, 6]


def test_version_set_keeps_last_casing_and_deleted(spark):
    log = spark.createDataFrame([("Foo", "1.0", False, 1), ("foo", "2.0", False, 2), ("FOO", "1.0", True, 3)], "id string, version string, deleted boolean, ts long")
    got = {r["lower_version"]: (r["id"], r["is_deleted"]) for r in events.version_set(log, "id", "version", F.col("deleted"), ["ts"]).collect()}
    assert got == {"1.0": ("FOO", True), "2.0": ("FOO", False)}


def batch_rows(spark, rows):
    return spark.createDataFrame(rows, "id string, version string, commit long, scanned long, batch string, path string")


def test_newest_batch_keeps_whole_batches_in_two_steps(spark):
    old = batch_rows(spark, [("a", "1", 1, None, None, "x"), ("a", "1", 1, None, None, "y"), ("b", "1", 5, None, None, "z")])
    new = batch_rows(spark, [("a", "1", 1, 10, "s", "p"), ("a", "1", 1, 10, "s", "q"), ("a", "1", 1, 10, "s", "q"), ("b", "1", 4, 10, "s", "late")])
    prune = lambda df: merge.newest_batch(df, ["id", "version"], "commit", "scanned", "batch", final=True)
    got = merge.compact(old, new, prune, ["id", "version", "path"], ["id", "path"])
    assert sorted((r["id"], r["path"], r["scanned"]) for r in got.collect()) == [("a", "p", None), ("a", "q", None), ("b", "z", None)]
    again = merge.compact(got, batch_rows(spark, []), prune, ["id", "version", "path"], ["id"])
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))
    with pytest.raises(ValueError, match="share a key"):
        merge.compact(None, new, lambda df: df, ["id", "version"], ["id"])


def test_block_merge_and_fixed_columns(spark):
    rows = [("f", 1, "old", 10, "s1", 1, "t1", False, "C"), ("f", 2, "new", 5, "s2", 9, "t2", False, "C"), ("g", 1, "x", 1, "s", 1, "t", True, "C"), ("g", 2, "y", 1, "s", 1, "t", False, "C")]
    df = spark.createDataFrame(rows, "fp string, scanned int, status string, s_at int, signing string, t_at int, stamping string, gone boolean, subject string")
    got = merge.block_merge(df, "fp", ["scanned"], {"s_at": ["signing"], "t_at": ["stamping"]}, "gone", ["subject"]).collect()
    assert [(r["fp"], r["status"], r["signing"], r["stamping"]) for r in got] == [("f", "new", "s1", "t2")]
    with pytest.raises(Exception, match="columns that never change"):
        merge.block_merge(df.withColumn("subject", F.col("status")), "fp", ["scanned"], {}, None, ["subject"]).collect()


def test_upsert_keeps_stored_rows_on_ties(spark):
    a = spark.createDataFrame([("k", 5, "old")], "k string, at int, v string")
    b = spark.createDataFrame([("k", 5, "tie"), ("j", 1, "new")], "k string, at int, v string")
    assert {r["k"]: r["v"] for r in merge.upsert_latest(a, b, ["k"], "at").collect()} == {"k": "old", "j": "new"}


def test_runs_totals_and_sets(spark):
    df = spark.createDataFrame([(0, "a", "1", 5), (1, "a", "1", 7), (2, "a", "2", 1), (3, "b", "1", 2), (4, "a", "1", 4)], "pos int, id string, version string, n int")
    got = sorted((r["run"], r["id"], r["version"], r["n"], r["total"]) for r in universe.run_totals(df, "pos", "id", "version", "n").collect())
    assert got == [(1, "a", "1", 7, 8), (1, "a", "2", 1, 8), (2, "b", "1", 2, 2), (3, "a", "1", 4, 4)]
    names = spark.createDataFrame([("p", "Bob", 0), ("p", "alice", 1), ("p", "BOB", 2)], "id string, owner string, pos int")
    assert universe.sorted_set(names, "id", "owner", "pos").first()["values"] == ["alice", "Bob"]


def test_content_budget_against_a_loop(spark):
    import random

    rng = random.Random(1)
    rows = [(p, e, i, rng.randint(0, 60), rng.choice("abcdefgh")) for p in "xy" for i, e in enumerate(rng.choices([".a", ".b"], k=40))]
    df = spark.createDataFrame(rows, "pkg string, ext string, seq int, size int, sha string")
    got = {(r["pkg"], r["seq"]): (r["is_duplicate"], r["kept_size"]) for r in ranks.content_budget(df, ["pkg"], "ext", ["seq"], "size", "sha", 50, 100).collect()}
    for p in "xy":
        seen, left = set(), {".a": 100, ".b": 100}
        for _, e, i, size, sha in sorted((r for r in rows if r[0] == p), key=lambda r: r[2]):
            if sha in seen:
                assert got[p, i] == (True, 0)
                continue
            seen.add(sha)
            assert got[p, i] == (False, min(size, 50, left[e]))
            left[e] = max(0, left[e] - size)


def test_cut_text_keeps_whole_characters(spark):
    for n in range(8):
        cut = one(spark, ranks.cut_text(F.lit("aé漢😀"), F.lit(n)))
        assert cut == "aé漢😀".encode()[:n].decode(errors="ignore")


def test_checks(spark):
    a = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    b = spark.createDataFrame([(2,), (3,)], "k int")
    assert tuple(checks.compare_sets(a, b, "k").first()) == (1, 1, [1], [3])
    assert checks.compare_sets(a, a, "k").first()["left_only"] == 0
    assert [tuple(r) for r in checks.adjacent(a, "k", 3).collect()] == [("before", 1, 2)]
    assert checks.newer(a.limit(0), b, "k", F.lit(0)).first()["is_newer"] is False


def test_load_and_swap(spark):
    t = spark.createDataFrame([(1,)], "k int")
    assert checks.load_and_swap(spark, {"swap_me": t}, {"ok": lambda f: f["swap_me"].where("k <> 1")}) == {"ok": True}
    assert checks.load_and_swap(spark, {"swap_me": t.withColumn("k", F.lit(2))}, {"bad": lambda f: f["swap_me"].where("k = 2")}) == {"bad": False}
    assert spark.table("swap_me").first()[0] == 1


def test_edges(spark):
    df = lambda rows: spark.createDataFrame(rows, "owner string, subject string")
    old = df([("a", "1"), ("a", "2"), ("b", "2")])
    now = edges.replace_owner_edges(old, df([("a", "3")]), "owner")
    assert sorted(map(tuple, now.collect())) == [("a", "3"), ("b", "2")]
    removed = edges.edge_changes(old, now, ["owner", "subject"]).where("change = 'removed'")
    assert [r[0] for r in edges.orphans(removed, now, "subject").collect()] == ["1"]
    chain = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "c"), ("x", "gone")], "fingerprint string, issuer_fingerprint string")
    assert {r[0]: (r[1], r[2]) for r in edges.chain_roots(chain).collect()} == {"a": ("c", 2), "b": ("c", 1), "c": ("c", 0), "x": ("x", 0)}


def test_reprocess(spark):
    b = spark.createDataFrame([(0, None), (1, 5), (2, 50), (3, 1), (9, None)], "bucket int, last_processed int")
    assert [r[0] for r in reprocess.due_buckets(b, 10, 5).collect()] == [0, 3, 1]


def test_registry():
    assert len(TABLES) == 29 and len(TABLES["PackageManifests"].schema) == 41
    assert [f.name for f in TABLES["PackageDownloads"].schema][:3] == ["AsOfTimestamp", "LowerId", "Identity"]
    assert TABLES["Certificates"].merge == "certificate_blocks" and TABLES["PackageIcons"].merge == "newest_batch"
    assert history_of(TABLES["PackageDownloads"]).keys == ["Identity", "AsOfTimestamp"]
    for spec in TABLES.values():
        names = spec.schema.names
        assert set(spec.keys) <= set(names) and spec.bucket in names


def test_csv_round_trip_and_header_check(spark, tmp_path):
    spec = TableSpec("T", ["Id"], "Id", "", "Id string NOT NULL, N int, Flag boolean, At timestamp")
    rows = [("a,\"b\"\nc", 1, True, "2015-02-01T06:22:45.8546849Z"), ("", None, None, None), (" x ", 3, False, None)]
    df = spark.createDataFrame(rows, "Id string, N int, Flag boolean, At string")
    path = str(tmp_path / "t")
    csv_tables.write_csv(df, spec, path, 3)
    assert sorted(map(str, csv_tables.read_csv(spark, spec, path).collect())) == sorted(map(str, df.collect()))
    some = [r["b"] for r in df.select(scalars.bucket(F.col("Id"), 3).alias("b")).collect()][:1]
    assert 1 <= csv_tables.read_csv(spark, spec, path, some).count() <= 3
    other = TableSpec("T", ["Id"], "Id", "", "Other string, N int, Flag boolean, At timestamp")
    with pytest.raises(Exception):
        csv_tables.read_csv(spark, other, path).collect()


def test_snapshots(spark, tmp_path):
    def put(name, value):
        (tmp_path / name).write_text(value if isinstance(value, str) else json.dumps(value))
        return str(tmp_path / name)

    v1 = snapshots.downloads_v1(spark, put("v1", [["A", ["1.0.0", 138], ["foo", 13]], ["B"]])).collect()
    v2 = snapshots.downloads_v2(spark, put("v2", '{"A": {"1.0.0": 1, "2.0.0": 2}, "A": {"1.0.0": 3}}')).orderBy("pos").collect()
    assert [(r["id"], r["version"], r["downloads"]) for r in v1] == [("A", "1.0.0", 138), ("A", "foo", 13)]
    assert [(r["id"], r["downloads"]) for r in v2] == [("A", 1), ("A", 2), ("A", 3)]
    assert [(r["id"], r["owner"]) for r in snapshots.names_by_id(spark, put("o", {"A": ["x", "y"], "B": []})).collect()] == [("A", "x"), ("A", "y")]
    assert [r[0] for r in snapshots.ids(spark, put("i", ["A", "B"])).collect()] == ["A", "B"]
    usage = put("u", [{"Url": "https://h/o/r", "Stars": 3, "Id": "o/r", "Dependencies": ["A", "a"]}])
    assert [tuple(r) for r in snapshots.repository_usage(spark, usage).collect()] == [("o/r", 3, "A"), ("o/r", 3, "a")]
    now, hour = datetime.datetime(2024, 1, 2), datetime.timedelta(hours=1)
    assert snapshots.newest_of([("a", now - hour, 2 * hour), ("b", now - 3 * hour, hour)], now)[0] == "a"
    with pytest.raises(ValueError):
        snapshots.newest_of([("b", now - 3 * hour, hour)], now)


def test_catalog_log(spark, tmp_path):
    page = {"@id": "p", "commitTimeStamp": "2020-01-01T00:00:00.1234567Z", "count": 1, "items": [{"@id": "l", "@type": "x:PackageDelete", "commitId": "c", "commitTimeStamp": "2020-01-01T00:00:00.1234567Z", "v:id": "A", "v:version": "1.0"}]}
    (tmp_path / "page.json").write_text(json.dumps(page))
    row = catalog_log.page_leaves(spark, str(tmp_path / "page.json"), "v").first()
    assert (row["leaf_type"], row["package_id"], row["commit_ticks"] % 10**7) == ("PackageDelete", "A", 1234567)
    (tmp_path / "index.json").write_text(json.dumps({"commitTimeStamp": "x", "count": 1, "items": [{"@id": "p", "commitTimeStamp": "2020-01-01T00:00:00Z", "count": 5}]}))
    assert catalog_log.index_pages(spark, str(tmp_path / "index.json")).first()["count"] == 5


def test_archives(spark, tmp_path):
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("A.nuspec", '<package xmlns="u"><metadata minClientVersion="2.0"><id>A</id><version>1.0</version><license type="expression">MIT</license><dependencies><dependency id="B" version="[1,2)"/></dependencies></metadata></package>')
        z.writestr("lib/net45/A.dll", b"x" * 100)
    (tmp_path / "a.nupkg").write_bytes(data.getvalue())
    (tmp_path / "b.nupkg").write_bytes(b"not an archive")
    files = archives.package_files(spark, str(tmp_path))
    entries = archives.archive_entries(files).orderBy("sequence_number").collect()
    assert [(r["path"], r["file_extension"], r["top_level_folder"]) for r in entries] == [("A.nuspec", ".nuspec", None), ("lib/net45/A.dll", ".dll", "lib")]
    hashes = {r["path"]: r for r in archives.archive_hashes(files).collect()}
    assert hashes["lib/net45/A.dll"]["actual_length"] == 100 and hashes["lib/net45/A.dll"]["first_bytes"] == "eHh4eHh4eHh4eHh4eHh4eA=="
    m = archives.manifests(files).first()
    assert (m["id"], m["license"], m["license_type"], m["min_client_version"], m["dependencies"]) == ("A", "MIT", "expression", "2.0", "B [1,2)")


def test_license_expressions(spark):
    assert archives.license_leaves("(MIT OR Apache-2.0+) AND GPL-2.0 WITH Classpath-exception-2.0") == (["Apache-2.0", "GPL-2.0", "MIT"], ["Classpath-exception-2.0"])
    df = spark.createDataFrame([(1, "MIT AND"), (2, "MIT"), (3, None)], "id long, e string")
    assert {r["id"]: r["is_valid"] for r in archives.license_rows(df, "id", "e").collect()} == {1: False, 2: True, 3: False}


def test_cursors_and_runs(spark, tmp_path):
    cursors = incremental.Cursors(spark, str(tmp_path / "c"))
    log = spark.createDataFrame([(i,) for i in range(1, 11)], "at long")
    seen = []
    step = lambda df: seen.append(sorted(r[0] for r in df.collect()))
    run = lambda name, deps, **k: incremental.run_once(cursors, name, log, "at", deps, step, **k)
    assert run("load", [], given_max=4) == "NewStarted" and seen[-1] == [1, 2, 3, 4]
    assert run("load", [], given_max=4) == "FullyCaughtUpWithMax"
    assert run("table", ["load"]) == "NewStarted" and seen[-1] == [1, 2, 3, 4]
    assert run("table", ["load"]) == "FullyCaughtUpWithDependency"
    assert run("table", ["load"], given_max=9) == "BlockedByDependency"
    assert run("load", [], given_max=2) == "MinAfterMax"
    assert run("load", [], enabled=False) == "Disabled"
    assert run("load", []) == "NewStarted" and seen[-1] == [5, 6, 7, 8, 9, 10]
    cursors.advance("load", 1)
    assert cursors.get("load", 0) == 10


def test_driver_order():
    order = incremental.closure(drivers.DEPENDENCIES, ["PackageArchiveToCsv", "BuildVersionSet"])
    assert order == ["BuildVersionSet", "LoadPackageArchive", "PackageFileToCsv", "PackageArchiveToCsv"]
    with pytest.raises(ValueError):
        incremental.closure({"a": ["b"], "b": ["a"]}, ["a"])


def test_stream_equals_batch(spark, tmp_path):
    rows = [(i % 5, i, f"v{i}") for i in range(40)]
    src = tmp_path / "in"
    for k in range(4):
        spark.createDataFrame(rows[10 * k : 10 * k + 10], "k int, at int, v string").coalesce(1).write.mode("append").parquet(str(src))
    stream = spark.readStream.schema("k int, at int, v string").option("maxFilesPerTrigger", 1).parquet(str(src))
    q = incremental.merge_latest_stream(stream, str(tmp_path / "t"), str(tmp_path / "cp"), ["k"], "at")
    q.awaitTermination(120)
    versions = sorted((tmp_path / "t").iterdir(), key=lambda p: int(p.name.split("=")[1]))
    got = {tuple(r) for r in spark.read.parquet(str(versions[-1])).select("k", "at", "v").collect()}
    assert got == {tuple(r) for r in events.latest(spark.createDataFrame(rows, "k int, at int, v string"), ["k"], ["at"]).collect()} and len(versions) == 4


def test_drivers(spark):
    rows = [("A", "1.0.0", True, False, 0), ("a", "2.0.0-b", True, False, 0), ("A", "3.0.0-a.b", True, False, 1), ("A", "4.0.0", False, False, 0), ("A", "5.0.0", True, True, 0)]
    df = spark.createDataFrame(rows, "id string, version string, listed boolean, deleted boolean, flags int").withColumn("published", F.lit("2020-01-01").cast("timestamp"))
    got = {r["version"]: r for r in drivers.package_versions(df).collect()}
    assert [got[v]["SemVerOrder"] for v in ("1.0.0", "2.0.0-b", "3.0.0-a.b", "4.0.0", "5.0.0")] == [0, 1, 2, 3, 4]
    assert got["2.0.0-b"]["IsLatest"] and got["1.0.0"]["IsLatestStable"] and got["3.0.0-a.b"]["IsLatestSemVer2"] and got["1.0.0"]["IsLatestStableSemVer2"]
    assert not got["5.0.0"]["IsLatest"] and got["5.0.0"]["Identity"] == "a/5.0.0"
    assets = spark.createDataFrame([("p", "net45"), ("p", "odd")], "identity string, framework string")
    matrix = spark.createDataFrame([("net45", "net45"), ("net45", "net46")], "package_framework string, project_framework string")
    wide = drivers.compatible_frameworks(assets, matrix)
    assert {(r["framework"], r["is_computed"]) for r in wide.collect()} == {("net45", False), ("net46", True), ("odd", False)}
    products = spark.createDataFrame([("net45", "F", 1), ("net46", "F", 2)], "framework string, product string, sort_key int")
    assert [tuple(r) for r in drivers.framework_badges(wide, products).collect()] == [("p", "F", "net45")]
    status = lambda b, e, p: one(spark, drivers.chain_status(F.lit(b), F.lit(e), F.lit(p)))
    assert [status(True, 0, 0), status(False, 4, 0), status(False, 0x40, 0), status(False, 1, 0)] == ["Good", "Revoked", "Unknown", "Invalid"]
    leaf = "id string, version string, deleted boolean, deprecation struct<message:string,reasons:array<string>,alternatePackage:struct<id:string,range:string>>, vulnerabilities array<struct<`@id`:string,advisoryUrl:string,severity:string>>"
    leaves = spark.createDataFrame([("A", "1", False, None, [("u#vulnerability/GitHub/7", "adv", "2")]), ("B", "1", False, ("m", ["Legacy"], None), None), ("C", "1", True, None, None)], leaf)
    dep, vul = drivers.deprecations_and_vulnerabilities(leaves)
    assert [r["ResultType"] for r in dep.orderBy("Identity").collect()] == ["NotDeprecated", "Deprecated", "Deleted"]
    assert [(r["ResultType"], r["GitHubDatabaseKey"]) for r in vul.orderBy("Identity").collect()] == [("Vulnerable", 7), ("NotVulnerable", None), ("Deleted", None)]


def test_long_chains_and_circles(spark):
    from cairnlake.operators import edges

    chain = [(i, i + 1) for i in range(40)] + [(40, 40), (100, None)]
    got = {r["fingerprint"]: (r["root"], r["steps"]) for r in edges.chain_roots(spark.createDataFrame(chain, "fingerprint long, issuer_fingerprint long")).collect()}
    assert got == {i: (40, 40 - i) for i in range(41)} | {100: (100, 0)}
    with pytest.raises(ValueError):
        edges.chain_roots(spark.createDataFrame([(1, 2), (2, 1)], "fingerprint long, issuer_fingerprint long"))


def test_runs_never_skip_late_events(spark, tmp_path):
    from cairnlake.streaming.incremental import Cursors, run_once

    cursors, seen = Cursors(spark, str(tmp_path / "late")), []
    step = lambda df: seen.extend(r["at"] for r in df.collect())
    five, twenty = (spark.range(1, n).withColumnRenamed("id", "at") for n in (6, 21))
    assert run_once(cursors, "a", five, "at", [], step, given_max=100) == "BlockedByDependency"
    assert run_once(cursors, "a", five, "at", [], step) == "NewStarted"
    assert run_once(cursors, "a", twenty, "at", [], step, given_max=20) == "NewStarted" and seen == list(range(1, 21))
    assert run_once(cursors, "b", twenty, "at", ["c"], step) == "BlockedByDependency"
