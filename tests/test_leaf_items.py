import datetime

from cairnlake.plans import drivers
from cairnlake.plans.registry import TABLES

AT = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)
DDL = """commit_id string, commit_timestamp timestamp, id string, version string, deleted boolean, url string, page_url string, published timestamp, listed boolean,
 created timestamp, last_edited timestamp, package_size long, package_hash string, package_hash_algorithm string, deprecation struct<reasons:array<string>,message:string>,
 vulnerabilities array<struct<severity:string,advisoryUrl:string>>, repository string, package_entries array<struct<name:string,fullName:string,length:long>>"""


def _leaf(version, deleted=False, listed=None, deprecation=None, vulnerabilities=None, repository=None, entries=None):
    return ("c", AT, "Id", version, deleted, "u", "p", AT, listed, AT, AT, 7, "h", "SHA512", deprecation, vulnerabilities, repository, entries)


def test_leaf_items(spark):
    entries = [("x", "x/b.txt", 1), (None, None, None), ("B", "B.NUSPEC", 2), ("c", "c.nuspec", 3), ("s", "a/.signature.p7s", 4), ("t", ".signature.p7s", 5)]
    rows = [
        _leaf("1.0.0.0", deprecation=(["Legacy"], None), vulnerabilities=[("1", "https://a/?b=1&c")], repository="", entries=entries),
        _leaf("1.0.0.0", deprecation=(["Legacy"], None), vulnerabilities=[("1", "https://a/?b=1&c")], repository="", entries=entries),
        _leaf("2.0-Beta", listed=False, vulnerabilities=[], entries=[]), _leaf("3.0", deleted=True, repository="r", entries=entries), _leaf("odd"),
    ]
    out = drivers.leaf_items(spark.createDataFrame(rows, DDL))
    assert out.columns == [f.name for f in TABLES["CatalogLeafItems"].schema]
    got = {r["Version"]: r for r in out.collect()}
    assert out.count() == 4
    one, two, gone, odd = (got[v] for v in ("1.0.0.0", "2.0-Beta", "3.0", "odd"))
    assert (one["Identity"], one["Type"], one["IsListed"], one["HasRepositoryProperty"], one["PackageEntryCount"]) == ("id/1.0.0", "PackageDetails", True, True, 6)
    assert one["Deprecation"] == '{"reasons":["Legacy"]}'
    assert one["Vulnerabilities"] == '[{"advisoryUrl":"https://a/?b=1' + "\\" + 'u0026c","severity":"1"}]'
    assert one["NuspecPackageEntry"] == '{"fullName":"B.NUSPEC","length":2,"name":"B"}'
    assert one["SignaturePackageEntry"] == '{"fullName":".signature.p7s","length":5,"name":"t"}'
    assert (two["Identity"], two["IsListed"], two["Vulnerabilities"], two["Deprecation"], two["HasRepositoryProperty"], two["PackageEntryCount"], two["NuspecPackageEntry"]) == ("id/2.0.0-beta", False, "[]", None, False, 0, None)
    assert (gone["Type"], gone["Published"]) == ("PackageDelete", AT.replace(tzinfo=None))
    assert [gone[c] for c in out.columns[10:]] == [None] * 12
    assert (odd["Identity"], odd["PackageEntryCount"]) == ("id/odd", None)


def test_readmes(spark):
    leaves = spark.createDataFrame([("a", False), ("b", False), ("c", True), ("d", False), ("e", False), ("f", False), ("g", None)], "identity string, deleted boolean")
    bom = bytes([0xEF, 0xBB, 0xBF])
    stored = spark.createDataFrame(
        [("a", "Embedded", bom + b"hi", AT), ("b", "None", None, None), ("c", "Legacy", b"x", AT), ("d", "Legacy", b"a\xffb", None), ("f", "Embedded", b"", AT), ("zz", "Legacy", b"y", AT)],
        "identity string, readme_type string, data binary, last_modified timestamp",
    )
    got = {r["identity"]: tuple(r)[1:] for r in drivers.package_readmes(leaves, stored).collect()}
    assert {k: (v[0], v[1], v[4]) for k, v in got.items()} == {
        "a": ("Embedded", 5, "hi"), "b": ("None", None, None), "c": ("Deleted", None, None), "d": ("Legacy", 3, "a" + chr(0xFFFD) + "b"), "e": ("None", None, None), "f": ("Embedded", 0, ""), "g": ("None", None, None)}
    assert got["f"][3] == "47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU="
    assert got["a"][2] is not None and got["d"][2] is None
