from pyspark.sql import functions as F

from cairnlake.functions import frameworks as fw
from cairnlake.operators.frameworks import product_table, usable_frameworks

# Names that print back as they are, with family and version.
NAMES = {
    "monoandroid": ("MonoAndroid", "0.0.0.0"), "native": ("native", "0.0.0.0"), "net11": (".NETFramework", "1.1.0.0"), "net20": (".NETFramework", "2.0.0.0"),
    "net403": (".NETFramework", "4.0.3.0"), "net481": (".NETFramework", "4.8.1.0"), "net40-client": (".NETFramework", "4.0.0.0"), "net5.0": (".NETCoreApp", "5.0.0.0"),
    "net6.0-android": (".NETCoreApp", "6.0.0.0"), "net8.0-windows10.0.19041": (".NETCoreApp", "8.0.0.0"), "net10.0": (".NETCoreApp", "10.0.0.0"), "netcore": (".NETCore", "0.0.0.0"),
    "netcore451": (".NETCore", "4.5.1.0"), "netcoreapp3.1": (".NETCoreApp", "3.1.0.0"), "netmf": (".NETMicroFramework", "0.0.0.0"), "netstandard": (".NETStandard", "0.0.0.0"),
    "netstandard2.1": (".NETStandard", "2.1.0.0"), "sl5": ("Silverlight", "5.0.0.0"), "tizen40": ("Tizen", "4.0.0.0"), "uap10.0": ("UAP", "10.0.0.0"), "win81": ("Windows", "8.1.0.0"),
    "wp8": ("WindowsPhone", "8.0.0.0"), "wp75": ("WindowsPhone", "7.5.0.0"), "wpa81": ("WindowsPhoneApp", "8.1.0.0"), "xamarintvos": ("Xamarin.TVOS", "0.0.0.0"),
    "portable-net45+win8": (".NETPortable", "0.0.0.0"), "any": ("Any", "0.0.0.0"),
}


def test_names_parse_and_print_back(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "n string").withColumn("f", fw.framework(F.col("n")))
    rows = df.select("n", fw.framework_name(F.col("f")).alias("back"), "f.family", F.array_join(F.col("f.version").cast("array<string>"), ".").alias("version")).collect()
    assert {r["n"]: (r["back"], r["family"], r["version"]) for r in rows} == {n: (n, *v) for n, v in NAMES.items()}


def test_other_spellings_and_names_that_are_none(spark):
    cases = {"NET472": "net472", " net4 ": "net40", "net50": "net5.0", "netcoreapp5.0": "net5.0", "net6": "net6.0", "sl40": "sl4", "net6.0-Windows7.0": "net6.0-windows7.0", "netstandard20": "netstandard2.0",
             "": None, "foo1": None, "4.5": None, "net6.0-7": None, "net99999999999.0": None, None: None}
    rows = spark.createDataFrame([(n,) for n in cases], "n string").select("n", fw.framework_name(fw.framework(F.col("n"))).alias("back")).collect()
    assert {r["n"]: r["back"] for r in rows} == cases


def test_products(spark):
    cases = {"net5.0": ".NET", "netcoreapp3.1": ".NET Core", "netstandard1.0": ".NET Standard", "net45": ".NET Framework", "netmf": ".NET Micro Framework", "uap10.0": "Universal Windows Platform",
             "netcore50": "Universal Windows Platform", "netcore45": "Windows Store", "netcore": "Windows Store", "netcore46": ".NETCore", "win8": "Windows Store", "win10": "Windows", "wpa81": "Windows Phone", "tizen30": "Tizen"}
    rows = spark.createDataFrame([(n,) for n in cases], "n string").select("n", fw.product(fw.framework(F.col("n"))).alias("p")).collect()
    assert {r["n"]: r["p"] for r in rows} == cases


def test_product_table(spark):
    matrix = spark.createDataFrame([("netstandard2.0", p) for p in ("netstandard2.0", "netstandard2.1", "net461", "net6.0")] + [("net6.0", "net6.0"), ("net6.0", "net8.0"), ("net6.0-windows", "net6.0-windows"), ("net6.0-windows", "net8.0-windows")], "package_framework string, project_framework string")
    assets = spark.createDataFrame(
        [("a", n) for n in ("netstandard2.0", "NetStandard2.0", "net6.0", "any", "portable-net45+win8", "tizen40", "bad name", None)] + [("b", "net6.0-windows10.0.19041"), ("c", "any"), ("d", "uap10.0")], "identity string, framework string"
    )
    got = product_table(usable_frameworks(assets, matrix)).collect()
    shown = {(r["identity"], r["position"]): (r["product"], [f["framework"] + "*" * f["is_computed"] for f in r["frameworks"]], r["badge"]) for r in got}
    assert shown == {
        ("a", 0): (".NET", ["net6.0", "net8.0*"], "net6.0"),
        ("a", 1): (".NET Standard", ["netstandard2.0", "netstandard2.1*"], "netstandard2.0"),
        ("a", 2): (".NET Framework", ["net461*"], None),
        ("a", 3): ("Tizen", ["tizen40"], None),
        ("b", 0): (".NET", ["net6.0-windows10.0.19041", "net8.0-windows*"], "net6.0-windows10.0.19041"),
        ("d", 0): ("Universal Windows Platform", ["uap10.0"], None),
    }
    assert product_table(usable_frameworks(assets.limit(0), matrix)).count() == 0
