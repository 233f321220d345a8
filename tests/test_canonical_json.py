import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake.functions.canonical_json import canonical_json, json_double

U = "\\u"


def _of(spark, ddl, value):
    df = spark.createDataFrame([(value,)], f"v {ddl}")
    return df.select(canonical_json(F.col("v"), df.schema["v"].dataType).alias("j")).first()["j"]


def test_names_at_every_depth_are_sorted_and_nulls_left_out(spark):
    ddl = "struct<b:int,a:struct<z:string,Y:array<struct<d:int,c:string>>>,m:map<string,int>,n:string>"
    value = {"b": 1, "a": {"z": "q", "Y": [{"d": 2, "c": None}, None]}, "m": {"b": None, "a": 3, "B": 4}, "n": None}
    assert _of(spark, ddl, value) == '{"a":{"Y":[{"d":2},null],"z":"q"},"b":1,"m":{"B":4,"a":3,"b":null}}'
    assert _of(spark, ddl, None) is None
    assert _of(spark, "struct<a:int>", {"a": None}) == "{}"
    assert _of(spark, "array<string>", []) == "[]"
    assert _of(spark, "map<string,int>", {}) == "{}"


@pytest.mark.parametrize(
    "text, want",
    [("plain text/1", '"plain text/1"'), ("", '""'), ('a"b', f'"a{U}0022b"'), ("\\\n\t\r\b\f", r'"\\\n\t\r\b\f"'),
     ("<a&'+`>", f'"{U}003Ca{U}0026{U}0027{U}002B{U}0060{U}003E"'), ("\x00\x1f\x7f", f'"{U}0000{U}001F{U}007F"'),
     (chr(0xE9) + " " + chr(0x1F600) + "z", f'"{U}00E9 {U}D83D{U}DE00z"'), ("\r\n" * 2000 + "x", '"' + r"\r\n" * 2000 + 'x"')],
)
def test_texts(spark, text, want):
    got = _of(spark, "string", text)
    assert got == want
    assert json.loads(got) == text


def test_every_basic_code_point_comes_back(spark):
    texts = [chr(c) + "a" + chr(c) for c in [*range(0xD800), *range(0xE000, 0x10000), 0x10000, 0x10FFFF]]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    rows = df.select("v", canonical_json(F.col("v"), T.StringType()).alias("j")).collect()
    assert all(json.loads(r["j"]) == r["v"] and r["j"].isascii() for r in rows)


def test_numbers(spark):
    want = {-0.0: "-0", 69.0: "69", 6.55: "6.55", 1e7: "10000000", 123456789012345.6: "123456789012345.6", 1e15: "1E+15", -2.5e20: "-2.5E+20", 1e-4: "0.0001", 1.5e-5: "1.5E-05", 1e300: "1E+300", 0.00012345678901234567: "0.00012345678901234567", 3.0000000000000004: "3.0000000000000004"}
    rows = spark.createDataFrame([(k,) for k in want], "v double").select("v", json_double(F.col("v")).alias("j")).collect()
    assert [r["j"] for r in rows] == list(want.values())
    assert all(float(r["j"]) == r["v"] for r in rows)
    with pytest.raises(Exception, match="no JSON for the number"):
        spark.createDataFrame([(float("nan"),)], "v double").select(json_double(F.col("v"))).collect()


def test_moments_and_scalars(spark):
    utc = datetime.UTC
    assert _of(spark, "timestamp", datetime.datetime(2024, 1, 5, 1, 2, 3, 120000, utc)) == '"2024-01-05T01:02:03.12+00:00"'
    assert _of(spark, "timestamp_ntz", datetime.datetime(2024, 1, 5)) == '"2024-01-05T00:00:00"'
    assert _of(spark, "date", datetime.date(2024, 1, 5)) == '"2024-01-05"'
    assert _of(spark, "boolean", True) == "true"
    assert _of(spark, "bigint", -5) == "-5"


def test_types_without_a_form(spark):
    for ddl in ("map<int,string>", "binary", "struct<a:binary>"):
        kind = spark.createDataFrame([], f"v {ddl}").schema["v"].dataType
        with pytest.raises(TypeError):
            canonical_json(F.col("v"), kind)
    with pytest.raises(ValueError):
        canonical_json(F.col("v"), T.StructType([T.StructField("a", T.IntegerType()), T.StructField("a", T.IntegerType())]))
