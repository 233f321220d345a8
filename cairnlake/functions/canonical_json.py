"""Canonical JSON as one Column expression, built by walking the type of the column.

Equal values give equal texts: names are sorted by code point at every depth, keys of maps likewise, fields that are null are left
out, and order otherwise comes from arrays alone. No Python worker takes part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters below 127 that are written as a code, those with an escape of their own, and the range of plain exponents.
CODED = "\"&'+<>`"
SHORT = {"0008": r"\b", "0009": r"\t", "000A": r"\n", "000C": r"\f", "000D": r"\r", "005C": r"\\"}
LEAST_EXPONENT, NO_EXPONENT_BELOW = -4, 15

_SAFE = "".join(rf"\x{c:02x}" for c in range(0x20, 0x7F) if chr(c) not in CODED + "\\")


def _units(run: Column) -> Column:
    """A run of unsafe characters, each UTF-16 unit by itself."""
    units = F.regexp_extract_all(F.hex(F.encode(run, "UTF-16BE")), F.lit("(.{4})"), F.lit(1))

    def one(u: Column) -> Column:
        out = F.concat(F.lit(r"\u"), u)
        for code, text in SHORT.items():
            out = F.when(u == code, F.lit(text)).otherwise(out)
        return out

    return F.array_join(F.transform(units, one), "")


def json_text(text: Column) -> Column:
    """A JSON string: quotes, markup, plus signs, controls and all beyond ASCII are codes of UTF-16 units, upper case.
    Safe texts, which most are, pass unsplit; others are cut into safe and unsafe runs."""
    runs = F.regexp_extract_all(text, F.lit(f"([{_SAFE}]+|[^{_SAFE}]+)"), F.lit(1))
    escaped = F.array_join(F.transform(runs, lambda r: F.when(F.regexp_like(r, F.lit(f"^[{_SAFE}]")), r).otherwise(_units(r))), "")
    return F.concat(F.lit('"'), F.when(F.regexp_like(text, F.lit(f"[^{_SAFE}]")), escaped).otherwise(text), F.lit('"'))


def json_double(number: Column) -> Column:
    """The shortest digits; from 1E+15 on and below 0.0001 with an exponent of two digits or more. NaN and infinities are errors."""
    text = number.cast("string")
    mantissa = F.regexp_replace(F.regexp_extract(text, r"^(-?[0-9.]+)", 1), r"\.0$", "")
    exponent = F.coalesce(F.nullif(F.regexp_extract(text, r"E(-?\d+)$", 1), F.lit("")).cast("int"), F.lit(0))
    digits = F.abs(exponent).cast("string")
    far = F.concat(mantissa, F.when(exponent < 0, "E-").otherwise("E+"), F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits))
    plain = F.regexp_replace(F.regexp_replace(text.try_cast("decimal(38,22)").cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    near = (exponent == 0) | exponent.between(LEAST_EXPONENT, NO_EXPONENT_BELOW - 1)
    finite = F.when(exponent == 0, mantissa).when(near, plain).otherwise(far)
    bad = F.isnan(number) | (F.abs(number) == float("inf"))
    return F.when(bad, F.raise_error(F.concat(F.lit("no JSON for the number "), text)).cast("string")).otherwise(finite)


def _moment(at: Column, pattern_zone: str) -> Column:
    fraction = F.regexp_replace(F.date_format(at, ".SSSSSS"), r"\.?0+$", "")
    return F.concat(F.lit('"'), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit(pattern_zone + '"'))


def canonical_json(value: Column, kind: T.DataType) -> Column:
    """The canonical JSON of a column of the given type; null where the column is null.

    Null fields are left out, null items of arrays and null values of maps are `null`. Fields of one name are an error, as are
    maps whose keys are no texts, binary data and other types that JSON has no form for."""
    if isinstance(kind, T.StructType):
        if len(set(kind.names)) < len(kind.names):
            raise ValueError("fields of one name in a struct")
        named = [F.concat(json_text(F.lit(f.name)), F.lit(":"), canonical_json(value.getField(f.name), f.dataType)) for f in sorted(kind, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *named), F.lit("}")))
    if isinstance(kind, T.ArrayType):
        items = F.transform(value, lambda x: F.coalesce(canonical_json(x, kind.elementType), F.lit("null")))
        return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise TypeError(f"keys of {kind.simpleString()} have no order as texts")
        pairs = F.transform(F.array_sort(F.map_keys(value)), lambda k: F.concat(json_text(k), F.lit(":"), F.coalesce(canonical_json(value[k], kind.valueType), F.lit("null"))))
        return F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    if isinstance(kind, T.StringType):
        return json_text(value)
    if isinstance(kind, T.BooleanType | T.ByteType | T.ShortType | T.IntegerType | T.LongType | T.DecimalType):
        return value.cast("string")
    if isinstance(kind, T.FloatType | T.DoubleType):
        return json_double(value)
    if isinstance(kind, T.TimestampType):
        return _moment(F.to_utc_timestamp(value, F.current_timezone()), "+00:00")
    if isinstance(kind, T.TimestampNTZType):
        return _moment(value, "")
    if isinstance(kind, T.DateType):
        return F.concat(F.lit('"'), F.date_format(value, "yyyy-MM-dd"), F.lit('"'))
    raise TypeError(f"no canonical JSON for {kind.simpleString()}")
