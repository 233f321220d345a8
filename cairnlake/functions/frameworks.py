"""Names of target frameworks as Column expressions: parsing, printing, order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Short names of frameworks and their families.
FAMILIES = {
    "any": "Any",
    "agnostic": "Agnostic",
    "dotnet": ".NETPlatform",
    "monoandroid": "MonoAndroid",
    "monomac": "MonoMac",
    "monotouch": "MonoTouch",
    "native": "native",
    "net": ".NETFramework",
    "netcore": ".NETCore",
    "netcoreapp": ".NETCoreApp",
    "netmf": ".NETMicroFramework",
    "netstandard": ".NETStandard",
    "netstandardapp": ".NETStandardApp",
    "portable": ".NETPortable",
    "sl": "Silverlight",
    "tizen": "Tizen",
    "uap": "UAP",
    "unsupported": "Unsupported",
    "win": "Windows",
    "wp": "WindowsPhone",
    "wpa": "WindowsPhoneApp",
    "xamarinios": "Xamarin.iOS",
    "xamarinmac": "Xamarin.Mac",
    "xamarintvos": "Xamarin.TVOS",
    "xamarinwatchos": "Xamarin.WatchOS",
}
# Families whose versions are written with dots, families with versions of one digit.
DOTTED = [".NETCoreApp", ".NETPlatform", ".NETStandard", ".NETStandardApp"]
ONE_DIGIT = ["Windows", "WindowsPhone", "Silverlight"]
# Names of products, the first four in the order of the product table.
NET, NET_CORE, NET_STANDARD, NET_FRAMEWORK = ".NET", ".NET Core", ".NET Standard", ".NET Framework"
MICRO, UNIVERSAL, PHONE, STORE = ".NET Micro Framework", "Universal Windows Platform", "Windows Phone", "Windows Store"

_NAME = r"^([a-z]+)(\d+(?:\.\d+){0,3})?(?:-(.+))?$"
_PLATFORM = r"^([a-z]+)(\d+(?:\.\d+){0,3})?$"
_FIELDS = ("family", "version", "profile", "platform", "platform_version")


def _numbers(text: Column) -> Column:
    """Four numbers of a version; without dots every digit counts as one, of which four are taken."""
    parts = F.when(F.contains(text, F.lit(".")), F.split(text, r"\.")).otherwise(F.regexp_extract_all(F.substring(text, 1, 4), F.lit(r"(\d)"), F.lit(1)))
    numbers = F.transform(F.coalesce(parts, F.array().cast("array<string>")), lambda x: x.try_cast("int"))
    return F.slice(F.concat(numbers, F.array_repeat(F.lit(0), 4)), 1, 4)


def _let(value: Column, body) -> Column:
    """body of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def framework(name: Column) -> Column:
    """A struct (family, version, profile, platform, platform_version) of a short name without regard to case; versions are arrays
    of four numbers, profile and platform empty where there is none. Null for a name that is no framework.

    `net` from version 5 on is the family of netcoreapp, and what follows its dash is a platform with a version of its own; behind
    other names it is a profile. The frameworks of a portable name are its profile."""
    lower = F.lower(F.trim(name))
    number = _numbers(F.nullif(F.regexp_extract(lower, _NAME, 2), F.lit("")))
    pieces = F.struct(F.regexp_extract(lower, _NAME, 1).alias("short"), number.alias("version"), F.regexp_extract(lower, _NAME, 3).alias("suffix"))
    families = F.create_map(*[F.lit(x) for pair in FAMILIES.items() for x in pair])

    def shaped(p: Column) -> Column:
        version, suffix, named = p["version"], p["suffix"], families[p["short"]]
        modern = p["short"].isin("net", "netcoreapp") & (version[0] >= 5)
        platform = modern & (suffix != "")
        good = named.isNotNull() & ~F.exists(version, lambda x: x.isNull()) & (~platform | F.regexp_like(suffix, F.lit(_PLATFORM)))
        parts = (
            F.when(modern, F.lit(".NETCoreApp")).otherwise(named),
            version,
            F.when(platform, F.lit("")).otherwise(suffix),
            F.when(platform, F.regexp_extract(suffix, _PLATFORM, 1)).otherwise(F.lit("")),
            _numbers(F.when(platform, F.nullif(F.regexp_extract(suffix, _PLATFORM, 2), F.lit("")))),
        )
        return F.when(F.coalesce(good, F.lit(False)), F.struct(*[x.alias(n) for x, n in zip(parts, _FIELDS, strict=True)]))

    return _let(pieces, shaped)


def _trimmed(version: Column, least: Column) -> Column:
    """The numbers of a version without zeros at the end, but at least so many."""
    last = F.array_max(F.transform(version, lambda x, i: F.when(x > 0, i + 1).otherwise(F.lit(0))))
    return F.slice(version, 1, F.greatest(last, least))


def framework_name(fw: Column) -> Column:
    """The short name of a parsed framework: numbers run together unless one has two digits or the family writes dots."""
    family, version, profile = fw["family"], fw["version"], fw["profile"]
    modern = (family == ".NETCoreApp") & (version[0] >= 5)
    short = F.when(modern, F.lit("net")).otherwise(F.create_map(*[F.lit(x) for s, f in FAMILIES.items() for x in (f, s)])[family])
    dots = family.isin(*DOTTED) | F.exists(version, lambda x: x > 9)
    least = F.when(family.isin(*ONE_DIGIT) & ~dots, F.lit(1)).otherwise(F.lit(2))
    is_set = lambda v: F.exists(v, lambda x: x > 0)
    joined = lambda v, n, sep: F.array_join(_trimmed(v, n).cast("array<string>"), sep)
    number = F.when(~is_set(version), F.lit("")).when(dots, joined(version, least, ".")).otherwise(joined(version, least, ""))
    at = fw["platform_version"]
    platform = F.concat(fw["platform"], F.when(is_set(at), joined(at, F.lit(2), ".")).otherwise(F.lit("")))
    return F.concat(short, number, F.when(fw["platform"] != "", F.concat(F.lit("-"), platform)).when(profile != "", F.concat(F.lit("-"), profile)).otherwise(F.lit("")))


def without_platform_version(fw: Column) -> Column:
    return fw.withField("platform_version", F.array_repeat(F.lit(0), 4))


def is_specific(fw: Column) -> Column:
    """Not unsupported, not portable and not any."""
    return ~fw["family"].isin("Unsupported", ".NETPortable", "Any")


def product(fw: Column) -> Column:
    """The product that a framework belongs to; families without one stand for themselves."""
    family, v = fw["family"], fw["version"]
    of = lambda *numbers: F.array(*[F.lit(n) for n in numbers])
    out = F.when(family == ".NETCoreApp", F.when(v[0] >= 5, NET).otherwise(NET_CORE)).when(family.isin(".NETStandard", ".NETStandardApp"), NET_STANDARD)
    out = out.when(family == ".NETFramework", NET_FRAMEWORK).when(family == ".NETMicroFramework", MICRO).when(family.isin("WindowsPhone", "WindowsPhoneApp"), PHONE)
    out = out.when((family == "UAP") | (family == ".NETCore") & (v == of(5, 0, 0, 0)), UNIVERSAL)
    empty, store, windows = of(0, 0, 0, 0), [of(4, 5, 0, 0), of(4, 5, 1, 0)], [of(8, 0, 0, 0), of(8, 1, 0, 0)]
    out = out.when((family == ".NETCore") & v.isin(empty, *store) | (family == "Windows") & v.isin(empty, *windows), STORE)
    return out.otherwise(family)
