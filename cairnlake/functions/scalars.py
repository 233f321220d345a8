"""Scalar functions of the catalog as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits of the SemVer 2.0.0 flags.
SEMVER_VERSION_PRERELEASE_DOTS, SEMVER_VERSION_BUILD = 1, 2
SEMVER_MIN_PRERELEASE_DOTS, SEMVER_MIN_BUILD, SEMVER_MAX_PRERELEASE_DOTS, SEMVER_MAX_BUILD = 4, 8, 16, 32
SEMVER_ALL = 63

_VERSION = r"^\s*(\d+)(?:\.(\d+))?(?:\.(\d+))?(?:\.(\d+))?(?:-([0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)*))?(?:\+([0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)*))?\s*$"


def lower_id(id_: Column) -> Column:
    return F.lower(id_)


def identity(id_: Column, version: Column) -> Column:
    """lower(id) / lower(version), the key of a package version."""
    return F.concat_ws("/", F.lower(id_), F.lower(version))


def identity_version(identity_: Column, lower: Column) -> Column:
    """The version part of an identity, by which rows of one id are sorted."""
    return F.substring(identity_, F.length(lower) + 2, F.length(identity_))


def bucket(key: Column, n: int) -> Column:
    """The first eight bytes of the SHA-256 of the key, little-endian and unsigned, modulo n."""
    digest = F.sha2(key, 256)
    swapped = F.concat(*[F.substring(digest, 15 - 2 * i, 2) for i in range(8)])
    return (F.conv(swapped, 16, 10).cast("decimal(20,0)") % n).cast("int")


def version_part(version: Column, part: str) -> Column:
    """major, minor, patch, revision (missing: 0), release or metadata (missing: null) of a version; null where it
    is not a version."""
    index = ["major", "minor", "patch", "revision", "release", "metadata"].index(part) + 1
    raw = F.regexp_extract(version, _VERSION, index)
    valid = version.rlike(_VERSION)
    if index <= 4:
        return F.when(valid, F.coalesce(F.nullif(raw, F.lit("")).cast("int"), F.lit(0)))
    return F.when(valid, F.nullif(raw, F.lit("")))


def normalized_version(version: Column) -> Column:
    """Three numbers, a fourth if it is not 0, and the release; metadata is left out."""
    parts = [version_part(version, p) for p in ("major", "minor", "patch", "revision")]
    numbers = F.concat_ws(".", *parts[:3], F.when(parts[3] > 0, parts[3]))
    release = version_part(version, "release")
    return F.when(parts[0].isNotNull(), F.concat(numbers, F.coalesce(F.concat(F.lit("-"), release), F.lit(""))))


def version_key(version: Column) -> Column:
    """A struct that sorts as versions do: numbers, then prereleases before releases, labels one by one, numeric
    ones by value and before others, others without regard to case. Null where it is not a version."""
    release = version_part(version, "release")
    labels = F.transform(
        F.split(release, r"\."),
        lambda x: F.struct((~x.rlike(r"^\d+$")).alias("text_last"), F.when(x.rlike(r"^\d{1,38}$"), x.cast("decimal(38,0)")).alias("number"), F.lower(x).alias("label")),
    )
    parts = [version_part(version, p).alias(p) for p in ("major", "minor", "patch", "revision")]
    return F.when(version_part(version, "major").isNotNull(), F.struct(*parts, release.isNull().alias("is_release"), F.coalesce(labels, F.array().cast("array<struct<text_last:boolean,number:decimal(38,0),label:string>>")).alias("labels")))


def semver_flags(version: Column, dots: int = SEMVER_VERSION_PRERELEASE_DOTS, build: int = SEMVER_VERSION_BUILD) -> Column:
    """The flags that a version sets: several release labels, or build metadata."""
    release = version_part(version, "release")
    several = F.when(F.coalesce(F.size(F.split(release, r"\.")) > 1, F.lit(False)), dots).otherwise(0)
    return several.bitwiseOR(F.when(version_part(version, "metadata").isNotNull(), build).otherwise(0))


def range_flags(range_: Column) -> Column:
    """The flags that the bounds of a dependency range set; all flags where it is not a range."""
    plain = r"^\s*[^\[\](),\s]+\s*$"
    bracket = r"^\s*[\[(]\s*([^\[\](),]*?)\s*(?:,\s*([^\[\](),]*?)\s*)?[\])]\s*$"
    low = F.when(range_.rlike(plain), F.trim(range_)).otherwise(F.regexp_extract(range_, bracket, 1))
    high = F.when(range_.rlike(plain), F.lit("")).otherwise(F.regexp_extract(range_, bracket, 2))
    ok = range_.rlike(plain) & range_.rlike(_VERSION) | range_.rlike(bracket) & ((low == "") | low.rlike(_VERSION)) & ((high == "") | high.rlike(_VERSION))
    flags = semver_flags(low, SEMVER_MIN_PRERELEASE_DOTS, SEMVER_MIN_BUILD).bitwiseOR(semver_flags(high, SEMVER_MAX_PRERELEASE_DOTS, SEMVER_MAX_BUILD))
    return F.when(range_.isNull() | (F.trim(range_) == ""), 0).when(ok, flags).otherwise(SEMVER_ALL)


def is_semver2(flags: Column) -> Column:
    return flags != 0


def is_listed(listed: Column, published: Column) -> Column:
    """The explicit flag, else whether the publishing year is not 1900; unknown counts as unlisted."""
    return F.coalesce(listed, F.year(published) != 1900, F.lit(False))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/\\]*)$", 1)


def file_extension(path: Column) -> Column:
    """From the last dot of the file name on; null without one."""
    return F.nullif(F.regexp_extract(file_name(path), r"(\.[^.]*)$", 1), F.lit(""))


def has_extension(path: Column, extensions: list[str]) -> Column:
    """Whether the extension is one of the given ones, without regard to case."""
    return F.coalesce(F.lower(file_extension(path)).isin(*[e.lower() for e in extensions]), F.lit(False))


def configured_extension(path: Column, extensions: list[str]) -> Column:
    """A struct (extension, order) of the first of the given endings that the path has, without regard to case; null if it has none.
    The empty ending stands for paths without an extension alone; a dot at the end is none."""
    bare = F.coalesce(F.length(file_extension(path)) <= 1, F.lit(True))
    out = F.when(F.lit(False), F.struct(F.lit("").alias("extension"), F.lit(0).alias("order")))
    for order, ending in enumerate(extensions):
        hit = bare if ending == "" else F.lower(path).endswith(ending.lower())
        out = out.when(path.isNotNull() & hit, F.struct(F.lit(ending).alias("extension"), F.lit(order).alias("order")))
    return out


def top_folder(path: Column) -> Column:
    """What stands before the first separator; null without one."""
    return F.when(path.rlike(r"[/\\]"), F.regexp_extract(path, r"^([^/\\]*)[/\\]", 1))


def unescaped_path(path: Column) -> Column:
    """Percent escapes decoded (a plus sign stays), without leading separators."""
    decoded = F.when(F.contains(path, F.lit("%")), F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)).otherwise(path)
    return F.regexp_replace(decoded, r"^[/\\]+", "")


def base64_digest(data: Column, bits: int = 256) -> Column:
    return F.base64(F.unhex(F.sha2(data, bits)))


def base64url(data: Column) -> Column:
    return F.rtrim(F.translate(F.base64(data), "+/", "-_"), F.lit("="))


def leading_bytes(data: Column, n: int = 16) -> Column:
    return F.base64(F.substring(data, 1, n))


def image_format(data: Column) -> Column:
    """The format that leading bytes show: Png, Jpeg, Ico, Gif89, Gif87, Svg or Unknown."""
    head = F.hex(F.substring(data, 1, 8192))
    out = F.when(head.startswith("89504E470D0A1A0A"), "Png").when(head.startswith("FFD8FF"), "Jpeg").when(head.startswith("00000100"), "Ico")
    out = out.when(head.startswith("474946383961"), "Gif89").when(head.startswith("474946383761"), "Gif87")
    return out.when(F.contains(F.decode(F.substring(data, 1, 8192), "ISO-8859-1"), F.lit("<svg")), "Svg").otherwise("Unknown")


def advisory_key(url: Column) -> Column:
    """The number at the end of an advisory's address; an error where there is none."""
    found = F.regexp_extract(url, r"#vulnerability/GitHub/(\d+)$", 1)
    return F.when(found == "", F.raise_error(F.concat(F.lit("no advisory key in "), url)).cast("int")).otherwise(found.cast("int"))


def split_tags(tags: Column) -> Column:
    parts = F.filter(F.split(F.coalesce(tags, F.lit("")), r"[, \t|;]"), lambda x: x != "")
    return F.when(F.trim(F.coalesce(tags, F.lit(""))) == "", F.array().cast("array<string>")).otherwise(parts)


def ticks(text: Column) -> Column:
    """Units of 100 ns since 1970 of an ISO 8601 text in UTC, exact to its seventh digit."""
    seconds = F.unix_seconds(F.to_timestamp(F.concat(F.regexp_extract(text, r"^(\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d)", 1), F.lit("Z"))))
    return seconds * 10_000_000 + F.rpad(F.regexp_extract(text, r"\.(\d{1,7})", 1), 7, "0").cast("long")


def ticks_text(value: Column) -> Column:
    """The ISO 8601 text of ticks, without trailing zeros of the fraction."""
    base = F.date_format(F.timestamp_seconds(F.floor(value / 10_000_000)), "yyyy-MM-dd'T'HH:mm:ss")
    part = F.rtrim(F.lpad(F.pmod(value, F.lit(10_000_000)).cast("string"), 7, "0"), F.lit("0"))
    return F.concat(base, F.when(part == "", "").otherwise(F.concat(F.lit("."), part)), F.lit("Z"))


def window_start(value: Column, width: int) -> Column:
    """Start of the tumbling window that ticks since year 1 lie in."""
    return value - F.pmod(value, F.lit(width))


def window_bucket(value: Column, width: int, buckets: int = 1000) -> Column:
    """Which of the equal buckets of its window a tick lies in."""
    return F.floor(F.pmod(value, F.lit(width)) / (width // buckets)).cast("int")


def default_if_empty(value: Column, default) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def join_flags(bits: Column, names: list[str]) -> Column:
    """The names of set bits, from the lowest on, joined by a comma and a space; the first name is that of 0."""
    parts = [F.when(bits.bitwiseAND(1 << i) != 0, name) for i, name in enumerate(names[1:])]
    return F.when(bits == 0, names[0]).otherwise(F.concat_ws(", ", *parts))


def bucket_ranges(text: str) -> list[int]:
    """Numbers of a list such as 1-3,7."""
    out: set[int] = set()
    for part in filter(None, (p.strip() for p in text.split(","))):
        low, _, high = part.partition("-")
        a, b = int(low), int(high or low)
        if b < a:
            raise ValueError(f"range {part} runs backwards")
        out.update(range(a, b + 1))
    return sorted(out)


def ranges_text(numbers: list[int]) -> str:
    """The shortest list of ranges of some numbers."""
    parts: list[list[int]] = []
    for n in sorted(set(numbers)):
        if parts and parts[-1][1] == n - 1:
            parts[-1][1] = n
        else:
            parts.append([n, n])
    return ",".join(str(a) if a == b else f"{a}-{b}" for a, b in parts)
