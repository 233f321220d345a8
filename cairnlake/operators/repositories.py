"""Source repositories that URLs of source files name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The host of raw files, the kinds of repositories.
RAW_HOST = "raw.githubusercontent.com"
INVALID, GITHUB, UNKNOWN = "Invalid", "GitHub", "Unknown"

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)/([^/?#]*)/([^/?#]*)/"


def source_repo(url: Column) -> Column:
    """A struct (kind, host, owner, repo, ref). A URL of a raw file names owner, repository and ref and needs a path
    behind them; any other URL with a host is of an unknown repository on that host; the rest, null among it, is invalid."""
    host = F.lower(F.regexp_extract(url, _HOST, 1))
    raw = host == RAW_HOST
    named = raw & F.regexp_like(url, F.lit(_PATH))
    kind = F.when(named, GITHUB).when(raw | (F.coalesce(host, F.lit("")) == ""), INVALID).otherwise(UNKNOWN)
    part = lambda k: F.when(named, F.regexp_extract(url, _PATH, k))
    return F.struct(kind.alias("kind"), F.when(kind == UNKNOWN, host).alias("host"), part(1).alias("owner"), part(2).alias("repo"), part(3).alias("ref"))


def source_repositories(df: DataFrame, keys: list[str], url: str) -> DataFrame:
    """(keys, kind, host, owner, repo, ref, n_files, example): the repositories of each key, how many URLs name each, repeated ones
    counted, and the smallest of these. One aggregation with map-side combine."""
    rows = df.select(*keys, source_repo(F.col(url)).alias("_repo"), F.col(url).alias("_url")).select(*keys, "_repo.*", "_url")
    return rows.groupBy(*keys, "kind", "host", "owner", "repo", "ref").agg(F.count("*").alias("n_files"), F.min("_url").alias("example"))
