"""Readers of snapshot files as DataFrames. A snapshot is one JSON document, of which many tasks read the items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.sources.json_items import json_items


def downloads_v1(spark: SparkSession, path: str) -> DataFrame:
    """(pos, id, version, downloads) from [[id, [version, n], ...], ...]; pos keeps the order of the file."""
    outer = json_items(spark, path).select(F.col("pos").alias("p"), F.from_json("item", "array<string>").alias("item"))
    inner = outer.select("p", F.col("item")[0].alias("id"), F.posexplode(F.slice("item", 2, F.size("item"))).alias("q", "pair"))
    pair = F.from_json("pair", "array<string>")
    return inner.select(F.struct("p", "q").alias("pos"), "id", pair[0].alias("version"), pair[1].cast("long").alias("downloads"))


def _members(spark: SparkSession, path: str, value: str) -> DataFrame:
    """(p, id, value) of the members of one JSON object, each parsed by itself, so repeated names stay apart."""
    member = F.from_json(F.concat(F.lit("{"), "item", F.lit("}")), f"map<string,{value}>")
    return json_items(spark, path).select(F.col("pos").alias("p"), F.explode(member).alias("id", "value"))


def downloads_v2(spark: SparkSession, path: str) -> DataFrame:
    """The same facts from {id: {version: n}}; repeated names stay apart."""
    inner = _members(spark, path, "string").select("p", "id", F.posexplode(F.from_json("value", "map<string,bigint>")).alias("q", "version", "downloads"))
    return inner.select(F.struct("p", "q").alias("pos"), "id", "version", "downloads")


def names_by_id(spark: SparkSession, path: str, name: str = "owner") -> DataFrame:
    """(pos, id, name) from {id: [name, ...]}: owners and popularity transfers. An id without names gives no row."""
    return _members(spark, path, "array<string>").select("p", "id", F.posexplode("value").alias("q", name)).select(F.struct("p", "q").alias("pos"), "id", name)


def ids(spark: SparkSession, path: str) -> DataFrame:
    """(id) from [id, ...]: verified and excluded packages."""
    return json_items(spark, path).select(F.explode(F.from_json(F.concat(F.lit("["), "item", F.lit("]")), "array<string>")).alias("id"))


def repository_usage(spark: SparkSession, path: str) -> DataFrame:
    """(repository, stars, id) for each dependency of each repository."""
    kind = "struct<Url:string,Stars:int,Id:string,Description:string,Dependencies:array<string>>"
    repo = json_items(spark, path).select(F.from_json("item", kind).alias("r"))
    return repo.select(F.coalesce("r.Id", "r.Url").alias("repository"), F.col("r.Stars").alias("stars"), F.explode("r.Dependencies").alias("id"))


def newest_of(candidates: list[tuple[str, object, object]], now) -> tuple[str, object]:
    """(path, as_of) of the candidate (path, last modified, greatest age) that changed last; an error if it is too old."""
    path, modified, most = max(candidates, key=lambda c: c[1])
    if now - modified > most:
        raise ValueError(f"{path} is older than {most}")
    return path, modified
