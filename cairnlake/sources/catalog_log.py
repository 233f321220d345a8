"""Readers of the event log: index, pages and leaves as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions.scalars import ticks

# Names in the documents of the log.
INDEX = "commitTimeStamp string, count int, items array<struct<`@id`:string,commitTimeStamp:string,count:int>>"
PAGE = (
    "`@id` string, commitTimeStamp string, count int, parent string, "
    "items array<struct<`@id`:string,`@type`:string,commitId:string,commitTimeStamp:string,`{0}:id`:string,`{0}:version`:string>>"
)
LEAF = (
    "`@id` string, `@type` array<string>, `catalog:commitId` string, `catalog:commitTimeStamp` string, id string, version string, "
    "published string, created string, lastEdited string, listed boolean, isPrerelease boolean, verbatimVersion string, packageHash string, "
    "packageHashAlgorithm string, packageSize bigint, deprecation struct<message:string,reasons:array<string>,alternatePackage:struct<id:string,range:string>>, "
    "vulnerabilities array<struct<`@id`:string,advisoryUrl:string,severity:string>>, "
    "dependencyGroups array<struct<targetFramework:string,dependencies:array<struct<id:string,range:string>>>>, "
    "packageEntries array<struct<compressedLength:bigint,fullName:string,length:bigint>>"
)


def index_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_url, commit_ts, commit_ticks, count), one row for each page of the index."""
    item = spark.read.schema(INDEX).json(path, multiLine=True).select(F.explode("items").alias("i"))
    return item.select(F.col("i.`@id`").alias("page_url"), F.col("i.commitTimeStamp").alias("commit_ts"), ticks(F.col("i.commitTimeStamp")).alias("commit_ticks"), F.col("i.count").alias("count"))


def page_leaves(spark: SparkSession, path: str, prefix: str) -> DataFrame:
    """One row for each event of the pages; `prefix` is that of the package id and version in page items."""
    item = spark.read.schema(PAGE.format(prefix)).json(path, multiLine=True).select(F.col("`@id`").alias("page_url"), F.explode("items").alias("i"))
    return item.select(
        "page_url", F.col("i.`@id`").alias("url"), F.regexp_extract(F.col("i.`@type`"), r"([^:]*)$", 1).alias("leaf_type"), F.col("i.commitId").alias("commit_id"),
        F.col("i.commitTimeStamp").alias("commit_ts"), ticks(F.col("i.commitTimeStamp")).alias("commit_ticks"),
        F.col(f"i.`{prefix}:id`").alias("package_id"), F.col(f"i.`{prefix}:version`").alias("package_version"),
    )


def leaves(spark: SparkSession, path: str) -> DataFrame:
    """Whole events; a delete event only has the common fields."""
    return spark.read.schema(LEAF).json(path, multiLine=True).withColumn("commit_ticks", ticks(F.col("`catalog:commitTimeStamp`")))
