"""Bucketed, gzip-compressed CSV tables with an exact header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake.functions.scalars import bucket
from cairnlake.plans.registry import TableSpec


def write_csv(df: DataFrame, spec: TableSpec, path: str, buckets: int = 1) -> None:
    """One folder for each bucket, rows sorted by key; nulls are empty, flags are true or false."""
    columns = [F.col(c).cast("string").alias(c) for c in spec.text_schema.names]
    out = df.select(*columns).withColumn("bucket", bucket(F.col(spec.bucket), buckets))
    out = out.repartition("bucket").sortWithinPartitions("bucket", *spec.keys)
    writer = out.write.mode("overwrite").partitionBy("bucket").option("header", True).option("escape", '"').option("emptyValue", "").option("nullValue", "")
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("compression", "gzip").csv(path)


def read_csv(spark: SparkSession, spec: TableSpec, path: str, buckets: list[int] | None = None) -> DataFrame:
    """The rows of a table, or of some buckets, which are the only ones read. A file whose header differs is an error:
    columns do not evolve. Empty text columns are empty, other empty columns null."""
    schema = spec.text_schema
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("enforceSchema", False).option("mode", "FAILFAST").option("emptyValue", "")
    df = raw.schema(schema.add("bucket", T.IntegerType())).csv(path)
    if buckets is not None:
        df = df.where(F.col("bucket").isin(buckets))
    text = {f.name for f in spec.schema if f.dataType.simpleString() == "string"}
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) if c in text else F.col(c) for c in spec.text_schema.names])
