"""Keyed tables in hash buckets that new rows are appended to and merged into.

Rows are appended batch by batch, cut by bucket. Compaction merges the buckets that got rows, and only those: the rows of
a bucket, old and new, are pruned by the table's rule, checked for unique keys and sorted; other buckets keep their files.

Compaction can stop anywhere. Merged buckets are first written aside, then a plan names the buckets to replace and to
drop and the batches that are used up; from there on the plan is carried out, again by the next caller if need be. Every
step of it may run twice. One writer at a time; a reader that needs several buckets of one age reads a published
version (see `ledger`)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairnlake.functions.scalars import bucket
from cairnlake.operators import merge
from cairnlake.plans.registry import TableSpec
from cairnlake.sources.folders import children, drop, exists

Prune = Callable[[DataFrame], DataFrame]


def _certificates(rows: DataFrame) -> DataFrame:
    block = lambda kind: [f"{kind}{part}" for part in ("Status", "StatusFlags", "StatusUpdateTime", "RevocationTime")]
    blocks = {f"{kind}CommitTimestamp": block(kind) for kind in ("CodeSigning", "Timestamping")}
    fixed = ["FingerprintSHA256Hex", "FingerprintSHA1Hex", "Subject", "Issuer", "NotBefore", "NotAfter", "SerialNumber", "SignatureAlgorithmOid", "Version", "Extensions", "PublicKeyOid", "RawDataLength", "RawData"]
    marked = rows.withColumn("__deleted", F.coalesce(F.col("ResultType") == "Deleted", F.lit(False)))
    out = merge.block_merge(marked, "Fingerprint", ["ScanTimestamp"], blocks, "__deleted", fixed)
    return _without_scan(out).select(*rows.columns)


def _without_scan(rows: DataFrame) -> DataFrame:
    """Rows in the table carry no scan, so rows of any later scan are newer."""
    return rows.withColumns({c: F.lit(None).cast(rows.schema[c].dataType) for c in ("ScanId", "ScanTimestamp")})


#: The rule of each kind of table, on old and new rows of whole buckets; the column `bucket` stays.
PRUNES: dict[str, Prune] = {
    "newest_batch": lambda rows: merge.newest_batch(rows, ["Identity"], "CatalogCommitTimestamp", "ScanTimestamp", "ScanId", final=True),
    "distinct": lambda rows: rows.distinct(),
    "certificate_blocks": _certificates,
    "most_downloads": lambda rows: merge.greatest_row(rows, ["Identity"], "Downloads", [F.col("AsOfTimestamp").desc_nulls_last(), F.col("Version")]),
    "sort": lambda rows: rows,
}


@dataclass
class BucketTable:
    """A table below path; `replaces` says that new rows take the place of all old ones of the table."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: list[str]
    bucket_by: Column
    buckets: int
    prune: Prune
    replaces: bool = False

    @staticmethod
    def of(spark: SparkSession, path: str, spec: TableSpec, buckets: int) -> BucketTable:
        """The table of a registry entry, with the rule that the registry names."""
        return BucketTable(spark, path, spec.schema, spec.keys, F.col(spec.bucket), buckets, PRUNES[spec.merge], spec.merge == "sort")

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows, or those of some buckets, which are the only ones read."""
        return self._rows(buckets).drop("bucket")

    def _rows(self, buckets: list[int] | None = None, path: str = "") -> DataFrame:
        schema = T.StructType([*self.schema, T.StructField("bucket", T.IntegerType())])
        root = path or self.path
        if not any(name.startswith("bucket=") for name in children(self.spark, root)):
            return self.spark.createDataFrame([], T.StructType([T.StructField(f.name, f.dataType) for f in schema]))
        rows = self.spark.read.schema(schema).parquet(root)
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def append(self, rows: DataFrame, batch: str) -> None:
        """Puts rows beside the table until the next compaction. A batch that comes twice before it counts once."""
        self.recover()
        own = rows.select(*self.schema.names).withColumn("bucket", bucket(self.bucket_by.cast("string"), self.buckets))
        self._write(own, f"{self.path}/_new/{batch}")

    def _write(self, rows: DataFrame, path: str, mode: str = "overwrite") -> None:
        """One folder for each bucket; adaptive execution cuts a large bucket into several files."""
        out = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", *self.keys)
        out.write.mode(mode).option("partitionOverwriteMode", "dynamic" if path == self.path else "static").partitionBy("bucket").parquet(path)

    def compact(self) -> list[int]:
        """Merges what was appended and returns the buckets whose files changed: none where nothing is new, or where the
        new rows leave their buckets as they were."""
        self.recover()
        batches = children(self.spark, f"{self.path}/_new")
        if not batches:
            return []
        fresh = self._rows(path=f"{self.path}/_new/{batches[0]}")
        for batch in batches[1:]:
            fresh = fresh.unionByName(self._rows(path=f"{self.path}/_new/{batch}"))
        touched = sorted(r[0] for r in fresh.select("bucket").distinct().collect())  # at most `buckets` numbers
        if self.replaces and touched:
            touched = sorted({*touched, *(int(name[len("bucket=") :]) for name in children(self.spark, self.path) if name.startswith("bucket="))})
        old = self._rows(touched)
        self._write(self.prune(fresh if self.replaces else old.unionByName(fresh)), f"{self.path}/_merged")
        merged = self._rows(path=f"{self.path}/_merged")
        merge.check_unique(merged, self.keys)
        before, after = self._digests(old), self._digests(merged)
        plan = [(b, "replace" if b in after else "drop", None) for b in touched if before.get(b) != after.get(b)]
        plan += [(None, "used", batch) for batch in batches]
        self.spark.createDataFrame(plan, "bucket int, action string, batch string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_plan")
        self.recover()
        return [b for b, action, _ in plan if action != "used"]

    def _digests(self, rows: DataFrame) -> dict[int, tuple]:
        """What the rows of each bucket are, whatever their order: one row for each bucket."""
        h = F.xxhash64(*self.schema.names)
        each = rows.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(h).alias("x"), F.sum(h.cast("decimal(38,0)")).alias("s"))
        return {r["bucket"]: (r["n"], r["x"], r["s"]) for r in each.collect()}

    def recover(self) -> None:
        """Carries out a plan that is there, and clears away what has none."""
        plan = f"{self.path}/_plan"
        if exists(self.spark, f"{plan}/_SUCCESS"):
            steps = self.spark.read.parquet(plan).collect()
            replaced = [r["bucket"] for r in steps if r["action"] == "replace"]
            if replaced:
                self._write(self._rows(path=f"{self.path}/_merged").where(F.col("bucket").isin(replaced)), self.path)
            for r in steps:
                if r["action"] == "drop":
                    drop(self.spark, f"{self.path}/bucket={r['bucket']}")
                elif r["action"] == "used":
                    drop(self.spark, f"{self.path}/_new/{r['batch']}")
        for name in ("_plan", "_merged"):
            if exists(self.spark, f"{self.path}/{name}"):
                drop(self.spark, f"{self.path}/{name}")

    def metrics(self) -> DataFrame:
        """(bucket, files, records, compressed_bytes, raw_bytes): raw bytes are those of the rows as CSV lines."""
        rows = self._rows()
        if not rows.inputFiles():
            return rows.groupBy("bucket").agg(*[F.count("*").alias(c) for c in ("files", "records", "compressed_bytes", "raw_bytes")])
        rows = rows.withColumns({"__file": F.col("_metadata.file_path"), "__size": F.col("_metadata.file_size")})
        line = F.octet_length(F.to_csv(F.struct(*self.schema.names))) + 1
        files = rows.groupBy("bucket", "__file").agg(F.first("__size").alias("size"), F.count("*").alias("records"), F.sum(line).alias("raw"))
        return files.groupBy("bucket").agg(F.count("*").alias("files"), F.sum("records").alias("records"), F.sum("size").alias("compressed_bytes"), F.sum("raw").alias("raw_bytes"))
