"""WARC archives: deduplicated writing, reading back, and a globally ordered capture index.

Records are written through Spark's own file output, RECORDS_PER_FILE to a gzip file, so a lost executor repeats
only its files. A file is read back as a stream: a task holds it compressed, and inflated one record at a time.
Each archive file yields a run of index entries sorted by URL key and time. The runs are cut into key ranges of
about ENTRIES_PER_RANGE entries, however many pages there are, and each range merges its pieces of all runs with a
loser tree. Offsets of records count inflated bytes."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.llm.common import shared_dir, shuffle_partitions, written

LEAST_REVISIT_BYTES = 1000
RECORDS_PER_FILE = 4000
ENTRIES_PER_RANGE = 100_000

# Names and URIs of the WARC 1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ENTRY = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url_key string, captured string, archive string, record_at bigint, record_bytes bigint"


def records(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """(record) of each page: response, or revisit of the row with the largest page_id among equal payloads
    of at least `least` bytes. Null html is an empty payload, a null url an empty target; rows with a null
    page_id are responses that nothing refers to; rows that repeat a page_id, with the same html or another, get a record
    each by their own payload."""
    html = F.coalesce("html", F.lit(""))
    p = pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20]", "%20").alias("url"), html.alias("html"), F.octet_length(html).cast("long").alias("size"), F.sha1(html.cast("binary")).alias("digest"))
    sized = p.where(F.col("size") >= least).select("page_id", "digest")
    first = sized.groupBy("digest").agg(F.max("page_id").alias("origin"), F.count("*").alias("n")).where("n > 1").drop("n")
    again = sized.join(first, "digest").where("page_id <> origin").distinct()
    p = p.join(again, ["page_id", "digest"], "left")
    revisit = F.col("origin").isNotNull()
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    # pages carry no time of capture; the id counts seconds from a fixed day
    when = F.date_format(F.timestamp_seconds(F.coalesce(F.pmod(F.col("page_id"), F.lit(2**31)), F.lit(0)) + 1_500_000_000), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    header = F.concat(
        F.lit(f"{VERSION}\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), urn(F.col("page_id")),
        F.lit("\r\nWARC-Date: "), when,
        F.lit("\r\nWARC-Target-URI: "), F.col("url"),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "), urn(F.col("origin")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))).cast("string"), F.lit("\r\n\r\n"), http,
    )
    return p.select(F.concat(header, F.when(revisit, "").otherwise(F.col("html"))).alias("record"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_REVISIT_BYTES) -> None:
    """Gzip files of WARC records below path."""
    out = records(pages, least).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED")
    out.option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


def url_key(url: str) -> str:
    """Host labels from the last to the first, then the path: org,example)/a?b"""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::\d+)?([^#]*)", url.lower())
    return f"{','.join(reversed(m[1].split('.')))}){m[2] or '/'}" if m else url.lower()


def parse_records(content: bytes) -> Iterator[dict]:
    """The records of one archive file (gzip members, or plain), one at a time. Damage is an error."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)
    at = 0
    while line := stream.readline():
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at}")
        stop, head = at + len(line), {}
        while (line := stream.readline()) not in (b"\r\n", b""):
            stop += len(line)
            name, value = line.decode().removesuffix("\r\n").split(": ", 1)
            head[name] = value
        length = int(head["Content-Length"])
        block = stream.read(length)
        if len(block) < length or stream.read(4) != b"\r\n\r\n":
            raise ValueError(f"record at byte {at} is cut short")
        stop += 2 + length
        body = block.index(b"\r\n\r\n") + 4
        size = int(re.search(rb"\r\nContent-Length: (\d+)", block[:body])[1])
        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
        if len(digest) == 32:
            digest = base64.b32decode(digest).hex()
        if head["WARC-Type"] == "response" and (len(block) - body != size or hashlib.sha1(block[body:]).hexdigest() != digest):
            raise ValueError(f"damaged payload at byte {at}")
        number = lambda urn: int(v) if (v := urn[len("<urn:page:") : -1]) else None
        yield {
            "page_id": number(head["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": head["WARC-Type"],
            "refers_to": number(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None,
            "url_key": url_key(head["WARC-Target-URI"]), "captured": head["WARC-Date"], "record_at": at, "record_bytes": stop + 4 - at,
        }
        at = stop + 4


def _key(entry: dict) -> tuple:
    return entry["url_key"], entry["captured"], entry["page_id"] if entry["page_id"] is not None else -(2**63)


def index_runs(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives; those of one archive are a run, numbered in key order by `seq`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                name = name.rsplit("/", 1)[-1]
                entries = sorted(parse_records(content.as_py()), key=_key)
                rows = [e | {"archive": name, "seq": i} for i, e in enumerate(entries)]
                schema = schema or pa.schema([(c, pa.int64() if c in ("page_id", "payload_bytes", "refers_to", "record_at", "record_bytes", "seq") else pa.string()) for c in [*(x.split()[0] for x in ENTRY.split(", ")), "seq"]])
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("path", "content").mapInArrow(run, f"{ENTRY}, seq bigint")


class LoserTree:
    """K-way merge: a tournament whose inner nodes keep the losers, so that the next winner takes one path
    of comparisons from its leaf to the root."""

    def __init__(self, runs: list[list], key) -> None:
        self.runs, self.key = runs, key
        self.size = 1
        while self.size < max(1, len(runs)):
            self.size *= 2
        self.at = [0] * self.size
        self.head = [self._head(i) for i in range(self.size)]
        self.lost = [0] * self.size
        winner = [0] * self.size + list(range(self.size))
        for node in range(self.size - 1, 0, -1):
            a, b = winner[2 * node], winner[2 * node + 1]
            winner[node], self.lost[node] = (a, b) if self._before(a, b) else (b, a)
        self.top = winner[1] if self.size > 1 else 0

    def _head(self, i: int):
        done = i >= len(self.runs) or self.at[i] >= len(self.runs[i])
        return None if done else self.key(self.runs[i][self.at[i]])

    def _before(self, a: int, b: int) -> bool:
        x, y = self.head[a], self.head[b]
        return x is not None and (y is None or (x, a) < (y, b))

    def __iter__(self):
        while self.head[self.top] is not None:
            i = self.top
            yield self.runs[i][self.at[i]]
            self.at[i] += 1
            self.head[i] = self._head(i)
            node = (i + self.size) // 2
            while node:
                if self._before(self.lost[node], i):
                    self.lost[node], i = i, self.lost[node]
                node //= 2
            self.top = i


def merged_index(runs: DataFrame) -> DataFrame:
    """All entries in ranges of (url_key, captured, page_id), in order inside each range and across range
    numbers: (entry columns, key_range, position). Equal keys keep the order of their archives' names."""
    n = max(2, shuffle_partitions(runs.sparkSession), -(-runs.count() // ENTRIES_PER_RANGE))
    ranged = runs.repartitionByRange(n, "url_key", "captured", "page_id").withColumn("key_range", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, list[dict]] = {}
        schema = None
        for batch in batches:
            schema = batch.schema
            for row in batch.to_pylist():
                pieces.setdefault(row["archive"], []).append(row)
        if not pieces:
            return
        for piece in pieces.values():
            piece.sort(key=lambda e: e["seq"])  # fetched blocks may arrive in any order
        out = []
        schema = schema.append(pa.field("position", pa.int64()))
        for position, entry in enumerate(LoserTree([pieces[a] for a in sorted(pieces)], _key)):
            out.append(entry | {"position": position})
            if len(out) == 4096:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return ranged.mapInArrow(run, f"{ENTRY}, seq bigint, key_range int, position bigint").drop("seq")


def archive(pages: DataFrame, path: str | None = None, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Writes the archives below path (by default a new shared folder) and returns the merged index of what
    is read back from them."""
    spark = pages.sparkSession
    path = path or shared_dir(spark)
    write_archives(pages, path, least)
    return merged_index(written(index_runs(spark, path)))
