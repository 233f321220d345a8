"""Package archives (ZIP files) as rows: directories, entry hashes, manifests and license expressions."""

from __future__ import annotations

import base64
import datetime
import hashlib
import io
import re
import struct
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairnlake.functions import scalars

ENTRIES = "sequence_number int, path string, flags int, compression_method int, last_modified string, crc32 bigint, compressed_size bigint, uncompressed_size bigint, comment string"
FILES = "sequence_number int, path string, compressed_length bigint, entry_length bigint, actual_length bigint, sha256 string, first_bytes string, result_type string"


def package_files(spark: SparkSession, path: str, pattern: str = "*.nupkg") -> DataFrame:
    """(path, modificationTime, length, content) of archive files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)


def _per_archive(packages: DataFrame, key: str, schema: str, rows_of) -> DataFrame:
    """rows_of(bytes) for each row of (key, content); batches are small because archives are large."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        for batch in batches:
            for k, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = [{key: k, **dict(zip(names, r))} for r in rows_of(content.as_py())]
                if rows:
                    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
                    arrow = arrow or pa.schema([(key, pa.string())] + [(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])
                    yield pa.RecordBatch.from_pylist(rows, arrow)

    return packages.select(F.col(key).cast("string"), "content").mapInArrow(run, f"{key} string, {schema}")


def _directory(content: bytes | None) -> list[tuple]:
    return _directory_of(io.BytesIO(content or b""))


def _directory_of(file) -> list[tuple]:
    """The entries that the directory at the end of a file lists. Only the end record and the directory are read."""
    try:
        with zipfile.ZipFile(file) as z:
            out = []
            for i, e in enumerate(z.infolist()):
                when = datetime.datetime(*e.date_time).isoformat() if e.date_time[1] and e.date_time[2] else None
                out.append((i, e.orig_filename, e.flag_bits, e.compress_type, when, e.CRC, e.compress_size, e.file_size, e.comment.decode("utf-8", "replace")))
            return out
    except (zipfile.BadZipFile, EOFError, struct.error):
        return []


class _Opened(io.RawIOBase):
    """A file of any store that Arrow knows, for reads at any place; places before the start are an OSError, as in Python."""

    def __init__(self, path: str) -> None:
        store, name = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
        self.file = store.open_input_file(name)
        self.size, self.at = self.file.size(), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        at = offset + (0, self.at, self.size)[whence]
        if at < 0:
            raise OSError("a place before the start")
        self.at = at
        return at

    def read(self, size: int = -1) -> bytes:
        left = max(0, self.size - self.at)
        data = self.file.read_at(left if size is None or size < 0 else min(size, left), self.at)
        self.at += len(data)
        return data

    def close(self) -> None:
        self.file.close()
        super().close()


def archive_tails(spark: SparkSession, path: str, pattern: str = "*.nupkg", files_per_task: int = 256) -> DataFrame:
    """The rows of archive_entries() for all archives below path, without reading the archives: Spark lists the files, and tasks
    read the end of each. Damaged archives give no row."""
    names = [c.split()[0] for c in ENTRIES.split(", ")]
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    schema = pa.schema([("path_of_archive", pa.string())] + [(c.split()[0], kinds[c.split()[1]]) for c in ENTRIES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with _Opened(name) as file:
                    rows = [{"path_of_archive": name, **dict(zip(names, r))} for r in _directory_of(file)]
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = package_files(spark, path, pattern).select("path")  # no content, so none is read
    spread = files.repartition(max(1, -(-files.count() // files_per_task)))
    return _with_path_parts(spread.mapInArrow(run, f"path_of_archive string, {ENTRIES}"))


def archive_entries(packages: DataFrame, key: str = "path") -> DataFrame:
    """One row for each entry of each archive, in the order of the directory, with the parts of its path."""
    own = f"{key}_of_archive" if key == "path" else key
    return _with_path_parts(_per_archive(packages.withColumnRenamed(key, own), own, ENTRIES, _directory))


def _with_path_parts(rows: DataFrame) -> DataFrame:
    p = F.col("path")
    return rows.withColumn("file_name", scalars.file_name(p)).withColumn("file_extension", scalars.file_extension(p)).withColumn("top_level_folder", scalars.top_folder(p))


def _hashes(content: bytes | None) -> list[tuple]:
    try:
        archive = zipfile.ZipFile(io.BytesIO(content or b""))
    except zipfile.BadZipFile:
        return []
    out = []
    for i, e in enumerate(archive.infolist()):
        if e.is_dir():
            continue
        try:
            data = archive.read(e)
        except (zipfile.BadZipFile, NotImplementedError, EOFError, OSError, RuntimeError, ValueError):
            out.append((i, e.orig_filename, e.compress_size, e.file_size, None, None, None, "InvalidZipEntry"))
            continue
        out.append((i, e.orig_filename, e.compress_size, e.file_size, len(data), base64.b64encode(hashlib.sha256(data).digest()).decode(), base64.b64encode(data[:16]).decode(), "Available"))
    return out


def archive_hashes(packages: DataFrame, key: str = "path") -> DataFrame:
    """Lengths, SHA-256 and leading bytes of each entry."""
    own = f"{key}_of_archive" if key == "path" else key
    return _per_archive(packages.withColumnRenamed(key, own), own, FILES, _hashes)


MANIFEST = "id string, original_version string, title string, authors string, description string, summary string, tags string, license string, license_type string, icon string, readme string, project_url string, min_client_version string, development_dependency string, package_types string, dependencies string"


def _manifest(content: bytes | None) -> list[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(content or b"")) as z:
            name = next((n for n in z.namelist() if "/" not in n and n.lower().endswith(".nuspec")), None)
            if name is None:
                return []
            root = ElementTree.fromstring(z.read(name))
    except (zipfile.BadZipFile, ElementTree.ParseError):
        return []
    bare = lambda e: e.tag.rpartition("}")[2]
    meta = next((e for e in root if bare(e) == "metadata"), root)
    text = {bare(e): (e.text or "").strip() for e in meta}
    license_ = next((e for e in meta if bare(e) == "license"), None)
    types = [e.get("name", "") for e in meta.iter() if bare(e) == "packageType"]
    dependencies = [f"{e.get('id')} {e.get('version') or ''}".strip() for e in meta.iter() if bare(e) == "dependency"]
    fields = ["id", "version", "title", "authors", "description", "summary", "tags", "license"]
    out = [text.get(f) for f in fields] + [license_.get("type") if license_ is not None else None]
    out += [text.get("icon"), text.get("readme"), text.get("projectUrl"), meta.get("minClientVersion"), text.get("developmentDependency")]
    return [(*out, ";".join(types), ";".join(dependencies))]


def manifests(packages: DataFrame, key: str = "path") -> DataFrame:
    """The manifest of each archive that has one."""
    return _per_archive(packages, key, MANIFEST, _manifest)


def license_leaves(expression: str | None) -> tuple[list[str], list[str]]:
    """(license ids, exceptions) of an SPDX expression, each sorted; an error where it is malformed."""
    tokens = re.findall(r"[()]|[A-Za-z0-9.+-]+", expression or "")
    if "".join(tokens) != re.sub(r"\s+", "", expression or "") or not tokens:
        raise ValueError(f"not a license expression: {expression!r}")
    licenses, exceptions, at = set(), set(), 0

    def term() -> None:
        nonlocal at
        if at >= len(tokens) or tokens[at] in (")", "AND", "OR", "WITH"):
            raise ValueError("a license is missing")
        if tokens[at] == "(":
            at += 1
            chain()
            if at >= len(tokens) or tokens[at] != ")":
                raise ValueError("a bracket is open")
            at += 1
            return
        licenses.add(tokens[at].removesuffix("+"))
        at += 1
        if at < len(tokens) and tokens[at] == "WITH":
            if at + 1 >= len(tokens):
                raise ValueError("an exception is missing")
            exceptions.add(tokens[at + 1])
            at += 2

    def chain() -> None:
        nonlocal at
        term()
        while at < len(tokens) and tokens[at] in ("AND", "OR"):
            at += 1
            term()

    chain()
    if at != len(tokens):
        raise ValueError("text after the expression")
    return sorted(licenses), sorted(exceptions)


def license_rows(df: DataFrame, id_col: str, expression_col: str) -> DataFrame:
    """(id, licenses, exceptions, is_valid) of license expressions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            licenses, exceptions, valid = [], [], []
            for text in batch.column(1).to_pylist():
                try:
                    a, b = license_leaves(text)
                except ValueError:
                    a, b = None, None
                licenses.append(a)
                exceptions.append(b)
                valid.append(a is not None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(licenses, pa.list_(pa.string())), pa.array(exceptions, pa.list_(pa.string())), pa.array(valid)], ["id", "licenses", "exceptions", "is_valid"])

    return df.select(F.col(id_col).alias("id"), F.col(expression_col)).mapInArrow(run, f"id {df.schema[id_col].dataType.simpleString()}, licenses array<string>, exceptions array<string>, is_valid boolean")
