"""File inventories, digests and probes."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone import shared
from quarrystone.functions import scalars
from quarrystone.sources import storage


ENTRY = "path string, folder boolean, size_bytes long, mtime_ns long"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            found = storage.entries(uri)
            while some := list(itertools.islice(found, 10_000)):
                columns = zip(*some)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.bool_(), pa.int64(), pa.int64()))], ["path", "folder", "size_bytes", "mtime_ns"])


def walk(spark: SparkSession, root: str) -> DataFrame:
    """(path, folder, size_bytes, mtime_ns) of all that lies below ``root``, empty files and hidden ones too.

    A round lists the folders that the round before has found, one task a few folders, until none is new; what a round finds is
    written, so neither the driver nor a plan holds the tree. Linked folders aren't followed.
    """
    system, base, ahead = storage.located(root)
    if system.get_file_info(base).type != fs.FileType.Directory:
        raise FileNotFoundError(f"no folder at {root}")
    into, turn = shared.folder(spark, "walk"), 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders = spark.createDataFrame([(ahead + base,)], "path string")
    while True:
        found = shared.stored(folders.repartition(tasks, "path").mapInArrow(_listed, ENTRY), "walk", f"{into}/turn={turn}")
        folders, turn = found.filter("folder").select("path"), turn + 1
        if folders.isEmpty():
            return spark.read.schema(ENTRY + ", turn int").parquet(into).drop("turn")


def list_files(spark: SparkSession, root: str, suffix: str = "pdf", any_case: bool = True) -> DataFrame:
    """(path, rel_path, filename, size_bytes, modified, mtime_ns) of the files below ``root`` with a suffix (none: all), recursively."""
    _, base, ahead = storage.located(root)
    files = walk(spark, root).filter("NOT folder")
    name = F.substring_index("path", "/", -1)
    if suffix:
        files = files.filter(F.lower(name).endswith(f".{suffix.lower()}") if any_case else name.endswith(f".{suffix}"))
    rel = F.substr("path", F.lit(len((ahead + base).rstrip("/")) + 2))
    return files.select("path", rel.alias("rel_path"), name.alias("filename"), "size_bytes", F.timestamp_micros(F.expr("mtime_ns div 1000")).alias("modified"), "mtime_ns")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for path in batch.column(0).to_pylist():
            size, sha, md = 0, hashlib.sha256(), hashlib.md5(usedforsecurity=False)
            for block in storage.chunks(path):
                size += len(block)
                sha.update(block)
                md.update(block)
            rows.append((path, size, sha.hexdigest(), md.hexdigest()))
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), pa.string()))], ["path", "size_bytes", "sha256", "md5"])


def file_hashes(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, size_bytes, sha256, md5) of the files below ``root`` whose names match, each read once, in blocks of a few megabytes, whatever its size."""
    files = matching_any(list_files(spark, root, ""), [pattern], "filename").select("path")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInArrow(_digests, "path string, size_bytes long, sha256 string, md5 string")


def file_manifest(spark: SparkSession, roots: list[str], suffix: str = "pdf") -> DataFrame:
    """(path, size_bytes, source_root) of all roots, ordered by root and path text."""
    out = None
    for root in roots:
        rows = list_files(spark, root, suffix).select(F.col("rel_path").alias("path"), "size_bytes", F.lit(root).alias("source_root"))
        out = rows if out is None else out.unionByName(rows)
    return out.orderBy("source_root", "path")


def shell_regex(pattern: str) -> str:
    """A shell pattern as a regular expression: ``*`` (also across slashes), ``?``, ``[seq]`` and ``[!seq]``; a bracket that isn't closed is itself."""
    out, i = [], 0
    while i < len(pattern):
        c, i = pattern[i], i + 1
        close = pattern.find("]", i + 1 + (pattern[i : i + 1] == "!")) if c == "[" else -1
        if c in "*?":
            out.append(".*" if c == "*" else ".")
        elif close > 0:
            inside = pattern[i:close]
            inside, i = ("^" if inside[0] == "!" else "") + re.sub(r"([\\\[\]^&~])", r"\\\1", inside.removeprefix("!")), close + 1
            out.append(f"[{inside}]")
        else:
            out.append(re.escape(c))
    return f"(?s)^(?:{''.join(out)})\\z"


def matching_any(files: DataFrame, patterns: list[str], column: str = "path") -> DataFrame:
    """Files that match one of shell patterns, case by case."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | F.col(column).rlike(shell_regex(pattern))
    return files.filter(hit)


def page_count(probe: DataFrame, column: str = "output") -> DataFrame:
    """``page_count`` from a probe's text, else the last line (or a message) as ``page_count_error``."""
    count = F.nullif(F.regexp_extract(column, r"(?m)^Pages:\s+(\d+)\s*$", 1), F.lit("")).cast("int")
    lines = F.split(scalars.stripped(F.col(column)), "\n")
    last = F.coalesce(F.nullif(F.element_at(lines, -1), F.lit("")), F.lit("no output"))
    return probe.withColumn("page_count", count).withColumn("page_count_error", F.when(F.col("page_count").isNull(), last))


def manifest_directories(spark: SparkSession, raw_root: str, chunk_ids: list[str] | None = None) -> DataFrame:
    """(pdf_dir, chunk_id, parsed) of every ``pdf_manifest.json`` below any chunk directory."""
    rows = spark.read.option("pathGlobFilter", "pdf_manifest.json").text(raw_root, wholetext=True, recursiveFileLookup=True)
    rows = rows.select(F.regexp_replace(F.col("_metadata.file_path"), "/pdf_manifest.json$", "").alias("pdf_dir"), F.try_parse_json("value").alias("parsed"))
    rows = rows.withColumn("chunk_id", F.regexp_extract("pdf_dir", r"/((?:chunk|single)_[^/]+)/", 1))
    return rows.filter(F.col("chunk_id").isin(chunk_ids)) if chunk_ids else rows


def dataset_listing(lines: DataFrame, column: str = "value") -> DataFrame:
    """Dataset ids of a listing tool's table: first token of each line but the header."""
    token = F.get(F.split(scalars.stripped(F.col(column)), r"\s+"), F.lit(0))
    return lines.select(token.alias("dataset_id")).filter((F.col("dataset_id") != "") & (F.col("dataset_id") != "ref"))
