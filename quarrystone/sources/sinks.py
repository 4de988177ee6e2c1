"""Sinks: directories written aside and renamed, small documents as one-row frames."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarrystone import shared
from quarrystone.functions import scalars
from quarrystone.functions.content import ascii_json


def replace_directory(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a folder beside ``path`` and put it in its place: a job that fails leaves the old one as it was."""
    files = spark.sparkContext._jvm.org.apache.hadoop.fs
    aside, before = (files.Path(f"{path.rstrip('/')}.{word}-{uuid.uuid4().hex[:12]}") for word in ("new", "old"))
    target = files.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        write(aside.toString())
        there = system.exists(target)
        if there and not system.rename(target, before):
            raise OSError(f"can't move {path} aside")
        if not system.rename(aside, target):
            if there:
                system.rename(before, target)
            raise OSError(f"can't put {path} in place")
        if there:
            system.delete(before, True)
    finally:
        system.delete(aside, True)


def write_jsonl(rows: DataFrame, path: str, partition_by: str | None = None, keep_nulls: bool = False, ascii_only: bool = False) -> int:
    """Rows as JSON lines with sorted keys; the number written. Replaces ``path`` once all is written. ``ascii_only`` writes other characters as escapes."""
    seen = Observation()
    ordered = rows.select(*sorted(rows.columns)).observe(seen, F.count("*").alias("n"))
    if ascii_only:
        kept = [c for c in ordered.columns if c != partition_by]
        line = ascii_json(F.to_json(F.struct(*kept), {"ignoreNullFields": str(not keep_nulls).lower()})).alias("value")
        writer = ordered.select(line, *([partition_by] if partition_by else [])).write
        replace_directory(rows.sparkSession, path, (writer.partitionBy(partition_by) if partition_by else writer).text)
        return seen.get["n"]
    writer = ordered.write.option("ignoreNullFields", not keep_nulls)
    replace_directory(rows.sparkSession, path, (writer.partitionBy(partition_by) if partition_by else writer).json)
    return seen.get["n"]


def write_document(row: DataFrame, path: str) -> None:
    """A one-row frame as one JSON document."""
    replace_directory(row.sparkSession, path, row.select(*sorted(row.columns)).coalesce(1).write.json)


def append_events(events: DataFrame, path: str) -> None:
    events.write.mode("append").json(path)


def write_manifest(files: DataFrame, path: str) -> None:
    """The CSV manifest: path, size_bytes, source_root."""
    replace_directory(files.sparkSession, path, files.select("path", "size_bytes", "source_root").write.option("header", True).csv)


# The front matter and the closing note of a dataset card.
CARD_LICENSE = "other"
CARD_TAGS = ("smart-contracts", "security", "audits", "vulnerability-detection")
CARD_NOTE = "Made from a local crawl. Check the licences of the original sources before sharing these files."


def dataset_card(files: DataFrame, title: str = "", description: str = "", source_root: str = "", pattern: str = "**/*.pdf", at: str | None = None) -> DataFrame:
    """One row (file_count, total_size, pattern, card) of a manifest; ``card`` is the Markdown document."""
    total = F.coalesce(F.sum("size_bytes"), F.lit(0))
    made = F.date_format(F.lit(at).cast("timestamp") if at else F.current_timestamp(), "yyyy-MM-dd HH:mm:ss 'UTC'")
    facts = {"Files": F.col("file_count").cast("string"), "Total size": F.col("total_size"), "Local source root": F.lit(f"`{source_root}`"), "Upload include pattern": F.lit(f"`{pattern}`"), "Manifest": F.lit("`manifest.csv`"), "Generated": made}
    front = "\n".join(["---", f"license: {CARD_LICENSE}", "tags:", *(f"- {t}" for t in CARD_TAGS), "---"])
    contents = F.concat_ws("\n", *(F.concat(F.lit(f"- {name}: "), value) for name, value in facts.items()))
    card = F.concat_ws("\n\n", F.lit(front), F.lit(f"# {title}"), F.lit(description), F.lit("## Contents"), contents, F.lit("## Notes"), F.lit(CARD_NOTE + "\n"))
    counted = files.agg(F.count("*").alias("file_count"), scalars.human_size(total).alias("total_size"), F.lit(pattern).alias("pattern"))
    return counted.withColumn("card", card)


def envelope(items: DataFrame, source: str = "source", most: int = 10_000) -> DataFrame:
    """Documents of a source: its count, the document's number among its ``parts``, and items. A source has one document up to ``most`` items; more
    are dealt by hash into as many as needed, so a value never holds a whole large source."""
    fields = [c for c in items.columns if c != source]
    # Written, so that the join is of plain exchanges and a large source's rows can be split.
    sizes = shared.stored(items.groupBy(F.struct(source).alias("_of")).agg(F.count("*").alias("count")).withColumn("parts", F.ceil(F.col("count") / most)), "sizes")
    dealt = items.withColumn("_of", F.struct(source)).join(sizes, "_of").withColumn("part", F.pmod(F.xxhash64(*fields), F.col("parts")))
    return dealt.groupBy(source, "count", "parts", "part").agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("items"))


def landing_names(pages: DataFrame, prefix: str = "") -> DataFrame:
    """The bronze name of each page: optional prefix and a digest of its URL."""
    return pages.withColumn("landing_name", F.concat(F.lit(f"{prefix}_" if prefix else ""), scalars.short_md5(F.col("url")), F.lit(".html")))


def pdf_names(links: DataFrame, url: str = "url", content_type: str | None = None) -> DataFrame:
    """``is_pdf`` and ``pdf_name``, the landing name (null where it is none).

    A PDF is what is served as one (``content_type``, a column of headers) or whose whole URL ends in .pdf. The name is the last part of the URL's path if
    that ends in .pdf, else a digest of the URL. Null URLs are none.
    """
    address = F.col(url)
    served = F.contains(F.lower(content_type), F.lit("pdf")) if content_type else F.lit(False)
    path = F.regexp_replace(F.regexp_extract(address, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1), r";[^/;]*$", "")
    last = F.regexp_extract(path, r"([^/]*)/*$", 1)
    name = F.when(F.lower(last).endswith(".pdf"), last).otherwise(F.concat(F.lit("document_"), scalars.short_md5(address), F.lit(".pdf")))
    rows = links.withColumn("is_pdf", address.isNotNull() & (F.coalesce(served, F.lit(False)) | F.lower(address).endswith(".pdf")))
    return rows.withColumn("pdf_name", F.when(F.col("is_pdf"), scalars.sanitize_filename(name)))
