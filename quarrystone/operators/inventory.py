"""PDF inventory, chunk planning and its roll-ups."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrystone.functions import scalars
from quarrystone.operators import ordering


def inventory(files: DataFrame, root: str = "/") -> DataFrame:
    """Inventory records of ``files(rel_path, size_bytes, page_count)``: ids, names, bucket, exclusion."""
    numbered = ordering.path_ordinal(files)
    name = F.element_at(F.split("rel_path", "/"), -1)
    bucket = scalars.path_bucket(F.col("rel_path"))
    return numbered.select(
        scalars.pdf_id(F.col("ordinal"), F.col("rel_path")).alias("pdf_id"),
        "rel_path",
        F.concat(F.lit(root.rstrip("/") + "/"), F.col("rel_path")).alias("abs_path"),
        name.alias("filename"),
        F.regexp_replace(name, r"(.)\.[^.]*$", "$1").alias("stem"),
        bucket.alias("bucket"),
        bucket.startswith("excluded/").alias("excluded"),
        "size_bytes",
        "page_count",
    )


def single_record(path: str, page_count: int | None, spark) -> DataFrame:
    """The inventory row of one ad-hoc file, with ids from its absolute path."""
    frame = spark.createDataFrame([(path, page_count)], "abs_path string, page_count int")
    name = F.element_at(F.split("abs_path", "/"), -1)
    digest = scalars.short_sha1(F.col("abs_path"))
    return frame.select(
        F.concat(F.lit("pdf_single_"), digest).alias("pdf_id"), F.concat(F.lit("single_"), digest).alias("chunk_id"), name.alias("rel_path"), "abs_path",
        name.alias("filename"), F.lit("single_pdf").alias("bucket"), F.lit(False).alias("excluded"), "page_count",
    )


def candidates(records: DataFrame, include_excluded: bool = False) -> DataFrame:
    return records if include_excluded else records.filter(~F.col("excluded"))


def _measures():
    known = F.col("page_count").isNotNull()
    return [
        F.count("*").alias("pdf_count"),
        F.count_if(known).alias("known_page_count_pdfs"),
        F.count_if(~known).alias("unknown_page_count_pdfs"),
        F.coalesce(F.sum("page_count"), F.lit(0)).cast("bigint").alias("total_known_pages"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("total_size_bytes"),
    ]


def rollup(records: DataFrame) -> DataFrame:
    return records.agg(*_measures())


def bucket_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("bucket").agg(F.count("*").alias("pdf_count")).orderBy("bucket")


def chunk_rollup(chunks: DataFrame) -> DataFrame:
    """The roll-up of every chunk, with its first and last path (a chunk is in path-text order)."""
    return chunks.groupBy("chunk_id").agg(*_measures(), F.min("rel_path").alias("first_rel_path"), F.max("rel_path").alias("last_rel_path"))


def chunk_count(records: DataFrame, target_pages: int = 2500, max_pdfs: int = 300, fixed: int | None = None) -> DataFrame:
    """How many chunks to plan: given, or by pages, or by files where no page count is known."""
    pages = F.coalesce(F.sum("page_count"), F.lit(0))
    by_pages = F.greatest(F.lit(1), F.ceil(pages / target_pages))
    by_files = F.greatest(F.lit(1), F.ceil(F.count("*") / max_pdfs))
    planned = F.lit(fixed) if fixed else F.when(pages > 0, by_pages).otherwise(by_files)
    return records.agg(planned.cast("bigint").alias("chunk_count"))


def pack_chunks(records: DataFrame, chunks: int, max_pdfs: int = 300, per: str | None = None) -> DataFrame:
    """``records`` with chunk_id by greedy packing, largest first, into the least loaded chunk that has room.

    Every placement rests on those before it, so one task packs a group, as its four narrow columns come in order of size; it holds the chunks
    with room only. ``per`` packs each of its values apart (another result); groups are dealt over tasks, many small ones to one.
    """
    group = F.col(per) if per else F.lit("")
    thin = records.select(group.cast("string").alias("_group"), "rel_path", F.coalesce(F.col("size_bytes").cast("bigint"), F.lit(0)).alias("_size"), F.col("page_count").cast("double").alias("_pages"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, made = None, 0
        # Load of each chunk with room: pages, files, bytes, number.
        open_chunks: list[tuple] = []
        for batch in batches:
            placed = []
            for name, size, pages in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if name != now or not made:
                    now, made = name, chunks
                    open_chunks = [(0.0, 0, 0, k) for k in range(chunks)]
                if open_chunks:
                    load, files, held, k = heapq.heappop(open_chunks)
                else:
                    load, files, held, k = 0.0, 0, 0, made
                    made += 1
                placed.append(k)
                if files + 1 < max_pdfs:
                    heapq.heappush(open_chunks, (load + (1.0 if pages is None else pages), files + 1, held + size, k))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(placed, pa.int64())], ["_group", "rel_path", "_chunk"])

    tasks = int(records.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    largest = [F.coalesce("_pages", F.lit(0.0)).desc(), F.col("_size").desc(), "rel_path"]
    dealt = thin.repartition(tasks, "_group").sortWithinPartitions("_group", *largest)
    placed = dealt.mapInArrow(place, "_group string, rel_path string, _chunk long")
    prefix = F.concat(F.lit("chunk_"), F.when(F.col("_group") != "", F.concat("_group", F.lit("_"))).otherwise(""))
    named = placed.select(F.col("rel_path"), F.concat(prefix, F.format_string("%04d", F.col("_chunk"))).alias("chunk_id"))
    return records.join(named, "rel_path")


def window_total(records: DataFrame, width: int, start: int = 1, end: int | None = None) -> DataFrame:
    """The number of page windows over all records, in closed form."""
    last = F.least(F.col("page_count"), F.lit(end)) if end else F.col("page_count")
    windows = F.greatest(F.lit(0), F.ceil((last - start + 1) / width))
    return records.filter("page_count > 0").agg(F.coalesce(F.sum(windows), F.lit(0)).cast("bigint").alias("window_total"))


def page_windows(records: DataFrame, width: int, start: int = 1, end: int | None = None) -> DataFrame:
    """One row per window [page_start, page_end] of every record; ``end`` 0 or None is the last page.
    An unknown page count gives none."""
    last = F.least(F.col("page_count"), F.coalesce(F.nullif(F.lit(end), F.lit(0)), F.col("page_count")))
    rows = records.filter("page_count > 0").withColumn("_last", last).filter((F.col("_last") >= start) & F.lit(start >= 1))
    begin = F.explode(F.sequence(F.lit(start), F.col("_last"), F.lit(width)))
    rows = rows.withColumn("page_start", begin).withColumn("page_end", F.least(F.col("page_start") + width - 1, F.col("_last")))
    return rows.drop("_last").withColumn("raw_file", scalars.window_file(F.col("page_start"), F.col("page_end")))
