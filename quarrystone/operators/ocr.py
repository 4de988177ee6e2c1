"""Page extraction runs: pending work, materialised pages, and the roll-ups of both."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone.functions import scalars
from quarrystone.operators import ordering

FAILING = ("error", "partial_error", "unknown")


def response_complete(value: Column) -> Column:
    """A recorded response that parses and has an id and a source."""
    parsed = F.try_parse_json(value)
    has_id = F.coalesce(F.try_variant_get(parsed, "$.id", "string"), F.lit("")) != ""
    source = F.coalesce(F.try_variant_get(parsed, "$.source", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
    return F.coalesce(has_id & (F.size(F.map_keys(source)) > 0), F.lit(False))


def pending_windows(windows: DataFrame, done: DataFrame, keys: list[str], resume: bool = True) -> DataFrame:
    """Windows without a complete response; all of them without ``resume``."""
    return windows.join(done.select(*keys).distinct(), keys, "left_anti") if resume else windows


def window_events(windows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Every planned window with status pending or skipped_existing."""
    known = done.select(*keys).distinct().withColumn("_done", F.lit(True))
    joined = windows.join(known, keys, "left")
    return joined.withColumn("status", F.when(F.col("_done"), "skipped_existing").otherwise("pending")).drop("_done")


def page_store(pages: DataFrame, group: list[str] = ["pdf_id"], file: str = "raw_file", position: str = "position") -> DataFrame:  # noqa: B006
    """One row per page: in each file the pages before the first without a number, and over the files
    of a document, by name, the last version of every page."""
    sound = ordering.before_first_error(pages, [*group, file], position, F.col("page_number").isNull())
    return ordering.keep_last(sound, [*group, "page_number"], [F.col(file).desc(), F.col(position).desc()])


def page_records(raw: DataFrame, manifest: DataFrame, raw_root: str | None = None) -> DataFrame:
    """All page fields from raw responses (``RAW_RESPONSE`` columns plus pdf_dir, raw_file) and manifests."""
    files = raw.join(manifest.withColumnRenamed("page_count", "manifest_page_count"), "pdf_dir")
    rows = files.select("*", F.posexplode("pages").alias("position", "page")).filter(F.col("page").isNotNull()).withColumn("page_number", F.col("page.page_number"))
    rows = page_store(rows)
    empty = F.create_map().cast("map<string,string>")
    return rows.select(
        "pdf_id",
        F.col("rel_path").alias("source_rel_path"),
        F.col("abs_path").alias("source_abs_path"),
        scalars.falsy_coalesce(F.col("source.filename"), F.col("filename")).alias("source_filename"),
        F.col("bucket").alias("source_bucket"),
        scalars.falsy_coalesce(F.col("source.sha256"), F.col("sha256")).alias("source_pdf_sha256"),
        scalars.falsy_coalesce_number(F.col("source.page_count"), F.col("manifest_page_count")).alias("source_page_count"),
        "page_number",
        F.col("page.image_sha256").alias("page_image_sha256"),
        F.coalesce("page.text", F.lit("")).alias("ocr_text"),
        F.col("model").alias("ocr_model"),
        scalars.falsy_coalesce(F.col("model_id"), F.col("model")).alias("ocr_model_version"),
        F.col("backend").alias("ocr_backend"),
        F.col("endpoint_version").alias("ocr_endpoint_version"),
        F.coalesce("settings", empty).alias("ocr_settings"),
        F.lit(None).cast("double").alias("confidence"),
        F.coalesce("warnings", F.array().cast("array<string>")).alias("warnings"),
        *(F.array().cast("array<string>").alias(n) for n in ("layout_blocks", "tables", "code_blocks")),
        F.coalesce(F.when(F.size("page.timing_ms") > 0, F.col("page.timing_ms")), "timing_ms", F.create_map().cast("map<string,bigint>")).alias("timing_ms"),
        F.coalesce("page.usage", empty).alias("usage"),
        F.coalesce("page.throughput", empty).alias("throughput"),
        scalars.path_ref(F.col("raw_file"), F.lit(raw_root)).alias("raw_response_ref"),
        F.current_timestamp().alias("created_at"),
    )


def materialize_summary(pages: DataFrame, store: DataFrame, group: list[str]) -> DataFrame:
    """Per document: raw files, pages, non-empty pages, files with an error, and status."""
    bad = F.col("page_number").isNull()
    files = pages.groupBy(*group, "raw_file").agg(F.max(bad).alias("failed"))
    read = files.groupBy(*group).agg(F.count("*").alias("raw_file_count"), F.count_if("failed").alias("error_count"))
    kept = store.groupBy(*group).agg(F.count("*").alias("page_record_count"), F.count_if(F.coalesce("text", F.lit("")) != "").alias("nonempty_page_count"))
    joined = read.join(kept, group, "left")
    pages_n = F.coalesce("page_record_count", F.lit(0))
    status = F.when(F.col("error_count") > 0, "error").when(pages_n > 0, "ok").otherwise("skipped")
    return joined.select(*group, "raw_file_count", pages_n.alias("page_record_count"), F.coalesce("nonempty_page_count", F.lit(0)).alias("nonempty_page_count"), "error_count", status.alias("status"))


def run_summary(summaries: DataFrame, chunk: Column) -> DataFrame:
    """Counts by chunk (unknown where missing) and status with page sums."""
    named = summaries.withColumn("chunk_id", F.coalesce(F.nullif(chunk, F.lit("")), F.lit("unknown")))
    return named.groupBy("chunk_id", "status").agg(F.count("*").alias("pdf_count"), F.sum("page_record_count").alias("page_record_count"), F.sum("nonempty_page_count").alias("nonempty_page_count"))


def window_summary(responses: DataFrame) -> DataFrame:
    """Per window response: text length, page text lengths as text, non-empty pages, seconds a page."""
    lengths = F.transform("pages", lambda p: F.length(F.coalesce(p["text"], F.lit(""))))
    joined = F.array_join(F.transform("pages", lambda p: F.coalesce(p["text"], F.lit(""))), "\n\n")
    return responses.select(
        "*",
        F.length(joined).alias("text_length"),
        F.array_join(F.transform(lengths, lambda n: n.cast("string")), ",").alias("page_text_lengths"),
        F.size(F.filter(lengths, lambda n: n > 0)).alias("nonempty_pages"),
    )


def sample_summary(responses: DataFrame, page_count: Column) -> DataFrame:
    """Estimates from a sample window: seconds a page, full run, and a preview."""
    total = F.coalesce("total_ms", "client_elapsed_ms")
    selected = F.greatest(F.lit(1), F.coalesce("selected_pages", F.lit(0)))
    per_page = total / 1000.0 / selected
    return responses.select("*", F.round(per_page, 3).alias("seconds_per_page"), F.round(per_page * page_count, 3).alias("estimated_full_seconds"), F.substring("text", 1, 500).alias("text_preview"))


def status_counts(events: DataFrame, group: list[str] = []) -> DataFrame:  # noqa: B006
    named = events.withColumn("status", F.coalesce("status", F.lit("unknown")))
    return named.groupBy(*group, "status").agg(F.count("*").alias("n"))


def progress(events: DataFrame, total: int, order: list[str] = ["ts"]) -> DataFrame:  # noqa: B006
    """One row: completed (at most ``total``), and the label of the latest event by ``order``."""
    done = F.count_if(F.col("status").isin("ok", "skipped_existing"))
    return events.agg(F.least(done, F.lit(total)).alias("completed"), F.max_by("rel_path", F.struct(*order)).alias("last_label"))


def pdf_status(events: DataFrame, group: list[str]) -> DataFrame:
    """Per document: windows by outcome; text and time of the windows completed in this run only."""
    ok, bad = F.col("status") == "ok", F.col("status") == "error"
    return events.groupBy(*group).agg(
        F.when(F.count_if(bad) > 0, "partial_error").otherwise("ok").alias("status"),
        F.count("*").alias("window_count"),
        F.count_if(ok).alias("completed_windows"),
        F.count_if(F.col("status") == "skipped_existing").alias("skipped_existing_windows"),
        F.count_if(bad).alias("error_count"),
        F.coalesce(F.sum(F.when(ok, F.col("text_length"))), F.lit(0)).alias("total_text_length"),
        F.coalesce(F.sum(F.when(ok, F.col("client_elapsed_ms"))), F.lit(0)).alias("total_client_elapsed_ms"),
    )


def chunk_completion(plan: DataFrame, events: DataFrame) -> DataFrame:
    """Planned chunks (chunk_id, expected) with whether a run has finished them without failures."""
    seen = events.groupBy("chunk_id").agg(F.count("*").alias("processed"), F.count_if(F.coalesce("status", F.lit("unknown")).isin(*FAILING)).alias("failing"))
    complete = F.coalesce((F.col("processed") == F.col("expected")) & (F.col("failing") == 0), F.lit(False))
    return plan.join(seen, "chunk_id", "left").withColumn("complete", complete)


def next_incomplete(completion: DataFrame, after: str | None = None) -> DataFrame:
    """The first incomplete chunk behind ``after``; no row where all are complete."""
    rows = completion.filter(~F.col("complete"))
    return (rows.filter(F.col("chunk_id") > after) if after else rows).orderBy("chunk_id").limit(1)


def generation_rollup(results: DataFrame, group: list[str], position: str) -> DataFrame:
    """Sums over generation requests; the first time to a token, its truncated mean when there are
    several; token sums only where all requests have them; ``mixed`` for differing units."""
    seen = F.count("ttft")
    units = F.count_distinct(F.nullif("units", F.lit("")))
    tokens = F.when(F.count("completion_tokens") == F.count("*"), F.sum("completion_tokens"))
    return results.groupBy(*group).agg(
        F.count("*").alias("request_count"),
        F.sum("total_ms").alias("total_ms"),
        F.sum("decode_ms").alias("decode_ms"),
        F.min_by("ttft", F.when(F.col("ttft").isNotNull(), F.col(position))).alias("ttft"),
        F.when(seen > 1, F.floor(F.sum("ttft") / seen)).alias("avg_ttft"),
        tokens.alias("completion_tokens"),
        F.when(units == 1, F.max(F.nullif("units", F.lit("")))).when(units > 1, "mixed").alias("output_units"),
        scalars.throughput(tokens, F.sum("decode_ms")).alias("output_units_per_second"),
    )


def _merged(out: Column, later: Column) -> Column:
    return F.map_zip_with(out, later, lambda k, old, new: F.when(F.map_contains_key(later, k), new).otherwise(old))


def merged_totals(*maps: Column) -> Column:
    """Maps merged in order, later keys winning, a null value too, whatever the session's policy for repeated keys; null maps are left out."""
    out = maps[0]
    for later in maps[1:]:
        out = F.coalesce(_merged(out, later), out, later)
    return out


def checksum_mismatches(pages: DataFrame, records: DataFrame) -> DataFrame:
    """Pages whose recorded PDF checksum differs from the inventory's."""
    return pages.join(records.select("pdf_id", F.col("sha256").alias("inventory_sha256")), "pdf_id").filter(~F.col("source_pdf_sha256").eqNullSafe(F.col("inventory_sha256")))
