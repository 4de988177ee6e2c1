"""JSON and JSONL scans, strict and tolerant, on text lines so that a bad one can be named."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def numbered_lines(spark: SparkSession, path: str, fault: Column | None = None) -> DataFrame:
    """(path, line, value) of every line, counted from 1 in its file, however many tasks read it; with ``fault`` (a text about
    ``value``, or null) also that of the file's first faulty line, as (line, text).

    Two scans: one counts the lines of each byte range of a file (one row a range), the other numbers them from what stands
    ahead of their range. Lines meet the counts by a join on few rows and aren't shuffled for it.
    """
    # The id runs on by one inside a range, whichever ranges share a task.
    at = (F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("begin"), F.monotonically_increasing_id().alias("id"))
    text = spark.read.text(path)
    fault = F.lit(None).cast("string") if fault is None else fault
    first = F.min(F.when(F.col("fault").isNotNull(), F.struct("id", "fault"))).alias("worst")
    ranges = text.select(*at, fault.alias("fault")).groupBy("path", "begin").agg(F.min("id").alias("first"), F.count("*").alias("n"), first)
    file = Window.partitionBy("path").orderBy("begin")
    ahead = F.coalesce(F.sum("n").over(file.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.withColumn("shift", ahead - F.col("first") + 1)
    worst = F.when(F.col("worst").isNotNull(), F.struct((F.col("worst.id") + F.col("shift")).alias("line"), F.col("worst.fault").alias("text")))
    ranges = ranges.select("path", "begin", "shift", F.min(worst).over(Window.partitionBy("path")).alias("fault"))
    rows = text.select(*at, "value").join(ranges, ["path", "begin"])
    return rows.select("path", (F.col("id") + F.col("shift")).alias("line"), "value", "fault")


def json_lines(spark: SparkSession, path: str, numbered: bool = True) -> DataFrame:
    """(path, line, value, parsed): one row per non-blank line, parsed to VARIANT or null. Where not ``numbered`` line is null and the file is read once."""
    lines = numbered_lines(spark, path).drop("fault") if numbered else spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.lit(None).cast("long").alias("line"), "value")
    return lines.filter(F.col("value").rlike(r"\S")).withColumn("parsed", F.try_parse_json("value"))


def _is_object(c):
    return F.schema_of_variant(c).startswith("OBJECT")


def strict_jsonl(spark: SparkSession, path: str, objects_only: bool = True, numbered: bool = True) -> DataFrame:
    """As ``json_lines``; a bad line, or a value that isn't an object, fails: ``numbered``, with the path and number of its file's first one,
    else with its own text."""
    parsed = F.try_parse_json("value")
    fault = F.when(~F.col("value").rlike(r"\S"), None).when(parsed.isNull(), "invalid JSON at ")
    if objects_only:
        fault = fault.when(~_is_object(parsed), "not a JSON object at ")
    if numbered:
        rows = numbered_lines(spark, path, fault).filter(F.col("value").rlike(r"\S"))
        fails = F.when(F.col("fault").isNotNull(), F.raise_error(F.concat(F.col("fault.text"), F.col("path"), F.lit(":"), F.col("fault.line").cast("string"))))
        return rows.withColumn("parsed", fails.otherwise(parsed)).drop("fault")
    fails = F.when(fault.isNotNull(), F.raise_error(F.concat(fault, F.col("path"), F.lit(":"), F.col("value"))))
    return json_lines(spark, path, False).withColumn("parsed", fails.otherwise(F.col("parsed")))


def tolerant_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Splittable scan that leaves out malformed lines."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_documents(spark: SparkSession, path: str, objects_only: bool = True) -> DataFrame:
    """(path, value, parsed): one JSON document a file."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    rows = rows.withColumn("parsed", F.try_parse_json("value"))
    bad = F.col("parsed").isNull()
    if objects_only:
        bad = bad | ~_is_object(F.col("parsed"))
    return rows.withColumn("parsed", F.when(bad, F.raise_error(F.concat(F.lit("not a JSON object: "), F.col("path")))).otherwise(F.col("parsed")))


def split_datasets(spark: SparkSession, train: str, validation: str | None = None) -> DataFrame:
    """Train and optional validation JSON files with a ``split`` column."""
    rows = spark.read.json(train).withColumn("split", F.lit("train"))
    if validation:
        rows = rows.unionByName(spark.read.json(validation).withColumn("split", F.lit("validation")), allowMissingColumns=True)
    return rows


def downloaded_dataset(spark: SparkSession, root: str, kind: str = "parquet") -> DataFrame:
    """A dataset laid out as ``split=<name>`` directories, or as plain files without splits."""
    rows = spark.read.format(kind).load(root)
    return rows if "split" in rows.columns else rows.withColumn("split", F.lit(None).cast("string"))


def log_lines(spark: SparkSession, path: str) -> DataFrame:
    """(time, level, origin, message) of ``time | level | origin - message`` lines."""
    pattern = r"^(\S+ \S+)\s*\|\s*(\w+)\s*\|\s*(\S+) - (.*)$"
    fields = [F.nullif(F.regexp_extract("value", pattern, i), F.lit("")).alias(n) for i, n in enumerate(("time", "level", "origin", "message"), 1)]
    return spark.read.text(path).select(*fields)


def event_stream_fold(lines: DataFrame) -> DataFrame:
    """Fold server-sent token events ``(request_id, seq, ms, line)`` to text, first-token and decode time.

    Lines without ``data:`` and malformed events are skipped, ``[DONE]`` ends a request, the last
    usage wins. A request's events are bounded by its reply's length.
    """
    data = F.regexp_extract("line", r"^data:\s*(.*)$", 1)
    rows = lines.withColumn("data", data).filter(F.col("data") != "")
    done = rows.filter(F.col("data") == "[DONE]").groupBy("request_id").agg(F.min("seq").alias("end"))
    event = F.try_parse_json("data")
    rows = rows.join(done, "request_id", "left").filter(F.col("end").isNull() | (F.col("seq") < F.col("end"))).withColumn("event", event).filter(F.col("event").isNotNull())
    token = F.try_variant_get("event", "$.choices[0].delta.content", "string")
    used = F.try_variant_get("event", "$.usage.completion_tokens", "bigint")
    part = F.coalesce(token, F.lit(""))
    return rows.groupBy("request_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", part.alias("part")))), lambda x: x["part"]), "").alias("text"),
        F.min(F.when(part != "", F.col("ms"))).alias("first_token_ms"),
        (F.max("ms") - F.min(F.when(part != "", F.col("ms")))).alias("decode_ms"),
        F.max_by(used, F.when(used.isNotNull(), F.col("seq"))).alias("completion_tokens"),
    )
