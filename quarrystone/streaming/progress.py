"""Progress events as streams: tail, running counts, exactly-once landing, sliding rates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarrystone import shared
from quarrystone.schemas import PROGRESS_EVENT
from quarrystone.sources.tail import growing_lines


def tail_events(spark: SparkSession, folder: str, schema: str = PROGRESS_EVENT, **options: str) -> DataFrame:
    """Events appended to the JSONL logs below ``folder``, each once; lines that aren't JSON objects are left out.

    A log is read on from the byte where it was left, so events that are appended to a file that was read before arrive too, after a
    restart from the checkpoint as well. ``options`` are those of ``GrowingLines``: ``from="end"`` starts behind what is there,
    ``drain="true"`` takes a last line without an end once the writer has stopped.
    """
    parsed = F.try_parse_json("line")
    lines = growing_lines(spark, folder, **options).filter(F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False)))
    return lines.select(F.from_json("line", schema).alias("event")).select("event.*")


def running_counts(events: DataFrame, group: list[str] = []) -> DataFrame:  # noqa: B006
    """Counts by status, to be written in update mode."""
    return events.withColumn("status", F.coalesce("status", F.lit("unknown"))).groupBy(*group, "status").agg(F.count("*").alias("n"))


def sliding_calls(events: DataFrame, time: str, service: str, period: str = "60 seconds", slide: str = "1 second", late: str = "10 minutes") -> DataFrame:
    """Calls per service in sliding windows; state goes when the watermark passes."""
    return events.withWatermark(time, late).groupBy(service, F.window(time, period, slide)).agg(F.count("*").alias("calls"))


def land_once(events: DataFrame, path: str, checkpoint: str, keys: list[str], time: str | None = None, late: str = "10 minutes") -> StreamingQuery:
    """Land every key once, in folders ``batch=<number>``.

    Keys that were seen are the stream's own state, so no batch reads what has landed; the state is dropped ``late`` behind
    the watermark of ``time``, and kept for ever without one. A batch replaces its own folder, so one that runs again, or was
    cut off half-way, adds nothing.
    """
    once = events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys) if time else events.dropDuplicates(keys)

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return once.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_to_table(counts: DataFrame, keys: list[str], checkpoint: str | None = None, mode: str = "update") -> DataFrame:
    """Run a stream over what there is now and return the last row of each of its keys.

    A batch lands the rows that it changed in a folder of its own in the shared storage; nothing is kept in the driver, and state leaves
    behind the watermark of ``counts``.
    """
    spark = counts.sparkSession
    path = shared.folder(spark, "running")

    def land(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = counts.writeStream.outputMode(mode).foreachBatch(land).trigger(availableNow=True).option("checkpointLocation", checkpoint or shared.folder(spark, "checkpoint")).start()
    query.awaitTermination()
    landed = spark.read.schema(T.StructType([*counts.schema.fields, T.StructField("batch", T.LongType())])).parquet(path)
    values = [c for c in counts.columns if c not in keys]
    last = landed.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("last"))
    return last.select(*(F.col(c) if c in keys else F.col("last")[c].alias(c) for c in counts.columns))
