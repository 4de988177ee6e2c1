"""Written tables in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, label: str) -> str:
    """A new path below spark.checkpoint.dir. Where that is unset a private folder serves in local mode, and a cluster is refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that the executors of {master} share")
        root = "file://" + tempfile.mkdtemp(prefix="quarry-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(rows: DataFrame, label: str, path: str | None = None, compression: str | None = None) -> DataFrame:
    """``rows`` written once and read back: what uses them twice computes them once, and a lost executor repeats nothing above."""
    path = path or folder(rows.sparkSession, label)
    rows.write.parquet(path, compression=compression)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
