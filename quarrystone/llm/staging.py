"""Shared-storage staging: cut lineage with written tables that every executor can read."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def stage_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a private one only where that is unset and all runs in one process.

    On a cluster every executor would write to a disk of its own, so there a missing setting fails.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that the executors of {master} share")
        root = "file://" + tempfile.mkdtemp(prefix="quarry-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


_PATHS: list[str] = []


def new_path(spark: SparkSession, label: str) -> str:
    path = f"{stage_root(spark)}/quarry-{label}-{uuid.uuid4().hex[:12]}"
    _PATHS.append(path)
    return path


def clear(spark: SparkSession) -> None:
    """Remove every folder this process has staged, once their results have been written elsewhere."""
    while _PATHS:
        drop_stage(spark, _PATHS.pop())


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The copy is durable: a lost executor never forces the upstream plan to run again.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stage_path = path
    return out


def release(df: DataFrame) -> None:
    """Give back the storage of a staged frame that no later plan reads."""
    drop_stage(df.sparkSession, df._stage_path)


def drop_stage(spark: SparkSession, path: str) -> None:
    """Remove a staged folder that no later plan reads."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs meanwhile passes Python some ``most`` bytes at once, unless the session has a size set: a task holds a batch several times over, in the JVM too."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key, None) is not None
    if not own:
        spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if not own:
            spark.conf.unset(key)


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names``, with underscores behind those that a caller's columns already have."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
