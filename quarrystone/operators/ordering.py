"""Ordinals, first and last per key, prefixes before errors, limits and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


SHARD_ROWS = 250_000
DRAWN = 16
STRIDE = 64


def path_ordinal(files: DataFrame, path: str = "rel_path", depth: int = 3, name: str = "ordinal", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """1-based position in path-component order without one global window.

    Rows are numbered inside ranges of directories (the first ``depth`` components, a prefix of the sort key), and a
    range's offset is a running sum over ranges, of which there are few against files. A directory is cut at
    every ``DRAWN``-th path of a sample chosen by hash, so that a range has about ``shard_rows`` rows, however many files lie
    side by side. The sample only cuts: every row is numbered.
    """
    parts = F.split(path, "/")
    placed = files.withColumn("_shard", F.slice(parts, 1, depth))
    drawn = placed.filter(F.pmod(F.xxhash64(path), F.lit(max(1, shard_rows // DRAWN))) == 0)
    sample = drawn.groupBy("_shard").agg(F.sort_array(F.collect_list(parts)).alias("_drawn")).filter(F.size("_drawn") > DRAWN)
    every = F.sequence(F.lit(DRAWN + 1), F.size("_drawn"), F.lit(DRAWN))
    cuts = sample.select("_shard", F.transform(every, lambda i: F.element_at("_drawn", i)).alias("_all"))
    # In two steps: among every ``STRIDE``-th cut, then among those behind the last one passed.
    groups = F.transform(F.sequence(F.lit(1), F.size("_all"), F.lit(STRIDE)), lambda i: F.slice("_all", i, STRIDE))
    cuts = cuts.select("_shard", groups.alias("_cuts"))
    before = lambda some: F.size(F.filter(some, lambda cut: cut <= parts))
    group = before(F.transform("_cuts", lambda g: g[0]))
    passed = F.when(F.col("_cuts").isNull() | (group == 0), F.lit(0)).otherwise((group - 1) * STRIDE + before(F.element_at("_cuts", group)))
    shard = placed.join(cuts, "_shard", "left").withColumn("_range", passed).drop("_cuts")
    sizes = shard.groupBy("_shard", "_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_shard", "_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_shard", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_shard", "_range").orderBy(parts)
    numbered = shard.withColumn("_row", F.row_number().over(inside)).join(offsets, ["_shard", "_range"])
    return numbered.withColumn(name, F.col("_row") + F.col("_before")).drop("_shard", "_range", "_row", "_before")


def keep_first(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of every key; rows with a null or empty key go."""
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.filter(there).withColumn("_turn", turn).filter("_turn = 1").drop("_turn")


def keep_last(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of every key by ``order`` (given descending)."""
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_turn", turn).filter("_turn = 1").drop("_turn")


def before_first_error(rows: DataFrame, group: list[str], position: str, bad: Column) -> DataFrame:
    """Each group's rows ahead of its first bad one."""
    frame = Window.partitionBy(*group).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_bad", F.max(F.when(bad, 1).otherwise(0)).over(frame)).filter("_bad = 0").drop("_bad")


def until_errors(rows: DataFrame, group: list[str], order: list[str], bad: Column, most: int) -> DataFrame:
    """Each group's rows up to and including its ``most``-th bad one by ``order`` (which tells a group's rows apart).

    Only the first ``most`` bad rows of a group are ranked, of each task's rows first; the rest meet that one by a join.
    """
    turn = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    place = F.struct(*order)
    ends = rows.filter(bad).withColumn("_turn", turn).filter(F.col("_turn") <= most).filter(F.col("_turn") == most)
    ends = ends.select(*(F.col(g).alias(f"_{g}") for g in group), place.alias("_end"))
    same = F.lit(True)
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_{g}"))
    joined = rows.join(ends, same, "left").filter(F.col("_end").isNull() | (place <= F.col("_end")))
    return joined.drop("_end", *(f"_{g}" for g in group))


def offset_limit(rows: DataFrame, order: list[str], start: int, count: int | None) -> DataFrame:
    """Rows from zero-based ``start`` on; None is no limit."""
    out = rows.orderBy(*order).offset(start)
    return out if count is None else out.limit(count)


def seeded_sample(rows: DataFrame, key: str, count: int, seed: int) -> DataFrame:
    """At most ``count`` rows chosen by a seeded digest of the key, the same on every cluster."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}/"), F.col(key).cast("string")).cast("binary")), key).limit(count)


def first_n(rows: DataFrame, group: list[str], order: list[str], most: int) -> DataFrame:
    """At most ``most`` rows a group."""
    turn = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("_turn", turn).filter(F.col("_turn") <= most).drop("_turn")
