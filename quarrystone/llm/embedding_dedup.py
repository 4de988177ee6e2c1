"""Operator 10, embedding near-dedup: spherical k-means cells, blocked cosines inside cells.

Vectors are compared when labels are equal and not null (and dimensions equal). A vector that is null,
zero, or holds null or non-finite components links with nothing. Rows equal in label and vector (128-bit hash) are one
class with a count and a number of its own, so a vec_id that repeats with other vectors or labels joins nothing.
The vectors of each label, however few, are cut into cells: one for every ``CELL_ROWS`` classes, ``LEAST_CELLS`` at least and ``CELLS`` at most, by
spherical k-means in the tasks on a sample bounded by the number of cells (about ``PER_CELL`` vectors each). Every vector is indexed: centroids
travel to their label's vectors, dealt in shares of ``SHARE`` rows, and a vector lives in the
cell of its most similar centroid c and also visits each later cell c' with v.(c - c') <= d |c - c'|, where d is
the chord of the threshold angle. Two vectors within that chord always meet in the later of their cells, so no
link is lost. A cell is compared in blocks of about ``BLOCK`` rows, every two blocks once, visitors only with those that
live there; a pair of blocks gives each vector's links as one count and its components as edges to their least members, never
the pairs. A cell of n vectors costs n(n + 1) / 2 products, and each vector travels n / ``BLOCK`` times, as it came (single
precision); products are in double.

Output, one row per input row: vec_id, n_links, component_id, kept (vec_id = component_id; true for a null
vec_id, which is in no component of its own). Further columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrystone.llm import graph, staging

THRESHOLD = 0.98
CELLS = 1024
LEAST_CELLS = 2
CELL_ROWS = 8192
PER_CELL = 20
SHARE = 65536
BLOCK = 8192
TILE = 1024
ROUNDS = 12


def spherical_kmeans(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit ``vectors``; starts from far-apart rows, so it needs no seed."""
    k = min(k, len(vectors))
    picked = [0]
    near = vectors @ vectors[0]
    for _ in range(k - 1):
        picked.append(int(np.argmin(near)))
        near = np.maximum(near, vectors @ vectors[picked[-1]])
    centroids = vectors[picked].copy()
    for _ in range(rounds):
        home = np.argmax(vectors @ centroids.T, axis=1)
        total = np.zeros_like(centroids)
        np.add.at(total, home, vectors)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        centroids = np.where(size > 0, total / np.where(size > 0, size, 1), centroids)
    return centroids


def _valid(vector):
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & (F.size(vector) > 0) & sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows in double, each scaled by a power of two so that no norm passes the range of doubles."""
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, initial=0))[1][:, None])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch]]:
    """(key, rows) of the runs of equal keys in the first column."""
    for batch in batches:
        keys = np.array(batch.column(0).to_pylist(), object)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for i, j in zip(cuts, cuts[1:]):
            if i < j:
                yield keys[i], batch.slice(i, j - i)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Centroids (label, dim, cell, embedding) of each label's drawn rows (key, label, dim, k, embedding), sorted by key."""
    key, held = None, []

    def give() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        unit = _matrix(rows.column(4))
        centroids = spherical_kmeans(unit / np.linalg.norm(unit, axis=1, keepdims=True), rows.column(3)[0].as_py())
        n, kind = len(centroids), rows.schema.field(4).type
        return pa.RecordBatch.from_arrays([rows.column(1).slice(0, 1).take(pa.array([0] * n)), rows.column(2).take(pa.array([0] * n)), pa.array(range(n), pa.int64()), pa.array(centroids.tolist(), kind)], ["label", "dim", "cell", "embedding"])

    for now, run in _runs(batches):
        if now != key and held:
            yield give()
            held = []
        key = now
        held.append(run)
    if held:
        yield give()


def _place(threshold: float):
    """Rows (key, class, n, label, dim, embedding), centroids first (n is null, class is the cell), to the cell that each lives in and those that it visits."""
    chord = math.sqrt(2 - 2 * threshold) + 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, centroids = None, []
        for now, rows in _runs(batches):
            if now != key:
                key, centroids = now, []
            fitted = rows.column(2).is_null()
            some = rows.filter(fitted)
            if len(some):
                centroids += list(zip(some.column(1).to_pylist(), some.column(5).to_pylist()))
            rows = rows.filter(pa.compute.invert(fitted))
            if not len(rows):
                continue
            if centroids:
                c = np.array([v for _, v in sorted(centroids)], np.float64)
                v = _matrix(rows.column(5))
                v /= np.linalg.norm(v, axis=1, keepdims=True)
                near = v @ c.T
                home = np.argmax(near, axis=1)
                norm = (c * c).sum(axis=1)
                apart = np.sqrt(np.maximum(0, norm[:, None] + norm[None, :] - 2 * (c @ c.T)))
                visit = near[np.arange(len(v)), home][:, None] - near <= chord * apart[home] + 1e-9
                at, cell = np.nonzero(visit & (np.arange(len(c)) >= home[:, None]))
                lives = home[at] == cell
            else:
                at, cell, lives = np.arange(len(rows)), np.zeros(len(rows)), np.ones(len(rows), bool)
            for i in range(0, len(at), 4096):
                part = rows.take(pa.array(at[i : i + 4096]))
                columns = [pa.array(cell[i : i + 4096].astype(np.int32)), pa.array(lives[i : i + 4096]), *(part.column(x) for x in (3, 4, 1, 2, 5))]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "home", "label", "dim", "class", "n", "embedding"])

    return run


def _placed(classes: DataFrame, threshold: float) -> DataFrame:
    """(cell, home, label, dim, class, n, embedding) of every class in the cells that it lives in and visits."""
    tasks, group = staging.shuffle_partitions(classes.sparkSession), ["label", "dim"]
    sizes = classes.groupBy(*group).agg(F.count("*").alias("size")).withColumn("k", F.greatest(F.lit(LEAST_CELLS), F.least(F.lit(CELLS), F.ceil(F.col("size") / CELL_ROWS))).cast("int"))
    # Staged, so that joins are of plain exchanges and the rows of a large label can be split.
    sizes = staging.staged(sizes.withColumn("shares", F.ceil(F.col("size") / SHARE)), "sizes")
    named = lambda *more: F.concat_ws("/", *group, *more).alias("key")
    share = F.least(F.lit(1.0), 1.2 * PER_CELL * F.col("k") / F.col("size"))
    drawn = classes.join(sizes, group).filter(F.pmod("one", F.lit(1 << 20)) < share * (1 << 20))
    drawn = drawn.select(named(), *group, "k", "embedding", "one", "class").repartition(tasks, "key").sortWithinPartitions("key", "one", "class").drop("one", "class")
    kind = classes.schema["embedding"].dataType
    fitted = staging.staged(drawn.mapInArrow(_fit, T.StructType([classes.schema["label"], classes.schema["dim"], T.StructField("cell", T.LongType()), T.StructField("embedding", kind)])), "centroids")
    centroids = fitted.join(sizes, group).withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
    centroids = centroids.select(named("share"), F.col("cell").alias("class"), F.lit(None).cast("long").alias("n"), *group, "embedding")
    vectors = classes.join(sizes, group).select(named(F.pmod(F.xxhash64("class"), F.col("shares"))), "class", "n", *group, "embedding")
    dealt = vectors.union(centroids).repartition(tasks, "key").sortWithinPartitions("key", F.asc_nulls_first("n"))
    fields = [T.StructField("cell", T.IntegerType()), T.StructField("home", T.BooleanType()), *(classes.schema[c] for c in ("label", "dim", "class", "n", "embedding"))]
    return staging.staged(dealt.mapInArrow(_place(threshold), T.StructType(fields)), "cells")


def _least(nodes: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least index that each of ``nodes`` indices reaches over the edges (a, b)."""
    low = np.arange(nodes)
    while True:
        least = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def block_links(vectors: np.ndarray, weights: np.ndarray, first: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row the weight linked with it, and the least row that it reaches.

    The ``first`` rows are compared with the others, or with each other where there are no others. Tiles bound the
    pairs that are held at a time, however many link.
    """
    n, unit = len(vectors), np.linalg.norm(vectors, axis=1)
    links = np.zeros(n, np.int64)
    alone = first == n
    left: list[np.ndarray] = [np.empty(0, np.int64)]
    right: list[np.ndarray] = [np.empty(0, np.int64)]
    for s in range(0, first, TILE):
        own = slice(s, min(s + TILE, first))
        for t in range(s if alone else first, n, TILE):
            other = slice(t, min(t + TILE, n))
            linked = (vectors[own] @ vectors[other].T) / (unit[own, None] * unit[None, other]) >= threshold
            if s == t:
                np.fill_diagonal(linked, False)
            if not linked.any():
                continue
            links[own] += linked @ weights[other]
            if s != t:
                links[other] += weights[own] @ linked
            i, j = np.nonzero(linked)
            i, j = i + s, j + t
            nodes, index = np.unique(np.concatenate([i, j]), return_inverse=True)
            low = nodes[_least(len(nodes), index[: len(i)], index[len(i) :])]
            left.append(nodes[low != nodes])
            right.append(low[low != nodes])
    return links, _least(n, np.concatenate(left), np.concatenate(right))


def _compare(threshold: float):
    """Links of rows (key, part, class, n, embedding), sorted by key: of parts 0 and 1, or inside part 0 where the key starts with a point."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def give() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            part = table.column(1).to_numpy()
            order = np.argsort(part, kind="stable")
            first = int((part == 0).sum())
            if not first or (first == len(part)) != key.startswith("."):
                return
            ids, n, v = table.column(2).to_numpy()[order], table.column(3).to_numpy()[order], _matrix(table.column(4))[order]
            links, low = block_links(v, n, first, threshold)
            keep = links > 0
            if keep.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[keep], pa.int64()), pa.array(ids[low[keep]], pa.int64()), pa.array(links[keep], pa.int64())], ["a", "b", "links"])

        for batch in batches:
            keys = np.array(batch.column(0).to_pylist(), object)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if keys[i] != key and held:
                    yield from give()
                    held = []
                key = keys[i]
                held.append(batch.slice(i, j - i))
        if held:
            yield from give()

    return run


def _block_pairs(placed: DataFrame) -> DataFrame:
    """(key, part, class, n, embedding): every two blocks of those that live in a cell once, and each with every block of visitors."""
    cell = ["label", "dim", "cell"]
    blocks = lambda own: F.ceil(F.count_if(own) / BLOCK)
    sized = placed.groupBy(*cell).agg(blocks(F.col("home")).alias("homes"), blocks(~F.col("home")).alias("guests"))
    dealt = placed.join(sized, cell).withColumn("block", F.pmod(F.xxhash64("class"), F.when(F.col("home"), F.col("homes")).otherwise(F.col("guests"))))
    block, homes, guests = F.col("block"), F.col("homes"), F.col("guests")
    numbers = lambda n: F.when(n > 0, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(F.array().cast("array<long>"))
    name = lambda kind, i, j: F.concat_ws("/", kind, *cell, i, j)
    pair = lambda key, part: F.struct(key.alias("key"), part.cast("int").alias("part"))
    lived = F.transform(numbers(homes), lambda o: pair(name(F.when(o == block, F.lit(".")).otherwise(F.lit("")), F.least(o, block), F.greatest(o, block)), block > o))
    hosted = F.transform(numbers(guests), lambda o: pair(name(F.lit("g"), block, o), F.lit(0)))
    visited = F.transform(numbers(homes), lambda o: pair(name(F.lit("g"), o, block), F.lit(1)))
    pairs = F.when(F.col("home"), F.concat(lived, hosted)).otherwise(visited)
    return dealt.select(F.inline(pairs), "class", "n", "embedding")


def embedding_components(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors(vec_id, embedding, label)``."""
    spark = vectors.sparkSession
    element = vectors.schema["embedding"].dataType.elementType
    kind = T.ArrayType(element if isinstance(element, T.FloatType) else T.DoubleType())
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind), F.col("label").cast("string"))
    valid = _valid(F.col("embedding"))
    key = ["one", "two"]
    sound = rows.filter(valid).withColumn("one", F.xxhash64("label", "embedding")).withColumn("two", F.xxhash64(F.lit(1), "label", "embedding"))
    grouped = sound.groupBy(*key).agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    numbered = grouped.filter(F.col("least").isNotNull()).select("label", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("class"), "n", "embedding", "least", *key)
    classes = staging.staged(numbered, "classes")

    met = _block_pairs(_placed(classes, threshold)).repartition(staging.shuffle_partitions(spark), "key").sortWithinPartitions("key")
    found = staging.staged(met.mapInArrow(_compare(threshold), "a long, b long, links long"), "links")

    links = found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = staging.staged(graph.components(found.select("a", "b")).join(classes.select(F.col("class").alias("node"), "least"), "node"), "roots")
    lows = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = links.join(roots.join(lows, "root").select(F.col("node").alias("class"), "component_id"), "class")
    named = classes.select("class", "n", "least", *key).join(linked, "class", "left")
    # Staged, so that the join is of plain exchanges and the rows of a common vector can be split.
    known = staging.staged(named.select(*key, (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")), "known")
    linked = sound.select("vec_id", *key).join(known, key, "left").select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "component_id")
    alone = rows.filter(~valid).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all embeddings."""
    return embedding_components(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
