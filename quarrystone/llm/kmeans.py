"""Operator 13, centroid clustering: delta Lloyd on integer vectors.

A vector with exactly ``dim`` components, none null or non-finite, is kept as the integers floor(1024 * x). Centroids start as the
``k`` kept vectors with the smallest SHA-256 of ``3:<vec_id>``. Owner and squared distance of every vector are persisted with it;
a round rewrites that table and no vector is shuffled. In a round a vector whose centroid stayed where it was is compared with
the centroids that moved only, any other with all of them; ties go to the smaller number. Vectors that changed their owner are
then read back and give signed sums, one row a task and centroid: minus to the old owner, plus to the new. These
transfers, summed exactly, change the global sums, from which each centroid is floor(sum / count); one without vectors stays.
Only sums and counts (``k`` times ``dim`` numbers) reach the driver. When no centroid moves, the rounds that are
left would change nothing and aren't run.

Distances are exact: by a product of doubles where all components lie within 2**22, so that nothing is rounded, else in 64-bit
integers. A distance that could pass 64 bits (a component beyond 2**27, |x| of some 131,000) fails with the vec_id. A vec_id that repeats is clustered row by row;
of equal hashes the lesser vector comes first. Rows without a vec_id are clustered and never start a centroid. With fewer kept
vectors than ``k`` there are fewer centroids; without any, and for an empty table, no row. Only vec_id and embedding are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import staging

K = 8
DIM = 64
ROUNDS = 10
SCALE = 1024
EXACT = 1 << 22
LARGEST = 1 << 27
STATE = "vec_id long, v array<int>, owner int, distance long, was int, moved boolean"


def integer_vectors(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """(vec_id, v) of the kept rows of ``vectors(vec_id, embedding)``."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    kept = vectors.filter((F.size(x) == dim) & sound).select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
    # The cut of the exponent: floor() of a huge double would not fit a long, and is refused all the same.
    within = F.forall("x", lambda y: F.abs(y) < LARGEST // SCALE)
    fail = F.raise_error(F.concat(F.lit("a component is too large for 64-bit distances: vec_id "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))))
    whole = F.transform("x", lambda y: F.floor(y * SCALE).cast("int"))
    return kept.select("vec_id", F.when(within, whole).otherwise(fail.cast("array<int>")).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def distances(v: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to centroids, in 64-bit integers."""
    if max(np.abs(v).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT and v.shape[1] <= 256:
        # Every partial sum is an integer below 2**53.
        cross = (v.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64)
        return (v * v).sum(axis=1)[:, None] - 2 * cross + (centroids * centroids).sum(axis=1)[None, :]
    return np.stack([((v - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def reassign(v: np.ndarray, owner: np.ndarray, distance: np.ndarray, centroids: np.ndarray, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New owners and distances: against the changed centroids, and against all where the own one changed.

    An owner of -1 (none yet) counts as changed.
    """
    owner, distance = owner.copy(), distance.copy()
    whole = (owner < 0) | changed[np.maximum(owner, 0)]
    if whole.any():
        d = distances(v[whole], centroids)
        owner[whole] = d.argmin(axis=1)
        distance[whole] = d[np.arange(len(d)), owner[whole]]
    rest, moved = ~whole, np.flatnonzero(changed)
    if rest.any() and len(moved):
        d = distances(v[rest], centroids[moved])
        near = d.argmin(axis=1)
        least, number = d[np.arange(len(d)), near], moved[near]
        better = (least < distance[rest]) | ((least == distance[rest]) & (number < owner[rest]))
        at = np.flatnonzero(rest)[better]
        owner[at], distance[at] = number[better], least[better]
    return owner, distance


def _assign(centroids: np.ndarray, changed: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            was, before = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            owner, distance = reassign(_matrix(batch.column(1), centroids.shape[1]), was.astype(np.int64), before, centroids, changed)
            columns = [batch.column(0), batch.column(1), pa.array(owner, pa.int32()), pa.array(distance, pa.int64()), pa.array(was, pa.int32()), pa.array(owner != was)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "owner", "distance", "was", "moved"])

    return run


def _transfers(k: int, dim: int):
    """A task's signed sums and counts, one row a centroid that gains or loses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, seen = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), np.zeros(k, bool)
        for batch in batches:
            v, owner, was = _matrix(batch.column(0), dim), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for number in range(k):
                gained, lost = owner == number, was == number
                if gained.any() or lost.any():
                    seen[number] = True
                    sums[number] += v[gained].sum(axis=0) - v[lost].sum(axis=0)
                    counts[number] += int(gained.sum()) - int(lost.sum())
        some = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))], ["cluster", "count", "sums"])

    return run


def transfers(state: DataFrame, k: int, dim: int) -> tuple[list[int], list[list[int]]]:
    """What a round moves: the change of each centroid's count and sums, as exact integers."""
    moved = state.filter("moved").select("v", "owner", "was").mapInArrow(_transfers(k, dim), "cluster int, count long, sums array<long>")
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    each = moved.select("cluster", F.posexplode(F.array_append("sums", F.col("count"))).alias("at", "x"))
    counts, sums = [0] * k, [[0] * dim for _ in range(k)]
    for r in each.groupBy("cluster", "at").agg(total("x").alias("x")).collect():
        if r["at"] < dim:
            sums[r["cluster"]][r["at"]] = int(r["x"])
        else:
            counts[r["cluster"]] = int(r["x"])
    return counts, sums


def starts(kept: DataFrame, k: int) -> np.ndarray:
    """The vectors of the smallest hashes, in their order."""
    named = kept.filter(F.col("vec_id").isNotNull()).withColumn("h", F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256))
    return np.array([r["v"] for r in named.orderBy("h", "v").limit(k).select("v").collect()], np.int64)


def delta_lloyd(vectors: DataFrame, k: int = K, dim: int = DIM, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, v, owner, distance) under the final centroids, and these."""
    kept = staging.staged(integer_vectors(vectors, dim), "vectors")
    centroids = starts(kept, k)
    k = len(centroids)
    state = kept.select("vec_id", "v", F.lit(-1).alias("owner"), F.lit(0).cast("long").alias("distance"), F.lit(-1).alias("was"), F.lit(False).alias("moved"))
    if not k:
        return state.filter("false").select("vec_id", "v", "owner", "distance"), centroids.reshape(0, dim)
    counts, sums = [0] * k, [[0] * dim for _ in range(k)]
    changed, last = np.ones(k, bool), kept
    for turn in range(rounds + 1):
        state = staging.staged(state.mapInArrow(_assign(centroids, changed), STATE), "assigned")
        staging.release(last)
        last = state
        if turn == rounds:
            break
        more, add = transfers(state, k, dim)
        counts = [a + b for a, b in zip(counts, more)]
        sums = [[a + b for a, b in zip(x, y)] for x, y in zip(sums, add)]
        new = np.array([[s // n for s in x] if n else c for x, n, c in zip(sums, counts, centroids.tolist())], np.int64)
        changed = (new != centroids).any(axis=1)
        centroids = new
        if not changed.any():
            break
    return state.select("vec_id", "v", "owner", "distance"), centroids


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster all embeddings."""
    state, centroids = delta_lloyd(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    digests = [(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    sizes = staging.staged(state.groupBy(F.col("owner").alias("cluster")).agg(total("distance").alias("cluster_inertia")), "inertia")
    whole = sizes.agg(total("cluster_inertia").alias("inertia")).first()["inertia"]
    # One row a centroid.
    known = spark.createDataFrame(digests, "cluster int, centroid_sha256 string").join(sizes, "cluster").select("cluster", F.col("cluster_inertia").cast("long").alias("cluster_inertia"), "centroid_sha256")
    out = state.select("vec_id", F.col("owner").alias("cluster"), "distance").join(F.broadcast(known), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole).cast("long").alias("inertia"), "centroid_sha256")


def _sql(rounds: int = ROUNDS) -> str:
    """Plain Lloyd, round by round: each assigns all vectors against all centroids."""
    steps = [
        f"""v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda y: floor({SCALE} * y::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = {DIM}
),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id::VARCHAR)) - 1 AS c, x FROM v QUALIFY c < {K}
)"""
    ]
    near = "SELECT vec_id, any_value(v.x) AS x, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT vec_id, v.x, c, list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM v, c{0} m) v GROUP BY vec_id"
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED ({near.format(i)})")
        if i < rounds:
            floor = "((s - ((s % n) + n) % n) // n)::BIGINT"
            means = f"SELECT c, list({floor} ORDER BY pos) AS x FROM (SELECT c, pos, sum(y) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS y, generate_subscripts(x, 1) AS pos FROM a{i}) GROUP BY c, pos) GROUP BY c"
            steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(m.x, c{i}.x) AS x FROM c{i} LEFT JOIN ({means}) m ON c{i}.c = m.c)")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(m.x, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} m ON a.c = m.c
"""


OP13_SQL = _sql()
