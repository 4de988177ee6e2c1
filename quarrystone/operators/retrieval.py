"""Nearest vectors of a stated query set."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 1024
VECTOR_BLOCK = 16384
TILE = 128


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)


def _comparable(vector: Column) -> Column:
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(sound & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = flat.reshape(len(column), -1)
    # Adding zero turns -0.0 into 0.0, so that equal vectors have equal bytes.
    return rows / np.linalg.norm(rows, axis=1, keepdims=True) + 0.0


def _block_best(k: int):
    """The k best of a block of vectors for each query of a block; vectors that are equal score the same."""

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        found_q, found_v = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        if queries.num_rows and vectors.num_rows:
            vectors = vectors.take(pa.array(np.argsort(vectors["vec_id"].to_numpy(), kind="stable")))
            ids, asked = vectors["vec_id"].to_numpy(), queries["query_id"].to_numpy()
            v, q = _unit(vectors["embedding"]), _unit(queries["embedding"])
            _, first, kind = np.unique(v.view(np.dtype((np.void, v.shape[1] * 8))).ravel(), return_index=True, return_inverse=True)
            for s in range(0, len(q), TILE):
                own = asked[s : s + TILE]
                score = (q[s : s + TILE] @ v[first].T)[:, kind]
                score[own[:, None] == ids[None, :]] = -np.inf
                least = np.partition(score, -k, axis=1)[:, -k] if k < score.shape[1] else np.full(len(own), -2.0)
                i, j = np.nonzero((score >= least[:, None]) & (score > -2.0))
                order = np.lexsort((j, -score[i, j], i))
                i, j = i[order], j[order]
                turn = np.arange(len(i)) - np.searchsorted(i, i)
                found_q.append(own[i[turn < k]])
                found_v.append(j[turn < k])
        at = np.concatenate(found_v)
        best = vectors.select(["vec_id", "embedding"]).take(pa.array(at, pa.int64()))
        return best.append_column("query_id", pa.array(np.concatenate(found_q), pa.int64()))

    return run


def embedding_topk(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """The k most similar other vectors of every query (ties by id): query_id, vec_id, cosine, rank.

    Queries in blocks of about ``QUERY_BLOCK`` meet vectors in blocks of about ``VECTOR_BLOCK`` of the same dimension; a pair
    of blocks gives k rows a query, whose cosines are computed again and ranked. So a vector travels once for every
    block of queries, a query once for every block of vectors, nothing is broadcast, and a task holds two blocks. Vectors
    that are null, zero or hold null or non-finite components, and rows without an id, are neither asked nor found. A row with the
    query's id is never its neighbour. Query ids are taken to be unique: rows that share one are ranked as one query. Further columns are ignored.
    """
    ids = lambda name: F.col("vec_id").cast("long").alias(name)
    sound = lambda rows, name: rows.filter(_comparable(F.col("embedding"))).select(ids(name), F.col("embedding").cast("array<double>")).filter(F.col(name).isNotNull())
    q, v = sound(queries, "query_id"), sound(vectors, "vec_id")
    blocks = lambda rows, size: max(1, -(-rows.count() // size))
    n_q, n_v = blocks(q, QUERY_BLOCK), blocks(v, VECTOR_BLOCK)
    block = lambda name, n: F.pmod(F.xxhash64(name, "embedding"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    key = ["dim", "q_block", "v_block"]
    left = q.withColumns({"dim": F.size("embedding"), "q_block": block("query_id", n_q)}).withColumn("v_block", every(n_v))
    right = v.withColumns({"dim": F.size("embedding"), "v_block": block("vec_id", n_v)}).withColumn("q_block", every(n_q))
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_block_best(k), "vec_id long, embedding array<double>, query_id long")
    both = near.join(q.withColumnRenamed("embedding", "_q"), "query_id")
    norm = lambda x: F.sqrt(dot(F.col(x), F.col(x)))
    value = dot(F.col("_q"), F.col("embedding")) / (norm("_q") * norm("embedding"))
    turn = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id"))
    return both.select("query_id", "vec_id", value.alias("cosine")).withColumn("rank", turn).filter(F.col("rank") <= k)
