"""Nearest vectors against a plain loop."""

import random

import pytest

from quarrystone.operators import retrieval


def _plain(queries, rows, k):
    out = set()
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i, q in queries:
        cosines = [(-round(dot(q, v) / (dot(q, q) ** 0.5 * dot(v, v) ** 0.5), 9), j) for j, v in rows if j != i and len(v) == len(q)]
        out |= {(i, j, rank, -c) for rank, (c, j) in enumerate(sorted(cosines)[:k], 1)}
    return out


@pytest.mark.parametrize("blocks", [(1024, 16384), (7, 40)])
def test_topk(spark, monkeypatch, blocks):
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(retrieval, "VECTOR_BLOCK", blocks[1])
    draw = random.Random(3)
    rows = [(i, [float(draw.randint(-3, 3)) for _ in range(5)] + [1.0]) for i in range(200)]
    # A third are copies of one vector, some have another dimension, the last three have fewer rows than k.
    rows += [(200 + i, [1.0, 2.0, 0.0, -0.0, 1.0, 1.0]) for i in range(100)] + [(300 + i, [float(i), 1.0]) for i in range(3)]
    odd = [(400, None), (401, [0.0] * 6), (402, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (403, [float("nan")] + [1.0] * 5), (None, [1.0] * 6)]
    vectors = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, rank string").repartition(3)
    asked = vectors.filter("vec_id % 5 = 0")
    got = retrieval.embedding_topk(asked, vectors, 4)
    assert sorted(got.columns) == ["cosine", "query_id", "rank", "vec_id"]
    found = {(r.query_id, r.vec_id, r["rank"], round(r.cosine, 9)) for r in got.collect()}
    assert found == _plain([r for r in rows if r[0] % 5 == 0], rows, 4)
    assert retrieval.embedding_topk(asked.limit(0), vectors, 4).count() == 0
    assert retrieval.embedding_topk(asked, vectors.limit(0), 4).count() == 0
