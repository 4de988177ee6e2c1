import numpy as np
import pytest

from quarrystone.llm import embedding_dedup as e
from tests.llm import brute

SCHEMA = "vec_id long, embedding array<float>, label int, cell string, n long"


def table(seed=0, families=12, dim=6):
    rng = np.random.default_rng(seed)
    rows = []
    for f in range(families):
        base = rng.normal(size=dim)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((len(rows), (base + rng.normal(size=dim) * rng.choice([0, 0.05, 0.2])).astype(np.float32).tolist(), int(f % 3)))
    n = len(rows)
    odd = [None, [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] + [0.0] * (dim - 1), [None] + [1.0] * (dim - 1), [], [1.0, 0.0], [2.0, 0.0]]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)]
    rows += [(n + 20, rows[0][1], None), (n + 21, rows[0][1], rows[0][2]), (n + 22, [2 * x for x in rows[0][1]], rows[0][2])]
    return [(*r, "x", 1) for r in rows]


def expected(rows, threshold=e.THRESHOLD):
    good = {}
    for i, v, label, *_ in rows:
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = (label, np.array(v, float))

    def linked(a, b):
        (la, x), (lb, y) = good.get(a, (None, None)), good.get(b, (0, None))
        return x is not None and y is not None and la == lb and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold

    ids = [r[0] for r in rows]
    links = {a: sum(a != b and bool(linked(a, b)) for b in ids) for a in ids}
    return links, brute.components(ids, linked)


@pytest.mark.parametrize(("rows_per_cell", "block"), [(2000, 1024), (5, 4)])
def test_links_and_components(spark, monkeypatch, rows_per_cell, block):
    monkeypatch.setattr(e, "CELL_ROWS", rows_per_cell)
    monkeypatch.setattr(e, "BLOCK", block)
    rows = table()
    got = e.embedding_components(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    links, comps = expected(rows)
    assert {r.vec_id: r.n_links for r in got} == links
    assert {r.vec_id: r.component_id for r in got} == comps
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and sum(links.values()) > 20


def test_repeated_rows_and_nothing(spark):
    rows = [(1, [1.0, 2.0], 0, "x", 1), (1, [1.0, 2.0], 0, "x", 1), (3, [1.0, 2.0], 0, "x", 1), (None, [5.0, 0.0], 0, "x", 1)]
    got = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in e.embedding_components(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [("1", 2, 1, True), ("1", 2, 1, True), ("3", 2, 1, False), ("None", 0, None, True)]
    assert e.embedding_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repeated_ids_of_other_labels_and_vectors(spark):
    """A vec_id is no class: what has one id but another label or vector stays apart."""
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 1), (2, [1.0, 0.01], 0), (3, [1.0, 0.02], 1), (4, [1.0, 0.03], 1), (1, [0.0, 1.0], 1), (5, [0.01, 1.0], 1), (None, [0.0, 1.0], 1)]
    got = sorted((str(r.vec_id), r.n_links, r.component_id) for r in e.embedding_components(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)).collect())
    assert got == [("1", 1, 1), ("1", 2, 1), ("1", 2, 1), ("2", 1, 1), ("3", 2, 1), ("4", 2, 1), ("5", 2, 1), ("None", 2, 1)]


def test_dense_groups_over_many_tiles_and_cells(spark, monkeypatch):
    """Blocks, tiles and cells that cut one group of copies give the links and components of the whole."""
    for name, value in {"CELL_ROWS": 30, "BLOCK": 16, "TILE": 5}.items():
        monkeypatch.setattr(e, name, value)
    rng = np.random.default_rng(5)
    rows = [(i, (np.eye(5)[i % 2] + 0.09 * rng.normal(size=5)).tolist(), 0) for i in range(140)]
    got = e.embedding_components(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA.replace("float", "double")).repartition(3)).collect()
    links, comps = expected(rows)
    assert {r.vec_id: r.n_links for r in got} == links and {r.vec_id: r.component_id for r in got} == comps and max(links.values()) > 15


def test_block_links_in_tiles(monkeypatch):
    rng = np.random.default_rng(6)
    v = np.concatenate([np.eye(3)[k % 3] + 0.08 * rng.normal(size=(1, 3)) for k in range(50)])
    weights = rng.integers(1, 5, 50)
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    for first in (50, 20):
        linked = unit @ unit.T >= 0.98
        np.fill_diagonal(linked, False)
        if first < 50:
            linked[:first, :first] = linked[first:, first:] = False
        for tile in (7, 1024):
            monkeypatch.setattr(e, "TILE", tile)
            links, low = e.block_links(v, weights, first, 0.98)
            assert links.tolist() == (linked @ weights).tolist()
            assert dict(enumerate(low.tolist())) == brute.components(range(50), lambda a, b: linked[a, b])


def test_spherical_kmeans_finds_directions():
    rng = np.random.default_rng(2)
    axes = np.eye(4)
    v = np.concatenate([a + 0.05 * rng.normal(size=(30, 4)) for a in axes])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    c = e.spherical_kmeans(v, 4)
    assert np.allclose(np.linalg.norm(c, axis=1), 1) and np.allclose(np.sort((c @ axes.T).max(axis=0)), 1, atol=0.02)


def test_small_labels_go_through_cells(spark, monkeypatch):
    """Every label is cut into cells, those of a few vectors too, and a pair that lies across two cells is found."""
    placed = []
    plain = e._placed
    monkeypatch.setattr(e, "_placed", lambda *a: placed.append(plain(*a)) or placed[-1])
    rng = np.random.default_rng(11)
    rows = [(i, (np.array([np.cos(a := 0.004 * i), np.sin(a), 0.0, 0.0]) + 0.001 * rng.normal(size=4)).tolist(), i // 200) for i in range(300)] + [(999, [1.0, 2.0, 3.0, 4.0], 7)]
    got = e.embedding_components(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA.replace("float", "double")).repartition(3)).collect()
    links, comps = expected(rows)
    assert {r.vec_id: r.n_links for r in got} == links and {r.vec_id: r.component_id for r in got} == comps
    cells = {r["label"]: r["cells"] for r in placed[0].filter("home").groupBy("label").agg(e.F.count_distinct("cell").alias("cells")).collect()}
    assert cells == {"0": 2, "1": 2, "7": 1} and placed[0].filter("NOT home").count() > 0


def test_components_of_any_magnitude(spark):
    rows = [(1, [1e300, 1e300], 0), (2, [1e-300, 1.01e-300], 0), (3, [3.0, -3.0], 0), (4, [-1e308, 1e308], 0), (5, [1e308, -1.1e308], 0), (6, [5e-324, 0.0], 0), (7, [2.0, 0.1], 0)]
    got = e.embedding_components(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA.replace("float", "double"))).collect()
    assert sorted((r.vec_id, r.component_id) for r in got) == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 3), (6, 6), (7, 6)]
