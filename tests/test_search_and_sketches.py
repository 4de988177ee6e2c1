import math
import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrystone.operators import links, metrics, ocr, search
from quarrystone.sources import sinks


def texts(n=400, seed=1):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Straße", "x1", "a", "rare"] + [f"w{i}" for i in range(20)]
    make = lambda: rng.choice([" ", ", ", "-"]).join(rng.choice(vocabulary[: rng.choice([3, 5, 26])]) for _ in range(rng.randint(0, 40)))
    return [(i * 7 - 300, rng.choice(["", "  ", None]) if i % 50 == 0 else make()) for i in range(n)] + [(None, "the of"), (10**12, "of the of the of")]


def words(text):
    return [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]


@pytest.fixture(scope="module")
def index(spark):
    search_blocks, search.BLOCK_DOCS = search.BLOCK_DOCS, 64
    yield search.build(spark.createDataFrame([(i, t, 1) for i, t in texts()], "doc_id long, text string, block int").repartition(4))
    search.BLOCK_DOCS = search_blocks


@pytest.mark.parametrize("asked", ["of the", "the", "the the", "of-the, OF", "straße x1", "w1 w2 w3", "unseen the", "", "?!", "of the of"])
def test_phrases_equal_a_scan(index, asked):
    q = words(asked)
    want = {}
    for i, t in texts():
        w = words(t)
        at = [k for k in range(len(w) - len(q) + 1) if q and w[k : k + len(q)] == q]
        if at and i is not None:
            want[i] = (len(at), at[0])
    assert {r.doc_id: (r.occurrences, r.first) for r in search.phrase(index, asked).collect()} == want


@pytest.mark.parametrize(("asked", "k"), [("the of", 5), ("rare w3 the", 12), ("w7", 3), ("unseen", 4), ("the the the", 1000), ("", 3)])
def test_top_documents_equal_a_scan(index, asked, k):
    docs = [(i, words(t)) for i, t in texts() if i is not None]
    mean = sum(len(w) for _, w in docs) / len(docs)
    score = {}
    for t in set(words(asked)):
        df = sum(t in w for _, w in docs)
        for i, w in docs:
            if tf := w.count(t):
                score[i] = score.get(i, 0) + math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(w) / mean))
    want = sorted((-round(s, 6), i) for i, s in score.items())[:k]
    got = search.top(index, asked, k).orderBy("rank").collect()
    assert [r.rank for r in got] == list(range(1, len(want) + 1)) and [r.doc_id for r in got] == [i for _, i in want]
    assert all(abs(r.score + s) < 2e-6 for r, (s, _) in zip(got, want))


def test_hot_terms_are_split_and_hopeless_blocks_stay_shut(spark, monkeypatch, index):
    assert index.blocks.filter("term = 'the'").count() > 30 and index.blocks.agg(F.max("n_docs")).first()[0] <= 64
    monkeypatch.setattr(search, "FIRST_BLOCKS", 1)
    opened = []
    plain = search._scored
    monkeypatch.setattr(search, "_scored", lambda i, w, blocks, weight: opened.append(blocks.count()) or plain(i, w, blocks, weight))
    rare = search.build(spark.createDataFrame([(i * 64, "needle needle" if i == 7 else "hay " * 30 + "needle") for i in range(40)], "doc_id long, text string"))
    assert [r.doc_id for r in search.top(rare, "needle", 1).collect()] == [448] and opened == [1, 1]


def test_words_are_grouped_before_they_are_dealt(spark, monkeypatch):
    plans, stored = [], search.shared.stored
    monkeypatch.setattr(search.shared, "stored", lambda rows, *a: plans.append(rows._jdf.queryExecution().executedPlan().toString()) or stored(rows, *a))
    # Every text has the same few words: the shuffle gets a row a word and block of a task, not one an occurrence.
    search.build(spark.range(0, 4000, 1, 2).select(F.col("id").alias("doc_id"), F.lit("a b a b a").alias("text")))
    assert "Generate" not in plans[0] and "rangepartitioning" not in plans[0] and plans[0].count("Exchange") == 1


def test_postings_are_merged_over_slices_and_batches(monkeypatch):
    docs = [(i * 7 - 300, words(t)) for i, (_, t) in enumerate(texts(120, 3))] + [(900, []), (901, ["zz"] * 40)]
    monkeypatch.setattr(search, "SLICE_TERMS", 50)
    batch = lambda rows: pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "block": [i // 64 for i, _ in rows], "terms": pa.array([w for _, w in rows], pa.list_(pa.string()))})
    parts = [r for b in search._grouped([batch(docs[:70]), batch([]), batch(docs[70:])]) for r in b.to_pylist()]
    assert len(parts) > len({(r["term"], r["block"]) for r in parts})
    parts.sort(key=lambda r: (r["term"], r["block"], r["docs"][0]))
    kinds = pa.schema([("term", pa.string()), ("block", pa.int64()), ("docs", pa.list_(pa.int64())), *((c, pa.list_(pa.int32())) for c in ("lengths", "counts", "positions"))])
    batches = [pa.RecordBatch.from_pylist(parts[i : i + 3], kinds) for i in range(0, len(parts), 3)]
    mean = sum(len(w) for _, w in docs) / len(docs)
    got = [r for b in search._merged(mean)(batches) for r in b.to_pylist()]
    want = {}
    for i, w in docs:
        for t in set(w):
            want.setdefault((t, i // 64), []).append((i, len(w), [k for k, x in enumerate(w) if x == t]))
    assert [(r["term"], r["block"]) for r in got] == sorted(want)
    for r in got:
        held = want[r["term"], r["block"]]
        assert list(zip(r["docs"], r["lengths"], r["counts"])) == [(i, n, len(at)) for i, n, at in held] and r["positions"] == [k for *_, at in held for k in at]
        assert r["n_docs"] == len(held) and r["max_impact"] == max(search._impact(len(at), n, mean) for _, n, at in held)
    opened = [r for b in search._opened([pa.RecordBatch.from_pylist(got)]) for r in b.to_pylist()]
    assert [(r["term"], r["doc_id"], r["length"], r["positions"]) for r in opened] == [(t, *entry) for t, b in sorted(want) for entry in want[t, b]]
    assert list(search._merged(mean)([])) == []


def test_texts_are_taken_apart_once_and_postings_move_as_bytes(spark, monkeypatch):
    seen, kinds, stored = spark.sparkContext.accumulator(0), [], search.shared.stored
    monkeypatch.setattr(search.shared, "stored", lambda rows, *a: kinds.append(dict(rows.dtypes)) or stored(rows, *a))
    monkeypatch.setattr(search, "SAMPLE_DOCS", 10)
    counted = F.udf(lambda i: seen.add(1) or ("a b a" if i % 3 else None), "string")
    index = search.build(spark.range(0, 4000, 1, 2).select(F.col("id").alias("doc_id"), counted("id").alias("text")))
    assert seen.value < 6000 and (index.documents, index.mean_length) == (4000, 2666 * 3 / 4000)
    assert {kinds[0][c] for c in search.LISTS} == {"binary"} and index.blocks.filter("term = ''").count() == 0


@pytest.mark.parametrize("first", ["w1", "", "hay " * 500])
def test_bounds_hold_whatever_the_sampled_mean(spark, monkeypatch, first):
    rows = [(-1, first), *((i, t) for i, t in texts() if i is not None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    asked, (want, mean) = "rare w3 the", [(f.collect(), i.mean_length) for i in [search.build(frame)] for f in [search.top(i, "rare w3 the", 12)]][0]
    monkeypatch.setattr(search, "SAMPLE_DOCS", 1)
    monkeypatch.setattr(search, "BLOCK_DOCS", 16)
    monkeypatch.setattr(search, "FIRST_BLOCKS", 1)
    index = search.build(frame)
    assert index.mean_length == mean and (index.slack > 1) == (len(first) < 10) and sorted(search.top(index, asked, 12).collect()) == sorted(want)


@pytest.mark.parametrize("top", [100, 40_000, 1 << 31])
def test_packed_numbers_come_back(top):
    draw, rows = random.Random(3), []
    for i in range(60):
        n, block = draw.randint(0, 6), draw.randint(-3, 3)
        some = lambda n: [min(top - 1, draw.choice([draw.randrange(top), 0, 32767, 32768, (1 << 30) - 1, 1 << 30])) for _ in range(n)]
        rows.append({"term": f"t{i}", "block": block, "docs": [block * 4096 + draw.randint(0, 4095) for _ in range(n)], "lengths": some(n), "counts": some(n), "positions": some(2 * n)})
    lists = [("docs", pa.list_(pa.int64())), *((c, pa.list_(pa.int32())) for c in ("lengths", "counts", "positions"))]
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("term", pa.string()), ("block", pa.int64()), *lists]))
    packed = list(search._packed([batch, batch.slice(7, 11), batch.slice(0, 0)], 4096))
    got = list(search._unpacked([*packed, packed[0].slice(5, 20)], 4096))
    assert [b.to_pylist() for b in got] == [rows, rows[7:18], [], rows[5:25]] and all(b.schema.field(c).type == t for b in got for c, t in lists)


def test_overlaps_of_datasets_within_the_stated_error(spark):
    sizes = {"a": (0, 60000), "b": (30000, 90000), "c": (89000, 91000), "d": (500000, 500010)}
    rows = None
    for name, (x, y) in sizes.items():
        more = spark.range(x, y).select(F.lit(name).alias("dataset"), F.col("id").cast("string").alias("item"))
        rows = more if rows is None else rows.union(more).union(more)
    whole = metrics.item_sketches(rows, "dataset", "item", 13)
    parts = metrics.item_sketches(rows.withColumn("dataset", F.concat_ws("/", "dataset", F.pmod(F.hash("item"), F.lit(4)).cast("string"))), "dataset", "item", 13)
    merged = metrics.merged_sketches(parts.withColumn("dataset", F.substring_index("dataset", "/", 1)), 13)
    for found in (whole, merged):
        for r in metrics.duplication_risk(found).collect():
            (x, y), (u, v) = sizes[r.a], sizes[r.b]
            both, union = max(0, min(y, v) - max(x, u)), max(y, v) - min(x, u)
            error = 4 / math.sqrt(1 << 13)
            assert abs(r.items_a - (y - x)) <= error * (y - x) and abs(r.shared - both) <= error * math.sqrt(both * union) + 1e-6


def test_chains_stop_when_none_goes_on(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", None), ("e", "e")], "url string, next_url string")
    starts = spark.createDataFrame([("a",), ("c",), ("d",), ("e",), ("f",)], "url string")
    got = sorted((r.start, r.step, r.url) for r in links.follow_next(edges, starts, 50).collect())
    assert got == [("a", 1, "a"), ("a", 2, "b"), ("a", 3, "c"), ("c", 1, "c"), ("c", 2, "a"), ("c", 3, "b"), ("d", 1, "d"), ("e", 1, "e"), ("f", 1, "f")]
    assert links.follow_next(edges, starts, 1).count() == 5


def test_large_sources_are_cut_into_documents(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4900, "hot").when(F.col("id") < 4950, "cold").alias("source"), "id")
    got = sinks.envelope(rows, most=500).collect()
    assert {(r.source, r["count"], r.parts) for r in got} == {("hot", 4900, 10), ("cold", 50, 1), (None, 50, 1)} and max(len(r["items"]) for r in got) < 700
    assert sorted(i.id for r in got for i in r["items"]) == list(range(5000))


def test_later_nulls_win_and_ascii_lines(spark, tmp_path):
    row = spark.range(1).select(ocr.merged_totals(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2)), F.create_map(F.lit("b"), F.lit(None).cast("int"), F.lit("c"), F.lit(3)), F.lit(None).cast("map<string,int>")).alias("m")).first()
    assert row.m == {"a": 1, "b": None, "c": 3}
    rows = spark.createDataFrame([("é\n\"😀", None, 1), ("plain", 2.5, 2)], "z string, n double, p int")
    assert sinks.write_jsonl(rows, str(tmp_path / "out"), keep_nulls=True, ascii_only=True) == 2
    lines = sorted(x for f in (tmp_path / "out").glob("part-*") for x in f.read_text().splitlines())
    assert lines == ['{"n":2.5,"p":2,"z":"plain"}', '{"n":null,"p":1,"z":"\\u00e9\\n\\"\\ud83d\\ude00"}']
    assert sinks.write_jsonl(rows, str(tmp_path / "parts"), "p", ascii_only=True) == 2 and sorted(spark.read.json(str(tmp_path / "parts")).columns) == ["n", "p", "z"]
