"""Tables whose pages repeat an address, and sources too large for a sketch or one document."""

import math
import random

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrystone.functions import html
from quarrystone.operators import inventory, runs
from quarrystone.plans import catalogue, oracles


@pytest.fixture
def folder(spark, tmp_path):
    """A folder of tables given as (rows, schema)."""

    def made(**tables):
        for name, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return made


PAGES = "page_id long, url string, html string"


def test_sections_of_two_pages_of_one_address_stay_apart(spark, folder):
    d = folder(pages=([(5, "http://a/x", "12345"), (9, "http://a/x", "123")], PAGES))
    got = sorted(tuple(r) for r in catalogue.QUERIES["section_bodies"](spark, d).collect())
    assert got == [("http://a/x", "s0", "t5", 5), ("http://a/x", "s1", "t9", 3)]


def test_a_large_source_is_one_envelope_row(spark, folder):
    d = folder(pages=([(i, "http://a/" if i % 10001 else "http://b/", "") for i in range(20_003)], PAGES))
    got = {r.source: (r["count"], r.page_ids) for r in catalogue.QUERIES["report_envelope"](spark, d).collect()}
    assert got == {"a": (20_000, ",".join(str(i) for i in range(20_003) if i % 10001)), "b": (3, "0,10001,20002")}


def test_shared_texts_are_counted(spark, folder):
    rows = [(i, "one", f"t{i}") for i in range(40_000)] + [(50_000 + i, "two", f"t{i * 7}") for i in range(9_000)]
    rows += [(70_000 + i, "three", text) for i, text in enumerate(["t0", "t0", "", None])] + [(80_000, None, "t0")]
    d = folder(documents=(rows, "doc_id long, source string, text string"))
    got = sorted(tuple(r) for r in catalogue.QUERIES["duplication_risk"](spark, d).collect())
    shared = len(range(0, 40_000, 7))
    assert got == [("one", "three", 40_000, 2, 1, 0.5), ("one", "two", 40_000, 9_000, shared, round(shared / 9_000, 6)), ("three", "two", 2, 9_000, 1, 0.5)]


@pytest.mark.parametrize("name", ["contest_links", "contest_links_short", "bounty_links", "generic_articles", "post_links", "swc_entries"])
def test_links_of_pages_of_one_address_go_by_place_then_page(spark, folder, name):
    def page(word):
        return "".join(f'<a href="/x{i}">{word} title {i}</a>' for i in range(12))

    nations = ([(30, "known")], "n_nationkey int, n_name string")
    pages = [(1, "http://a/x", page("early")), (2, "http://a/x", page("late"))]
    d = folder(pages=(pages, PAGES), nation=nations)
    first = sorted(map(str, catalogue.QUERIES[name](spark, d).collect()))
    spark.createDataFrame(pages[::-1], PAGES).coalesce(1).write.mode("overwrite").parquet(f"{d}/pages.parquet")
    again = sorted(map(str, catalogue.QUERIES[name](spark, d).collect()))
    assert first == again and "early" in str(first) and "late" not in str(first)


def test_page_batches_are_read_in_slices():
    pages = pa.RecordBatch.from_pydict({"page_id": list(range(700)), "html": [None, "x" * (html.SLICE_CHARS // 2), *["<p>a</p>"] * 698]})
    some = list(html.slices(pages, "html"))
    assert [r["page_id"] for s in some for r in s.to_pylist()] == list(range(700)) and max(s.num_rows for s in some) <= html.SLICE_PAGES
    wide = pa.RecordBatch.from_pydict({"html": ["x" * (html.SLICE_CHARS // 2)] * 5})
    assert [s.num_rows for s in html.slices(wide, "html")] == [2, 2, 1] and list(html.slices(wide.slice(0, 0), "html")) == []
    root = html.parse("<div><a href=x>b</a></div>")
    div = root.children[0]
    root.unlink()
    assert div.parent is None and div.children == []


def test_many_small_groups_are_packed_in_one_stream(spark):
    rows = [(f"g{i % 300}", f"f{i:04d}", (i * 37) % 11 or None, (i * 53) % 7 or None) for i in range(1500)]
    frame = spark.createDataFrame(rows, "g string, rel_path string, size_bytes long, page_count int")
    packed = inventory.pack_chunks(frame, 2, 2, per="g")
    want = {}
    for g in {r[0] for r in rows}:
        load = [[0.0, 0, 0, 0], [0.0, 0, 0, 1]]
        for _, path, size, pages in sorted((r for r in rows if r[0] == g), key=lambda r: (-(r[3] or 0), -(r[2] or 0), r[1])):
            room = [c for c in load if c[1] < 2]
            if not room:
                room = [[0.0, 0, 0, len(load)]]
                load += room
            best = min(room)
            want[path] = f"chunk_{g}_{best[3]:04d}"
            best[0], best[1], best[2] = best[0] + (1 if pages is None else pages), best[1] + 1, best[2] + (size or 0)
    assert {r.rel_path: r.chunk_id for r in packed.collect()} == want
    # One call of Python a task, not one a group.
    assert "InPandas" not in packed._jdf.queryExecution().executedPlan().toString()


def test_matches_send_no_table_through_the_driver(spark, sf):
    plan = catalogue.QUERIES["scored_matches"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_balances_are_near_as_doubles_are(spark, folder):
    """1,000.00 apart in cents, and below that in doubles or not: the query goes by what the SQL says."""
    balances = [4010.53, 4059.36, 0.01, 5016.4, -999.85, 8765.43, 1000.0, 333.33, 4999.99, 7.1]
    customers = [(i, 5, b) for i, b in enumerate(balances)]
    suppliers = [(20 * i + 2 * n, 5, round(b + sign * d, 2)) for i, b in enumerate(balances) for n, (sign, d) in enumerate([(1, 1000), (-1, 1000), (1, 1000.01), (-1, 1000.01), (1, 999.99), (-1, 999.99)])]
    # One nation a supplier as well, so that a single pair decides.
    customers += [(1000 + 100 * i + s, 100 + 1000 * i + s, b) for i, b in enumerate(balances) for s, _, _ in suppliers if s // 20 == i]
    suppliers += [(1000 + s, 100 + 1000 * (s // 20) + s, b) for s, _, b in suppliers]
    path = folder(customer=(customers, "c_custkey long, c_nationkey int, c_acctbal double"), supplier=(suppliers, "s_suppkey long, s_nationkey int, s_acctbal double"))
    c = duckdb.connect()
    for t in ("customer", "supplier"):
        c.execute(f"CREATE VIEW {t} AS FROM '{path}/{t}.parquet/*.parquet'")
    want = c.execute(oracles.ORACLES["scored_matches"]).fetchall()
    assert sorted(map(tuple, catalogue.QUERIES["scored_matches"](spark, path).collect())) == sorted(want)


def test_near_doubles_of_any_kind(spark):
    """Against all pairs: several doubles a cell, ends of ranges, nulls, values that are no numbers, and such as lie beyond the cells."""
    draw = random.Random(9)
    odd = [None, math.nan, math.inf, -math.inf, 0.0, -0.0, 1e300, -1e300, 2.0**53, 2.0**53 + 2, 2.0**40 * 0.01, 2.0**40 * 0.01 + 0.005, 1e-300]
    some = lambda: draw.choice([draw.choice(odd), draw.uniform(-3, 3), round(draw.uniform(-30, 30), 2), draw.randrange(-40, 40) / 10 + draw.choice([0, 1e-12, 0.004])])
    reports, repos = [(i, draw.choice("ab"), some()) for i in range(250)], [(i, draw.choice("ab"), some()) for i in range(80)]
    mine, theirs = spark.createDataFrame(reports, "pdf_id long, key string, x double"), spark.createDataFrame(repos, "repo_id long, key string, y double")
    for width, unit in ((1, 0.01), (0.5, 0.1), (0.001, 0.01), (7.3, 0.01), (3, 2.0)):
        expected = {}
        for pdf, key, x in reports:
            for repo, other, y in repos:
                if key == other:
                    n = None not in (x, y) and abs(x - y) < width
                    expected[pdf] = min(expected.get(pdf, (1, 0)), (-int(n), repo))
        found = runs.best_matches(mine, theirs, "key", {}, {"near": (F.col("x"), F.col("y"), width, unit)})
        assert {(r.pdf_id, r.repo_id, int(r.score)) for r in found.collect()} == {(p, r, -n) for p, (n, r) in expected.items()}
