import inspect
import random

import numpy as np
import pytest

from quarrystone.llm import collocations as c
from quarrystone.llm import kmeans, url_rules
from tests.llm import brute

RULES = "host string, path string, verdict string"
RULED = [
    *url_rules.RULES, ("net", "/", "block"), ("a.b.example.org", "/x", "block"), ("EXAMPLE.org", "/x/y/", "allow"), ("example.org", "/x/yy", "block"), ("org", "", "allow"),
    ("b.org", "/", "allow"), ("b.org", "/", "block"), ("ab.net", "/", "allow"), ("net", "/en/", "block"), (None, "/", "block"), ("", "/", "block"), ("com", None, "block"), ("com", "/q", None),
]
URLS = [
    None, "", "no scheme/net/", "http://net/", "http://net", "http://x.net?a=/en/", "https://WWW.Example.NET/en/25#top", "http://badexample.net/en/1", "http://example.net/EN/1", "ftp://example.com/de/?x",
    "http://a.b.example.org/x", "http://a.b.example.org/xyz?q", "http://example.org/x/y/z", "http://example.org/x/yy", "http://q.example.org/x/yyy/", "http://example.org/x#/x/y/", "x://y://example.org/fr/", "http://.org/fr/", "http://org./fr/",
    "http://user@b.org:80/", "http://b.org/", "http://c.b.org//", "http://ab.net/en/", "http://com/q", "http:///net/", "http://ünï.org/fr/é", "http://b.org/\nx", "http://" + "a." * 3000 + "net/" + "d/" * 3000, "http://b.org/", "HTTP://B.ORG/",
]


@pytest.mark.parametrize("rules", [RULED, url_rules.RULES, []])
def test_url_rules_against_every_rule(spark, rules):
    pages = spark.createDataFrame([(i // 2 or None, u, "h", "r", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, Rule string, found int").repartition(3)
    got = url_rules.judge(pages, spark.createDataFrame(rules, RULES), default="allow")
    assert got.columns == ["page_id", "url", "found", "host", "path", "rule", "verdict"]
    clean = [(h.lower() if h else h, p, v) for h, p, v in rules]
    want = sorted((str(i // 2 or None), str(u), *brute.url_verdict(u, clean)) for i, u in enumerate(URLS))
    assert sorted((str(r.page_id), str(r.url), r.host, r.path, r.rule, r.verdict) for r in got.collect()) == want == sorted(want, key=lambda x: x[:2])
    assert url_rules.judge(pages.limit(0), spark.createDataFrame(rules, RULES)).count() == 0


def test_random_urls_and_rules(spark):
    rng = random.Random(4)
    host = lambda n: ".".join(rng.choice(["a", "b", "net", "org"]) for _ in range(rng.randint(1, n)))
    path = lambda n: rng.choice(["", "/"]) + "/".join(rng.choice(["", "x", "xy", "z"]) for _ in range(rng.randint(0, n)))
    rules = list({(h, p): (h, p, rng.choice(["allow", "block"])) for h, p in ((host(3), path(3)) for _ in range(60))}.values())
    urls = [f"h://{host(5)}{path(6)}{rng.choice(['', '?x/y', '#z'])}" for _ in range(400)]
    got = url_rules.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), spark.createDataFrame(rules, RULES), default="review")
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == {i: brute.url_verdict(u, rules, "review") for i, u in enumerate(urls)}


def test_url_rules_stay_in_the_engine(spark, sf):
    text = inspect.getsource(url_rules)
    assert not any(x in text for x in ("udf", "mapIn", "applyIn", "toArrow", ".rdd"))
    plan = url_rules.op11_url_rules(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def phrase_docs():
    rng = random.Random(7)
    words = ["the", "New", "york", "city", "of", "ÀB", "x" * 300, "a\u00a0b", "z"] + [f"w{i}" for i in range(30)]
    made = [("en" if i % 3 else None, "".join(rng.choice(words[: rng.choice([4, 9, 39])]) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " ? "]) for _ in range(rng.randint(0, 80)))) for i in range(150)]
    return [*made, ("en", None), ("en", ""), ("", "the the the the the the the the"), ("und", "the the"), ("en", ".,;"), *[("de", "in der Tat so ist es")] * 12]


@pytest.mark.parametrize(("max_n", "min_count", "top", "keep_below", "chunk"), [(5, 6, 2000, 100, 2_000_000), (5, 4, 7, 70, 50), (2, 10, 5, 100, 50), (3, 1, 2000, 100, 700)])
def test_collocations_against_plain_counts(spark, monkeypatch, max_n, min_count, top, keep_below, chunk):
    monkeypatch.setattr(c, "CHUNK", chunk)
    docs = phrase_docs() if min_count > 1 else phrase_docs()[:40]
    frame = spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "lang string, text string, phrase string, n int, k int").repartition(3)
    got = sorted(tuple(r) for r in c.collocations(frame, max_n, min_count, top, keep_below).collect())
    assert got == brute.collocations(docs, max_n, min_count, top, keep_below) and len(got) > 4


def test_a_full_bit_table_and_salted_ranks_change_nothing(spark, monkeypatch):
    docs = phrase_docs()
    frame = spark.createDataFrame(docs, "lang string, text string")
    # Tasks take these values from the module, so the table is filled here and not by its size.
    monkeypatch.setattr(c, "SALTS", 3)
    monkeypatch.setattr(c, "_filter", lambda counted, order: spark.sparkContext.broadcast(np.full(1 << (c.FILTER_BITS - 6), -1, np.int64).tobytes()))
    assert sorted(tuple(r) for r in c.collocations(frame, 4, 5, 9).collect()) == brute.collocations(docs, 4, 5, 9)


def test_no_phrases(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert c.collocations(none).count() == 0
    assert c.collocations(spark.createDataFrame([("en", None), (None, "a b"), ("en", " \n ")], none.schema)).count() == 0


def test_long_texts_are_cut_at_piece_ends():
    text = "aa bb, " * 50 + "c" * 90 + " d" + ". e f" * 9
    runs = list(c._runs(iter([text, None, "g h", "i"]), 40))
    assert [p.split() for r in runs for p in r.decode().replace(",", ".").replace("\n", ".").split(".") if p.split()] == [p.split() for p in text.replace(",", ".").split(".") if p.split()] + [["g", "h"], ["i"]]
    assert max(map(len, runs)) <= 95


def test_scores_beyond_64_bits(spark):
    """The products are far beyond 64 bits, the score is exact."""
    big = 3_000_000_007 * 1_000_003
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 5)], c.COUNTED)
    totals = spark.createDataFrame([("en", 3 * big)], "lang string, total long")
    from unittest import mock

    with mock.patch.object(c, "phrase_counts", lambda *a: (counts, totals)):
        (row,) = c.collocations(counts).collect()
    assert row.score == 1000 * (big - 5) * 3 * big // (big * (big - 1))


SCHEMA = "vec_id long, embedding array<double>, cluster string, v int"


def vectors(n=300, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, (np.eye(dim)[i % dim] * (i % 4) + rng.choice([0, 0.01, 0.3]) * rng.normal(size=dim)).tolist()) for i in range(n)]
    odd = [None, [], [1.0] * (dim - 1), [1.0] * (dim + 1), [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("-inf")] * dim]
    return rows + [(n + i, v) for i, v in enumerate(odd)] + [(n + 50 + i, rows[1][1]) for i in range(40)] + [(None, rows[2][1])]


@pytest.mark.parametrize(("k", "rounds", "scale"), [(8, 10, 1.0), (3, 1, 1.0), (8, 10, 6000.0), (1, 2, 1.0), (9, 0, 0.001), (500, 3, 1.0)])
def test_delta_lloyd_against_plain_rounds(spark, k, rounds, scale):
    rows = [(i, v if v is None else [x if x is None else x * scale for x in v]) for i, v in vectors()]
    state, cents = kmeans.delta_lloyd(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3), k, 6, rounds)
    own, want = brute.lloyd(rows, k, 6, rounds)
    assert cents.tolist() == want
    assert sorted((str(r.vec_id), r.owner, r.distance) for r in state.collect()) == sorted((str(i), *x) for i, x in own.items())


def test_unchanged_centroids_are_not_compared(monkeypatch):
    rng = np.random.default_rng(1)
    v, cents = rng.integers(-900, 900, (200, 4)), rng.integers(-900, 900, (7, 4))
    everything = np.ones(7, bool)
    owner, distance = kmeans.reassign(v, np.full(200, -1), np.zeros(200, np.int64), cents, everything)
    moved = cents.copy()
    moved[[2, 5]] += rng.integers(-300, 300, (2, 4))
    changed = (moved != cents).any(axis=1)
    compared = []
    plain = kmeans.distances
    monkeypatch.setattr(kmeans, "distances", lambda v, c: compared.append((len(v), len(c))) or plain(v, c))
    got = kmeans.reassign(v, owner, distance, moved, changed)
    assert compared == [(int(changed[owner].sum()), 7), (int((~changed[owner]).sum()), 2)]
    full = kmeans.reassign(v, np.full(200, -1), np.zeros(200, np.int64), moved, everything)
    assert (got[0] == full[0]).all() and (got[1] == full[1]).all()


def test_ties_repeats_and_nothing(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [0.0, 0.0]), (4, [0.0, 5.0])]
    state, cents = kmeans.delta_lloyd(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA), 4, 2, 0)
    first = {tuple(c): i for i, c in reversed(list(enumerate(cents.tolist())))}
    assert all(r.owner == first[tuple(r.v)] and r.distance == 0 for r in state.collect() if tuple(r.v) in first)
    for none in ([], [(1, None), (2, [float("nan"), 1.0])]):
        state, cents = kmeans.delta_lloyd(spark.createDataFrame([(*r, "x", 1) for r in none], SCHEMA), 4, 2)
        assert state.count() == 0 and cents.shape == (0, 2)


def test_components_beyond_exact_distances_are_refused(spark):
    with pytest.raises(Exception, match="vec_id 7"):
        kmeans.delta_lloyd(spark.createDataFrame([(7, [1e300, 0.0], "x", 1)], SCHEMA), 2, 2)
