import hashlib
import random

import pytest
from pyspark.sql import functions as F

from quarrystone.functions import html, scalars
from quarrystone.functions.content import canonical_json, content_text
from quarrystone.operators import links, metrics, ocr, ordering, runs, training
from quarrystone.sources import files, registry, sinks

PAGE = """<html><head><title>T</title></head><body><nav><a href="/n.pdf">nav</a></nav><main><h1>Head</h1>
<p>One <b>two</b></p><ul><li><p>item</p></li></ul><pre><code>x = 1</code></pre><aside><a href="/aside.pdf">a</a></aside>
<a href="/b.PDF">doc</a><a rel="next" href="/p2">more</a></main></body></html>"""


def test_html_fields():
    got = html.extract(PAGE)
    assert got["title"] == "Head" and "nav" not in got["content"] and got["content"].split("\n")[:3] == ["Head", "One", "two"]
    assert got["pdf_links"] == ["/b.PDF"] and got["next_href"] == "/p2" and len(got["links"]) == 4
    assert got["markdown"].count("item") == 1 and got["markdown"].count("x = 1") == 1
    assert html.extract(PAGE, nested_twice=True)["markdown"].count("item") == 2
    assert html.extract(PAGE, strip_first=False)["pdf_links"] == ["/aside.pdf", "/b.PDF", "/n.pdf"]
    assert html.extract(None)["content"] == ""


def _links(spark, rows):
    return spark.createDataFrame([("http://h.com/x/y", i, *r) for i, r in enumerate(rows)], "page_url string, pos int, href string, text string")


def test_seen_first_hides_but_title_first_does_not(spark):
    rows = _links(spark, [("/a", ""), ("/a", "Title"), ("#x", "skip"), ("mailto:a@b.c", "skip"), ("http://other.com/b", "Other")])
    base = F.lit("http://h.com")
    assert links.seen_first(rows, base).count() == 0
    assert [(r.url, r.title) for r in links.title_first(rows, base, F.lit(True)).orderBy("pos").collect()] == [("http://h.com/a", "Title"), ("http://other.com/b", "Other")]


def test_swc_and_pagination(spark):
    rows = _links(spark, [("/docs/SWC-101", "Overflow"), ("/x", "swc 7 thing"), ("/y", "none")])
    assert sorted(r.swc_id for r in links.swc_entries(rows, F.lit("http://h.com")).collect()) == ["SWC-101", "SWC-7"]
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "url string, next_url string")
    starts = spark.createDataFrame([("a",)], "url string")
    assert [r.url for r in links.follow_next(edges, starts, 10).orderBy("step").collect()] == ["a", "b", "c"]


def test_references_resolve_and_roles_route(spark):
    files = spark.createDataFrame([("/in/sys.md", "be careful"), ("/repo/q.json", '{"content": "what?"}'), ("/in/p.json", '{"messages": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "hidden"}]}')], "path string, content string")
    schema = "record_id string, task_id string, source string, split string, messages array<struct<role:string,content:string,content_ref:string>>"
    records = spark.createDataFrame([("r1", "t", "s", "train", [("system", None, "sys.md"), ("user", None, "q.json"), ("assistant", "answer", None), ("tool", "odd", None)])], schema)
    row = training.sft_rows(training.resolve_messages(records, files, ["/in", "/repo"])).first()
    assert (row.context, row.question, row.answer, row.split) == ("be careful", "what?\n\nodd", "answer", "train")
    pairs = spark.createDataFrame([("d1", "p.json", "sys.md", "q.json")], "record_id string, prompt_ref string, chosen_ref string, rejected_ref string")
    refs = spark.createDataFrame([("p.json",), ("sys.md",), ("q.json",)], "ref string")
    got = training.dpo_rows(pairs, training.dereference(refs, files, ["/in", "/repo"])).first()
    assert (got.prompt, got.chosen, got.rejected) == ("user: u", "be careful", "what?")
    with pytest.raises(Exception, match="tried /in/none, /repo/none"):
        training.dereference(spark.createDataFrame([("none",)], "ref string"), files, ["/in", "/repo"]).collect()


def test_record_shapes_and_errors(spark):
    qa = spark.createDataFrame([("a", "c", "q", "x")], "record_id string, context string, question string, answer string")
    assert training.sft_rows(qa).first().context == "c"
    plain = spark.createDataFrame([("a", "", "do", "done")], "record_id string, prompt string, instruction string, output string")
    row = training.sft_rows(plain).first()
    assert (row.question, row.answer) == ("do", "done")
    chat = spark.createDataFrame([("bad", [("user", "hi")])], "record_id string, messages array<struct<role:string,content:string>>")
    assert training.sft_rows(chat, strict=False).first().error == "no assistant answer"
    with pytest.raises(Exception, match="record bad"):
        training.sft_rows(chat).collect()


def test_content_union_types(spark):
    rows = ["null", '"s"', '["a", {"text": "b"}, {"content": "c"}, {"z": 1, "é": 2}, 3, ""]', '{"b": 1, "a": "é"}']
    frame = spark.createDataFrame([(r,) for r in rows], "v string")
    assert [r[0] for r in frame.select(content_text("v")).collect()] == ["", "s", 'a\nb\nc\n{"z": 1, "é": 2}\n3', '{"a": "é", "b": 1}']
    assert frame.select(canonical_json(F.lit('{"b":1,"a":[1,2]}'))).first()[0] == '{"a": [1, 2], "b": 1}'
    prompts = spark.sql("SELECT 'r' AS record_id, parse_json('[1, 2]') AS prompt, 'c' AS chosen, 'd' AS rejected")
    got = training.dpo_rows(prompts).first()
    assert got.prompt == "[1,2]" and got.prompt_is_list and not got.chosen_is_list


def test_budget(spark):
    hours = [("smoke", 1, 2.0), ("sft", 2, 41.0), ("dpo", 1, 60.0)]
    phases = spark.createDataFrame([(n, "c", g, h) for n, g, h in hours], "name string, category string, gpu_count int, hours double")
    row = runs.budget_totals(phases, 6.2496, 1200.0).first()
    assert row.planned_hours == 144 and row.planned_cost_usd == pytest.approx(899.9424) and row.purchased_hours == pytest.approx(192.0123, rel=1e-4) and row.reserve_hours == pytest.approx(48.0123, rel=1e-4)
    assert not row.over_budget


def test_group_advantage_of_odd_groups(spark):
    rows = spark.createDataFrame([("one", 3.0), ("same", 2.0), ("same", 2.0), ("two", 0.0), ("two", 1.0)], "g string, r double")
    got = sorted((r.g, round(r.advantage, 3)) for r in metrics.group_advantage(rows, "g", "r").collect())
    assert got == [("one", 0.0), ("same", 0.0), ("same", 0.0), ("two", -1.0), ("two", 1.0)]


def test_set_scores_and_quality(spark):
    row = metrics.set_scores(spark.createDataFrame([([1, 2], [2, 3, 4])], "e array<int>, a array<int>"), "e", "a").first()
    assert (row.precision, row.recall) == (pytest.approx(1 / 3), 0.5)
    got = metrics.minimum_quality(spark.createDataFrame([(True, True), (True, None)], "a boolean, b boolean"), ["a", "b"]).collect()
    assert [r.admissible for r in got] == [True, False]


def test_registry_and_envelope(spark):
    config = {"github_repos": {"x": [{"name": "n", "url": "u", "data_types": ["md"]}]}, "web_scrapers": {"y": [{"name": "w", "base_url": "b", "endpoints": ["/"], "priority": "high"}]}, "dataset_downloads": {"kaggle": [{"name": "k", "dataset_id": "a/b", "stats": "few"}]}}
    sources = registry.registry(spark, config)
    assert {r.name: r.priority for r in sources.collect()} == {"n": "medium", "w": "high", "k": "medium"}
    assert registry.select_sources(sources, category="nowhere").count() == 0
    none = spark.createDataFrame([("d", "x")], "dataset_id string, description string")
    assert registry.default_datasets(sources, "kaggle", none).first().dataset_id == "a/b"
    assert registry.default_datasets(sources, "other", none).first().dataset_id == "d"
    with pytest.raises(ValueError, match="priority"):
        registry.registry(spark, {"github_repos": {"x": [{"name": "n", "priority": "urgent"}]}})
    row = sinks.envelope(spark.createDataFrame([("s", 2), ("s", 1)], "source string, v int")).first()
    assert row["count"] == 2 and [i.v for i in row["items"]] == [1, 2]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("é", 1, None), ("b", 2, 3.0)], "z string, a int, n double")
    assert sinks.write_jsonl(rows, str(tmp_path / "out"), keep_nulls=True) == 2
    assert sinks.write_jsonl(rows, str(tmp_path / "out"), keep_nulls=True) == 2 and [p.name for p in tmp_path.iterdir()] == ["out"]
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.json"))
    assert '{"a":1,"n":null,"z":"é"}' in text
    files = spark.createDataFrame([("a.pdf", 1024, "r"), ("b.pdf", 512, "r")], "path string, size_bytes bigint, source_root string")
    card = sinks.dataset_card(files).first()
    assert (card.file_count, card.total_size) == (2, "1.50 KiB")


def test_site_links(spark):
    schema = "page_url string, pos int, href string, text string, block int, heading string, heading_class string, under string, in_nav boolean"
    rows = [
        ("http://h.com/l", 0, "/", "Home", 0, "A story", "entry-title", "h2", False), ("http://h.com/l", 1, "/a", "read", 0, "A story", "entry-title", "h2", False),
        ("http://h.com/l", 2, "/b", "", 1, "Second one", "", None, False), ("http://h.com/l", 3, "/contests/9", "Nine", None, None, None, None, False),
        ("http://h.com/l", 4, "/c/7", "Seven", None, None, None, None, False), ("http://h.com/l", 5, "/bug-bounty/x", "", 2, "Bounty X", "", None, False), ("http://h.com/l", 6, "/bug-bounty/", "All", None, None, None, None, True),
    ]
    frame, base = spark.createDataFrame(rows, schema), F.lit("http://h.com")
    titles = lambda d: [(r.href, r.title) for r in d.orderBy("pos").collect()]
    assert titles(links.article_links(frame, base)) == [("/b", "Second one"), ("/bug-bounty/x", "Bounty X")]
    assert titles(links.post_links(frame.filter("block = 0 OR block IS NULL"), base)) == [("/", "A story")]
    assert titles(links.contest_links(frame, base)) == [("/contests/9", "Nine")]
    assert titles(links.contest_links(frame, base, with_short=True)) == [("/contests/9", "Nine"), ("/c/7", "Seven")]
    assert titles(links.bounty_links(frame, base)) == [("/bug-bounty/x", "Bounty X")]
    assert titles(links.generic_articles(frame, base)) == [("/", "Home"), ("/a", "read")]
    sections = spark.createDataFrame([("http://h.com/l", "sc3", "SC3: Thing"), ("http://h.com/l", "x", "Intro")], "page_url string, section_id string, title string")
    top = links.top_entries(frame, sections, base).collect()
    assert {(r.sc_id, r.url) for r in top} == {(None, "http://h.com/l#sc3"), (None, "http://h.com/l#x")}
    numbered = _links(spark, [("/top/SC04", "SC4 Thing"), ("/top/SC05", "Other"), ("/x", "none")])
    assert {(r.sc_id, r.title) for r in links.top_entries(numbered, sections.limit(0), base).collect()} == {("SC04", "SC4 Thing"), (None, "Other")}
    bodies = spark.createDataFrame([("http://h.com/l", "sc3", "text")], "page_url string, section_id string, body string")
    assert links.section_bodies(sections, bodies).count() == 1
    missing = links.with_details(links.contest_links(frame, base), spark.createDataFrame([], "url string, content string"), "site", "audits").first()
    assert missing.error and missing.listing_title == "Nine"


def test_matches_and_names(spark):
    found = spark.createDataFrame([("p", "m", "High"), ("p", "m", "Low"), ("p", None, "Low")], "pdf_id string, match_id string, severity string")
    assert {(r.match_id, r.findings) for r in runs.candidates(found).collect()} == {("m", 2), (None, 1)}
    reports = spark.createDataFrame([("p", "k", "a")], "pdf_id string, key string, name string")
    repos = spark.createDataFrame([("r1", "k", "b"), ("r2", "k", "a")], "repo_id string, key string, repo_name string")
    best = runs.scored_matches(reports, repos, "key", {"name": F.col("name") == F.col("repo_name"), "any": F.lit(True)}).first()
    assert (best.repo_id, best.confidence) == ("r2", "exact")
    row = spark.range(1).select(scalars.data_url(F.lit("a.JPG"), F.lit("x").cast("binary")), scalars.ocr_kind(F.lit("a.pdf")), scalars.placeholder_null(F.lit("your_key"))).first()
    assert tuple(row) == ("data:image/jpeg;base64,eA==", "pdf", None)
    pages = spark.createDataFrame([("p", "x"), ("q", "y")], "pdf_id string, source_pdf_sha256 string")
    records = spark.createDataFrame([("p", "x"), ("q", "z")], "pdf_id string, sha256 string")
    assert [r.pdf_id for r in ocr.checksum_mismatches(pages, records).collect()] == ["q"]


def test_pdf_landing_names(spark):
    rows = [
        ("https://x.org/a/One%20Two.PDF?x=1", "text/html", False, None), ("https://x.org/a/B.Pdf", None, True, "B.Pdf"), ("https://x.org/a/b.pdf/", "application/pdf", True, "b.pdf"),
        ("https://x.org/a/b.pdf;v=1?q=2", "Application/PDF; charset=x", True, "b.pdf"), ("https://x.org/a|b*.pdf", None, True, "a_b_.pdf"), ("https://x.org/get?f=r.pdf", None, True, "document_"),
        ("https://x.org", "application/pdf", True, "document_"), ("ü b.pdf", None, True, "document_"), ("", "application/pdf", True, "document_"), (None, "application/pdf", False, None),
    ]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "url string, kind string, wanted boolean, name string, i int")
    for r in sinks.pdf_names(frame, content_type="kind").collect():
        assert r.is_pdf == r.wanted, r
        if r.name == "document_":
            assert r.pdf_name == f"document_{hashlib.md5(r.url.encode()).hexdigest()[:12]}.pdf"
        else:
            assert r.pdf_name == r.name, r
    assert [r.is_pdf for r in sinks.pdf_names(frame).orderBy("i").collect()] == [False, True, False, False, True, True, False, True, False, False]


def test_eligibility(spark):
    rows = [("evm", True, "low"), (" Solidity ", True, None), ("move", True, "high"), ("move", None, "high"), ("evm", False, "high"), (None, False, "high"), (None, True, "high"), ("evm", None, "high"), ("", True, "high")]
    frame = spark.createDataFrame(rows, "ecosystem string, is_loss_of_funds boolean, severity string")
    assert [r.eligibility for r in runs.eligibility(frame).collect()] == ["eligible", "eligible", "other ecosystem", "other ecosystem", "no loss of funds", "no loss of funds", "review", "review", "review"]
    assert [r.severity for r in runs.eligible_findings(frame).collect()] == ["low", None] and runs.eligibility(frame.limit(0)).count() == 0


def test_best_matches_make_no_pairs(spark):
    """Against all pairs, with ties, nulls on all sides, ends of ranges and negative numbers."""
    draw = random.Random(5)
    some = lambda *xs: draw.choice(xs)
    reports = [(some(f"p{i}", f"p{i}", "p0", None), some("hot", "hot", "k", "none", None), some("a", "b", None), some(True, None), some(None, draw.randint(-40, 40))) for i in range(150)]
    repos = [(f"r{i:03d}", some("hot", "hot", "k", "other", None), some("a", "b", None), some(True, None), some(None, draw.randint(-40, 40))) for i in range(60)]
    mine = spark.createDataFrame(reports, "pdf_id string, key string, name string, flag boolean, size int")
    theirs = spark.createDataFrame(repos, "repo_id string, key string, repo_name string, repo_flag boolean, repo_size int")
    same = {"name": (F.col("name"), F.col("repo_name")), "flag": (F.col("flag"), F.col("repo_flag"))}
    for width in (None, 1, 2, 7, 16, 33):
        expected = {}
        for pdf, key, name, flag, size in reports:
            for repo, other, repo_name, repo_flag, repo_size in repos:
                if key is not None and key == other:
                    n = (name is not None and name == repo_name) + (flag is not None and flag == repo_flag)
                    n += width is not None and None not in (size, repo_size) and abs(size - repo_size) < width
                    expected[pdf] = min(expected.get(pdf, (1, "")), (-n, repo))
        found = runs.best_matches(mine, theirs, "key", same, {"size": (F.col("size"), F.col("repo_size"), width)} if width else None)
        total = 3 if width else 2
        assert {(r.pdf_id, r.repo_id, round(r.score * total)) for r in found.collect()} == {(p, r, -n) for p, (n, r) in expected.items()}
    assert "NestedLoop" not in found._jdf.queryExecution().toString()
    assert runs.best_matches(mine, theirs.limit(0), "key", same).count() == runs.best_matches(mine.limit(0), theirs, "key", same).count() == 0
    with pytest.raises(ValueError, match="one near"):
        runs.best_matches(mine, theirs, "key", same, {n: (F.col("size"), F.col("repo_size"), 3) for n in "ab"})


def test_holdout_by_whole_text(spark):
    held = spark.createDataFrame([("one two three",), ("a b c d e f g h i j",), ("",), (None,)], "text string")
    docs = [(1, "zero one two three four"), (2, "one two\nthree"), (3, "x a b c d e f g h i j y"), (4, "a b c d e f g h i"), (5, None), (6, ""), (7, "one two three")]
    kept = training.holdout_exclusion(spark.createDataFrame(docs, "doc_id int, text string"), held)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 6]


def test_holdout_glued_to_other_characters(spark):
    held = spark.createDataFrame([("What is the sum of one and two and three?",), ("one two three",), (" lead and trail ",), ("Yes",), ("a-b",), ("(!)",)], "text string")
    long = "What is the sum of one and two and three?"
    docs = [
        (1, f'"{long}"'), (2, f"({long})"), (3, f">{long}<"), (4, f"x{long}y"), (5, "zone two threes."), (6, "they lead and trail off"), (7, "oh,Yes."), (8, "Yesterday"), (9, "aa-bb"), (10, "so(!)"),
        (11, "What is the sum of one and two and four?"), (12, "one  two three"), (13, "lead and trail"), (14, "yes"), (15, "a b"), (16, None), (17, ""),
    ]
    kept = training.holdout_exclusion(spark.createDataFrame(docs, "doc_id int, text string"), held)
    assert sorted(r.doc_id for r in kept.collect()) == [11, 12, 13, 14, 15, 16, 17]


def test_severity_counts_reads_whole_texts(spark, tmp_path):
    from quarrystone.plans import catalogue

    spark.createDataFrame([(8, "word " * 30 + "H-02 and L-1, then H-3")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.severity: r.n for r in catalogue.QUERIES["severity_counts"](spark, str(tmp_path)).collect()}
    assert got == {"H": 3, "M": 1, "L": 1}


def test_a_failed_write_leaves_the_old_output(spark, tmp_path):
    path = str(tmp_path / "out")
    sinks.write_jsonl(spark.createDataFrame([(1,)], "a int"), path)
    bad = spark.range(3).select(F.when(F.col("id") == 1, F.raise_error(F.lit("no"))).otherwise(F.lit("x")).alias("a"))
    with pytest.raises(Exception, match="no"):
        sinks.write_jsonl(bad, path)
    assert [r.a for r in spark.read.json(path).collect()] == [1] and [p.name for p in tmp_path.iterdir()] == ["out"]


def test_file_hashes(spark, tmp_path):
    import hashlib

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.pdf").write_bytes(b"abc" * 1000)
    (tmp_path / "y.txt").write_bytes(b"y")
    (tmp_path / "empty.txt").write_bytes(b"")
    got = {r.path.split("/")[-1]: (r.size_bytes, r.sha256, r.md5) for r in files.file_hashes(spark, str(tmp_path)).collect()}
    assert got == {n: (len(c), hashlib.sha256(c).hexdigest(), hashlib.md5(c).hexdigest()) for n, c in (("x.pdf", b"abc" * 1000), ("y.txt", b"y"), ("empty.txt", b""))}
    assert [r.path.split("/")[-1] for r in files.file_hashes(spark, str(tmp_path), "*.pdf").collect()] == ["x.pdf"]


def test_prefixes_and_quotas_with_nulls(spark):
    rows = spark.createDataFrame([(None, 1, True), (None, 2, None), (None, 3, True), (None, 4, False), ("a", 1, False)], "g string, at int, bad boolean")
    assert sorted((str(r.g), r["at"]) for r in ordering.until_errors(rows, ["g"], ["at"], F.col("bad"), 2).collect()) == [("None", 1), ("None", 2), ("None", 3), ("a", 1)]
    many = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, "y").alias("s"))
    got = metrics.mix_quota(many, "s", "id", {"x": 0.5, "y": 0.01}, 1001)
    assert got.columns == ["id", "s"] and {r.s: r.n for r in got.groupBy("s").agg(F.count("*").alias("n")).collect()} == {"x": 500, "y": 10}
