from pyspark.sql import functions as F

from quarrystone import schemas
from quarrystone.operators import ocr, ordering, runs
from quarrystone.sources import files, jsonl
from quarrystone.streaming import progress


def test_last_version_of_sound_pages(spark):
    rows = [
        (1, "pages_0001", 0, 1, "old"), (1, "pages_0001", 1, None, "?"), (1, "pages_0001", 2, 3, "lost"),
        (1, "pages_0005", 0, 1, "new"), (1, "pages_0005", 1, 2, "two"),
    ]
    pages = spark.createDataFrame(rows, "pdf_id int, raw_file string, position int, page_number int, text string")
    got = ocr.page_store(pages).orderBy("page_number").collect()
    assert [(r.page_number, r.text) for r in got] == [(1, "new"), (2, "two")]
    summary = ocr.materialize_summary(pages, ocr.page_store(pages), ["pdf_id"]).first()
    assert (summary.raw_file_count, summary.page_record_count, summary.error_count, summary.status) == (2, 2, 1, "error")


def test_page_records_coalesce_and_reference(spark):
    page = lambda n, t: (n, "img", t, None, None, None)
    raw = spark.createDataFrame(
        [("/raw/chunk_0001/p", "/raw/chunk_0001/p/pages_0001.raw.json", "r1", "m", "", "b", "v1", ("", None, 0, [1, 2]), {"dpi": "300"}, {"total": 9}, None, [page(1, "hello"), page(2, None)])],
        "pdf_dir string, raw_file string, " + schemas.RAW_RESPONSE,
    )
    manifest = spark.createDataFrame([("/raw/chunk_0001/p", "p1", "chunk_0001", "a/b.pdf", "/x/a/b.pdf", "b.pdf", "other", 7, "s")], "pdf_dir string, " + schemas.PDF_MANIFEST)
    one, two = ocr.page_records(raw, manifest, "/raw").orderBy("page_number").collect()
    assert (one.source_filename, one.source_page_count, one.ocr_model_version, one.ocr_text) == ("b.pdf", 7, "m", "hello")
    assert one.raw_response_ref == "chunk_0001/p/pages_0001.raw.json" and one.timing_ms == {"total": 9} and one.confidence is None
    assert two.ocr_text == "" and two.warnings == [] and len(one) == 25


def test_next_incomplete_skips_complete_chunks(spark):
    plan = spark.createDataFrame([("chunk_0001", 2), ("chunk_0002", 1), ("chunk_0003", 1)], "chunk_id string, expected int")
    events = spark.createDataFrame([("chunk_0001", "ok"), ("chunk_0001", "skipped"), ("chunk_0002", "partial_error")], "chunk_id string, status string")
    assert ocr.next_incomplete(ocr.chunk_completion(plan, events)).first().chunk_id == "chunk_0002"
    assert ocr.next_incomplete(ocr.chunk_completion(plan, events), "chunk_0002").first().chunk_id == "chunk_0003"


def test_stop_after_errors_keeps_the_last_error(spark):
    rows = spark.createDataFrame([("c", i, s) for i, s in enumerate("oeoeo")], "chunk string, at int, s string")
    assert [r["at"] for r in ordering.until_errors(rows, ["chunk"], ["at"], F.col("s") == "e", 2).orderBy("at").collect()] == [0, 1, 2, 3]


def test_response_complete(spark):
    values = ['{"id": "a", "source": {"f": 1}}', '{"id": "", "source": {"f": 1}}', '{"id": "a", "source": {}}', "{", None]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r[0] for r in frame.select(ocr.response_complete(F.col("v"))).collect()] == [True, False, False, False, False]


def test_rate_window_excludes_the_call_itself(spark):
    calls = spark.createDataFrame([("s", t) for t in (0, 10, 59, 60, 61)], "service string, t bigint")
    got = runs.rate_limited(calls, "service", F.col("t"), 60, 2).orderBy("t").collect()
    assert [(r.earlier, r.can_proceed, r.wait_seconds) for r in got] == [(0, True, 0), (1, True, 0), (2, False, 1), (2, False, 10), (3, False, 9)]


def test_strict_and_tolerant_json(spark, tmp_path):
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    good.write_text('{"a": 1}\n\n{"a": 2}\n')
    bad.write_text('{"a": 1}\n[1]\n{"a"\n')
    assert jsonl.strict_jsonl(spark, str(good)).count() == 2
    try:
        jsonl.strict_jsonl(spark, str(bad)).collect()
        raise AssertionError("a list was taken for an object")
    except Exception as e:
        assert "not a JSON object at" in str(e) and ":2" in str(e)
    assert jsonl.tolerant_jsonl(spark, str(bad), "a int").filter("a IS NOT NULL").count() == 1


def test_file_listing(spark, tmp_path):
    for name in ("a/x.pdf", "a/b/y.PDF", "a/z.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"12345")
    assert [r.rel_path for r in files.list_files(spark, str(tmp_path)).orderBy("rel_path").collect()] == ["a/b/y.PDF", "a/x.pdf"]
    assert files.list_files(spark, str(tmp_path), any_case=False).count() == 1
    assert files.file_manifest(spark, [str(tmp_path)]).first().size_bytes == 5


def test_probe(spark):
    frame = spark.createDataFrame([("Title: x\nPages:   12\n",), ("Syntax Error",)], "output string")
    assert [(r.page_count, r.page_count_error) for r in files.page_count(frame).collect()] == [(12, None), (None, "Syntax Error")]


def test_token_stream(spark):
    def line(i, text):
        return ("r", i, i * 10, text)

    rows = [line(0, ": ping"), line(1, 'data: {"choices":[{"delta":{"content":"He"}}]}'), line(2, "data: {bad"), line(3, 'data: {"choices":[{"delta":{"content":"y"}}],"usage":{"completion_tokens":2}}'), line(4, "data: [DONE]"), line(5, 'data: {"choices":[{"delta":{"content":"!"}}]}')]
    row = jsonl.event_stream_fold(spark.createDataFrame(rows, "request_id string, seq int, ms int, line string")).first()
    assert (row.text, row.first_token_ms, row.decode_ms, row.completion_tokens) == ("Hey", 10, 20, 2)


def test_stream_tail_counts_and_lands_once(spark, tmp_path):
    folder = tmp_path / "events"
    folder.mkdir()
    (folder / "one.json").write_text('{"status": "ok", "rel_path": "a"}\nnot json\n{"status": "error", "rel_path": "b"}\n{"status": "ok", "rel_path": "a"}\n')
    events = progress.tail_events(spark, str(folder))
    counts = {r.status: r.n for r in progress.run_to_table(progress.running_counts(events.filter("rel_path IS NOT NULL")), ["status"]).collect()}
    assert counts == {"ok": 2, "error": 1}
    for name in ("two.json", "three.json"):
        progress.land_once(progress.tail_events(spark, str(folder)).filter("rel_path IS NOT NULL"), str(tmp_path / "landed"), str(tmp_path / "checkpoint"), ["rel_path"]).awaitTermination()
        (folder / name).write_text('{"status": "ok", "rel_path": "a"}\n{"status": "ok", "rel_path": "c"}\n')
    assert sorted(r.rel_path for r in spark.read.parquet(str(tmp_path / "landed")).collect()) == ["a", "b", "c"]
