from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarrystone.functions import scalars
from quarrystone.operators import inventory, ordering


def one(spark, column, **values):
    kinds = {str: "string", int: "bigint", float: "double"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(
    ("path", "bucket"),
    [
        ("PublicReports/Acme/x.pdf", "public_reports/Acme"),
        ("publicreports/x.pdf", "public_reports/x.pdf"),
        ("PublicReports/Coverage-Agreements/x.pdf", "excluded/coverage-agreements"),
        ("sherlock-reports/audits/x.pdf", "sherlock_reports/audits"),
        ("sherlock-reports/audits", "other_audit_repo_pdfs"),
        ("x.pdf", "other_audit_repo_pdfs"),
    ],
)
def test_buckets(spark, path, bucket):
    assert one(spark, scalars.path_bucket(F.col("p")), p=path) == bucket


def test_component_order_differs_from_text_order(spark):
    files = spark.createDataFrame([("a-b/x.pdf",), ("a/x.pdf",), ("a/b/c/d.pdf",), ("a/b-c.pdf",)], "rel_path string")
    got = [r.rel_path for r in ordering.path_ordinal(files, depth=1).orderBy("ordinal").collect()]
    assert got == sorted(got, key=lambda p: p.split("/")) != sorted(got)
    assert [r.ordinal for r in ordering.path_ordinal(files, depth=2).orderBy("ordinal").collect()] == [1, 2, 3, 4]


def test_a_flat_directory_is_cut_into_ranges(spark):
    paths = [f"one/{'long-' * (i % 3)}{i * 7919 % 3000}.pdf" for i in range(3000)] + ["two/x.pdf", "a.pdf"]
    numbered = ordering.path_ordinal(spark.createDataFrame([(p,) for p in paths], "rel_path string").repartition(5), depth=1, shard_rows=160)
    got = {r.rel_path: r.ordinal for r in numbered.collect()}
    assert got == {p: i for i, p in enumerate(sorted(paths, key=lambda p: p.split("/")), 1)}


def test_windows_of_known_unknown_and_short_files(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 3), ("c", None)], "rel_path string, page_count int")
    got = inventory.page_windows(rows, 4, 2, 9).groupBy("rel_path").count().collect()
    assert {r.rel_path: r["count"] for r in got} == {"a": 2, "b": 1}
    assert inventory.window_total(rows, 4, 2, 9).first().window_total == 3
    assert inventory.page_windows(rows, 4, 1, 0).agg(F.max("page_end")).first()[0] == 10
    assert inventory.page_windows(rows, 4, 0).count() == 0


def test_packing_invariants(spark):
    rows = [(f"d/{i:03d}.pdf", (i * 37) % 50 if i % 9 else None, i * 11 % 97) for i in range(200)]
    frame = spark.createDataFrame(rows, "rel_path string, page_count int, size_bytes bigint")
    got = inventory.pack_chunks(frame, 6, 20).collect()
    assert Counter(r.rel_path for r in got) == Counter(r[0] for r in rows)
    sizes = Counter(r.chunk_id for r in got)
    assert max(sizes.values()) <= 20 and len(sizes) == 10
    loads = Counter()
    for r in inventory.pack_chunks(frame, 6, 300).collect():
        loads[r.chunk_id] += r.page_count if r.page_count is not None else 1
    assert max(loads.values()) - min(loads.values()) <= 50


def test_packing_places_largest_first_on_the_least_loaded(spark):
    frame = spark.createDataFrame([("a", 5, 1), ("b", 4, 1), ("c", 3, 1), ("d", None, 1)], "rel_path string, page_count int, size_bytes bigint")
    assert {r.rel_path: r.chunk_id for r in inventory.pack_chunks(frame, 2).collect()} == {"a": "chunk_0000", "b": "chunk_0001", "c": "chunk_0001", "d": "chunk_0000"}


@pytest.mark.parametrize(("pages", "expected"), [([(None,), (None,), (None,)], 2), ([(2500,), (1,)], 2), ([], 1)])
def test_chunk_count(spark, pages, expected):
    frame = spark.createDataFrame(pages, "page_count int")
    assert inventory.chunk_count(frame, max_pdfs=2).first().chunk_count == expected


def test_rollup_of_nothing(spark):
    row = inventory.rollup(spark.createDataFrame([], "page_count int, size_bytes bigint")).first()
    assert tuple(row) == (0, 0, 0, 0, 0)


@pytest.mark.parametrize(("value", "expected"), [("3", "chunk_0003"), ("0007", "chunk_0007"), ("chunk_7", "chunk_0007"), ("x7", None)])
def test_chunk_ids(spark, value, expected):
    assert one(spark, scalars.chunk_id(F.col("v")), v=value) == expected


def test_names(spark):
    assert one(spark, scalars.slugify(F.col("v")), v="__A b/ç.pdf__") == "A_b_.pdf"
    assert one(spark, scalars.slugify(F.col("v")), v="///") == "item"
    assert one(spark, scalars.sanitize_filename(F.col("v")), v=' ..a<b>:c|d?.. ') == "a_b__c_d_"
    assert one(spark, scalars.human_size(F.col("v")), v=1536) == "1.50 KiB"
    assert one(spark, scalars.human_size(F.col("v")), v=3 * 1024**4) == "3.00 TiB"
    assert one(spark, scalars.pdf_id(F.lit(1234567), F.col("v")), v="a").startswith("pdf_1234567_")
    assert one(spark, scalars.owner_repo(F.col("v")), v="https://example.com/o/r.git/") == "o/r"
    assert one(spark, scalars.falsy_coalesce(F.col("a"), F.col("b")), a="", b="x") == "x"
    assert one(spark, scalars.falsy_coalesce_number(F.col("a"), F.col("b")), a=0, b=4) == 4
    assert one(spark, scalars.path_ref(F.col("a"), F.lit("/r/")), a="/r/b/c") == "b/c"
    assert one(spark, scalars.path_ref(F.col("a"), F.lit("/q")), a="/r/b") == "/r/b"
    assert one(spark, scalars.short_text(F.col("a"), 5), a="abcdefgh") == "...gh"


def test_single_record(spark):
    row = inventory.single_record("/tmp/Some File.pdf", 3, spark).first()
    assert row.chunk_id.startswith("single_") and row.pdf_id.startswith("pdf_single_") and row.bucket == "single_pdf" and row.page_count == 3
