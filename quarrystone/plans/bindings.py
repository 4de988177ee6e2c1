"""Look-alikes of the pipeline's artifacts, derived from the generic tables row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_CHARS = 1800
WINDOW = 4
PERIOD = 3600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as PDF files whose roots reach every bucket rule; one in 97 has no page count."""
    doc = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".pdf"))
    tree = F.concat_ws("/", "source", "lang", doc)
    branch = F.col("doc_id") % 5
    rel = (
        F.when(branch == 0, F.concat(F.lit("PublicReports/"), tree))
        .when(branch == 1, F.concat(F.lit("sherlock-reports/audits/"), tree))
        .when(branch == 2, F.concat(F.lit("vault/Coverage-Agreements/"), tree))
        .when(branch == 3, F.concat(F.lit("misc/"), tree))
        .otherwise(F.concat(F.lit("PublicReports/"), doc))
    )
    pages = F.when(F.col("doc_id") % 97 != 0, F.ceil(F.col("n_chars") / PAGE_CHARS)).cast("int")
    return table(spark, sf_dir, "documents").select("doc_id", rel.alias("rel_path"), F.octet_length("text").cast("bigint").alias("size_bytes"), pages.alias("page_count"))


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of every document in window files; every third document has its first two pages again in
    a later file, marked; a page here and there has lost its number."""
    pages = F.greatest(F.lit(1), F.ceil(F.col("n_chars") / PAGE_CHARS)).cast("int")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", pages.alias("pages"))
    cut = docs.select("doc_id", "text", "pages", F.explode(F.sequence(F.lit(1), "pages")).alias("page"))
    body = F.expr(f"substring(text, (page - 1) * {PAGE_CHARS} + 1, {PAGE_CHARS})")
    begin = (F.floor((F.col("page") - 1) / WINDOW) * WINDOW + 1).cast("int")
    number = F.when((F.col("doc_id") * 31 + F.col("page")) % 53 != 0, F.col("page"))
    once = cut.select("doc_id", F.format_string("pages_%04d.raw.json", begin).alias("raw_file"), ((F.col("page") - 1) % WINDOW).alias("position"), number.alias("page_number"), body.alias("text"))
    again = cut.filter((F.col("doc_id") % 3 == 0) & (F.col("page") <= 2)).select("doc_id", F.lit("pages_9001.raw.json").alias("raw_file"), (F.col("page") - 1).alias("position"), F.col("page").alias("page_number"), F.concat(F.lit("~ "), body).alias("text"))
    return once.union(again)


def progress_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    status = F.when(kind == "view", "skipped_existing").when(kind == "error", "error").when(kind == "signup", "partial_error").otherwise("ok")
    return table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", F.format_string("chunk_%04d", (F.col("user_id") % 31)).alias("chunk_id"), F.concat(F.lit("pdf_"), F.col("user_id").cast("string")).alias("pdf_id"),
        status.alias("status"), F.col("event_id").cast("string").alias("rel_path"), F.floor(F.col("value") * 10).cast("bigint").alias("text_length"), (F.col("event_id") % 5000).alias("client_elapsed_ms"), "value",
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_id, messages) of every conversation in turn order."""
    one = F.struct("turn", "role", F.col("text").alias("content"))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("messages"))
    return rows.select(F.col("conv_id").cast("string").alias("record_id"), "messages")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors of every page by pattern, so that SQL can say the same."""
    found = F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"[^>]*>([^<]*)</a>'), F.lit(0))
    rows = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page_url"), F.posexplode(found).alias("pos", "tag"))
    return rows.select("page_id", "page_url", "pos", F.regexp_extract("tag", r'href="([^"]*)"', 1).alias("href"), F.regexp_extract("tag", r">([^<]*)<", 1).alias("text"))


def clone_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("category"), "c_name")
    status = F.when(F.col("o_orderstatus") == "F", "cloned").when(F.col("o_orderstatus") == "O", "updated").otherwise("failed")
    rank = F.substring("o_orderpriority", 1, 1)
    priority = F.when(rank.isin("1", "2"), "high").when(rank == "3", "medium").otherwise("low")
    return orders.join(customers, "o_custkey").select(F.col("c_name").alias("name"), "category", status.alias("status"), priority.alias("priority"), F.when(F.col("o_orderstatus") == "P", "timed out").alias("error"))


def phases(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy(F.concat_ws("-", "l_returnflag", "l_linestatus", F.col("l_linenumber").cast("string")).alias("name"), F.col("l_returnflag").alias("category"), F.col("l_linenumber").alias("gpu_count")).agg(F.sum("l_quantity").alias("hours"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a deterministic score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    score = ((F.col("doc_id") * 7919) % 1000) / F.lit(1000.0)
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select("doc_id", "lang", "source", "quality", "toxic", score.alias("score"))


def registry_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as registered sources."""
    kind = F.when(F.col("p_partkey") % 3 == 0, "github").when(F.col("p_partkey") % 3 == 1, "web").otherwise("kaggle")
    priority = F.when(F.col("p_size") >= 34, "high").when(F.col("p_size") >= 17, "medium").otherwise("low")
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), kind.alias("source_type"), F.col("p_brand").alias("category"), priority.alias("priority"), F.col("p_partkey").alias("position"))


def raw_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of ``raw_pages`` as window responses: sources that are missing or hold empty values, times of a page here and there."""
    doc = F.col("doc_id").cast("string")
    page = F.struct(
        "page_number", F.lit(None).cast("string").alias("image_sha256"), "text", F.when(F.col("doc_id") % 4 == 0, F.create_map(F.lit("total"), F.col("position").cast("bigint"))).alias("timing_ms"),
        F.lit(None).cast("map<string,string>").alias("usage"), F.lit(None).cast("map<string,string>").alias("throughput"),
    )
    # A file's pages: bounded by the window.
    files = raw_pages(spark, sf_dir).groupBy("doc_id", "raw_file").agg(F.sort_array(F.collect_list(F.struct("position", "page_number", "text"))).alias("rows"))
    flat = files.select("doc_id", "raw_file", F.posexplode("rows").alias("at", "row")).select("doc_id", "raw_file", "row.*")
    pages = flat.groupBy("doc_id", "raw_file").agg(F.collect_list(F.struct("position", page.alias("page"))).alias("pages"))
    ordered = F.transform(F.array_sort("pages", lambda x, y: x["position"] - y["position"]), lambda x: x["page"])
    source = F.struct(F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("f"), doc)).otherwise("").alias("filename"), F.lit(None).cast("string").alias("sha256"), F.lit(0).alias("page_count"), F.lit(None).cast("array<int>").alias("selected_pages"))
    return pages.select(
        F.concat(F.lit("d"), doc).alias("pdf_dir"), F.concat(F.lit("/raw/d"), doc, F.lit("/"), F.col("raw_file")).alias("raw_file"), doc.alias("id"), F.lit("m").alias("model"),
        F.when(F.col("doc_id") % 2 == 0, "m-1").otherwise("").alias("model_id"), F.lit("b").alias("backend"), F.lit(None).cast("string").alias("endpoint_version"), F.when(F.col("doc_id") % 3 != 0, source).alias("source"),
        F.lit(None).cast("map<string,string>").alias("settings"), F.when(F.col("doc_id") % 5 == 0, F.create_map(F.lit("total"), F.lit(7).cast("bigint"))).alias("timing_ms"), F.lit(None).cast("array<string>").alias("warnings"), ordered.alias("pages"),
    )


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id").cast("string")
    name = F.concat(F.lit("doc_"), doc, F.lit(".pdf"))
    return files(spark, sf_dir).select(F.concat(F.lit("d"), doc).alias("pdf_dir"), F.concat(F.lit("p"), doc).alias("pdf_id"), "rel_path", F.concat(F.lit("/audits/"), F.col("rel_path")).alias("abs_path"), name.alias("filename"), F.lit("b").alias("bucket"), "page_count", F.sha2("rel_path", 256).alias("sha256"))


def site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' links with addresses as audit and news sites have them, in blocks of three with headings; some without a title."""
    at = F.col("pos")
    href = (
        F.when(at % 6 == 0, F.concat(F.lit("/reports/r"), (at % 4).cast("string")))
        .when(at % 6 == 1, F.concat(F.lit("/contests/c"), at.cast("string")))
        .when(at % 6 == 2, F.lit("/contests/"))
        .when(at % 6 == 3, F.concat(F.lit("/c/"), at.cast("string")))
        .when(at % 6 == 4, F.concat(F.lit("/bug-bounty/b"), (at % 3).cast("string")))
        .otherwise(F.concat(F.lit("/docs/page"), at.cast("string"), F.lit(".PDF")))
    )
    heading = F.when(at % 4 != 0, F.concat(F.lit("Heading "), at.cast("string")))
    return links(spark, sf_dir).select(
        "page_id", "page_url", "pos", href.alias("href"), F.when(at % 5 != 0, F.col("text")).otherwise("").alias("text"), F.when(at % 7 != 6, F.floor(at / 3)).alias("block"),
        heading.alias("heading"), F.lit(None).cast("string").alias("heading_class"), F.when(at % 3 == 0, "h1").when(at % 3 == 1, "h2").alias("under"),
    )
