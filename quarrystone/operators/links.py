"""Link filters over ``links(page_url, pos, href, text, ...)`` rows, as sites need them. Where pages repeat an address, ``page_id`` tells them apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrystone import shared
from quarrystone.functions import scalars
from quarrystone.operators import ordering

# What a finding's address holds, and addresses of a news site that are no articles.
FINDING_WORDS = ("/issues/", "/findings/", "/checklist/", "/report/")
NO_ARTICLES = ("/", "/leaderboard", "/about")


def page_links(pages: DataFrame) -> DataFrame:
    """One row per link of pages that carry a ``links`` array."""
    return pages.select(F.col("url").alias("page_url"), F.inline("links"))


def resolved(links: DataFrame, base: Column) -> DataFrame:
    """Followable links with ``url`` resolved against the site root and a stripped title."""
    low = F.lower("href")
    follow = (F.col("href") != "") & ~low.startswith("#") & ~low.startswith("mailto:") & ~low.startswith("javascript:")
    return links.filter(follow).withColumn("url", scalars.join_root(base, F.col("href"))).withColumn("title", scalars.stripped(F.coalesce("text", F.lit(""))))


def _places(rows: DataFrame) -> list[str]:
    """The order of an address's links: by place, then by page. Without a ``page_id``, links of one place go by what they are, so that no run gives another."""
    if "page_id" in rows.columns:
        return ["pos", "page_id"]
    return ["pos", *(c for c, kind in rows.dtypes if c != "pos" and not kind.startswith(("map", "variant")))]


def _any(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def seen_first(links: DataFrame, base: Column, include: list[str] = [], exclude: list[str] = [], least_title: int = 1) -> DataFrame:  # noqa: B006
    """A URL counts as seen at its first link, before host and title are looked at: a first copy
    without a title hides later ones."""
    rows = resolved(links, base)
    low = F.lower("href")
    if include:
        rows = rows.filter(_any(low, include))
    rows = rows.filter(~_any(low, exclude))
    first = ordering.keep_first(rows, ["page_url", "url"], _places(rows))
    return first.filter(scalars.same_host(F.col("url"), base) & (F.length("title") >= least_title))


def title_first(links: DataFrame, base: Column, keep: Column, least_title: int = 1) -> DataFrame:
    """Links without a title are dropped before URLs are de-duplicated."""
    rows = resolved(links, base).filter(keep & (F.length("title") >= least_title))
    return ordering.keep_first(rows, ["page_url", "url"], _places(rows))


def report_links(links: DataFrame, base: Column) -> DataFrame:
    return title_first(links, base, F.col("href").rlike(r"/reports/[\w-]+"))


def contest_links(links: DataFrame, base: Column, with_short: bool = False) -> DataFrame:
    """Contest pages with a title of three characters at least; ``with_short`` also takes ``/c/``."""
    if with_short:
        keep = F.col("href").rlike(r"/contests/[\w-]+") | F.col("href").contains("/c/")
    else:
        keep = F.col("href").contains("/contests/") & (F.col("href") != "/contests/")
    return title_first(links, base, keep, 3)


def finding_links(links: DataFrame, base: Column, most: int = 100) -> DataFrame:
    rows = title_first(links, base, _any(F.lower("href"), list(FINDING_WORDS)), 3)
    return ordering.first_n(rows, ["page_url"], _places(rows), most)


def block_links(links: DataFrame, base: Column, drop: Column, least_title: int, heading_class: str | None = None) -> DataFrame:
    """One link a block: its first, unless that is to be dropped, titled by the block's heading; where a page
    has no such block, the generic links."""
    rows = resolved(links, base).filter(F.col("block").isNotNull())
    heading = F.nullif("heading", F.lit(""))
    if heading_class:
        heading = F.when(F.col("heading_class").rlike(heading_class), heading)
    rows = ordering.keep_first(rows.withColumn("title", F.coalesce(heading, F.col("title"))), ["page_url", "block"], _places(rows))
    rows = ordering.keep_first(rows.filter(~drop & (F.length("title") >= least_title)), ["page_url", "url"], _places(rows))
    rest = seen_first(links, base, least_title=least_title).join(rows.select("page_url").distinct(), "page_url", "left_anti")
    return rows.unionByName(rest.select(rows.columns))


def article_links(links: DataFrame, base: Column) -> DataFrame:
    return block_links(links, base, F.col("href").isin(*NO_ARTICLES), 4)


def post_links(links: DataFrame, base: Column) -> DataFrame:
    return block_links(links, base, F.col("href").contains("/category/") | F.col("href").contains("/tag/"), 6, r"(?:entry|post)-title")


def bounty_links(links: DataFrame, base: Column) -> DataFrame:
    title = F.when(F.length(scalars.stripped(F.coalesce("text", F.lit("")))) < 2, F.col("heading")).otherwise(F.col("text"))
    keep = F.col("href").contains("/bug-bounty/") & ~F.col("href").isin("/bug-bounty/", "/bug-bounty")
    return seen_first(links.withColumn("text", title).filter(keep), base, least_title=3)


def generic_articles(links: DataFrame, base: Column) -> DataFrame:
    """Links of the base's host in headings of blocks, in other headings, then elsewhere in blocks;
    de-duplicated by href, not by URL."""
    inside = F.col("block").isNotNull()
    rank = F.when(inside & (F.col("under") == "h2"), 0).when(inside & (F.col("under") == "h1"), 1).when(F.col("under").isin("h1", "h2"), 2).when(inside, 3)
    rows = resolved(links, base).filter((F.length("title") >= 3) & scalars.same_host(F.col("url"), base)).withColumn("rank", rank)
    return ordering.keep_first(rows.filter(F.col("rank").isNotNull()), ["page_url", "href"], ["rank", *_places(rows)]).drop("rank")


def documentation_links(links: DataFrame, base: Column, patterns: list[str]) -> DataFrame:
    """Links in navigation too: read them before it is dropped."""
    return title_first(links, base, F.col("href").rlike("|".join(f"(?:{p})" for p in patterns)))


def swc_entries(links: DataFrame, base: Column, known: DataFrame | None = None) -> DataFrame:
    """Weakness entries with a normalised id, and rows of a table whose URL is new."""
    rows = resolved(links, base).withColumn("swc_id", scalars.swc_id(F.col("title"), F.col("href"))).filter(F.col("swc_id").isNotNull())
    rows = ordering.keep_first(rows, ["page_url", "url"], _places(rows)).select("swc_id", "title", "url")
    return rows if known is None else rows.unionByName(known.select("swc_id", "title", "url").join(rows, "url", "left_anti"))


def top_entries(links: DataFrame, sections: DataFrame, base: Column) -> DataFrame:
    """Links numbered in their text (which gives the id) or address, and headings with an id of their own
    (``page_url, section_id, title``) that no link names."""
    rows = resolved(links, base).filter("title <> ''").withColumn("sc_id", scalars.sc_id(F.col("title")))
    rows = rows.filter(F.col("sc_id").isNotNull() | F.col("href").rlike(r"(?i)SC\d+"))
    linked = ordering.keep_first(rows, ["page_url", "url"], _places(rows)).select("sc_id", "title", "url")
    headed = sections.filter("title <> ''").select(F.lit(None).cast("string").alias("sc_id"), "title", F.concat("page_url", F.lit("#"), "section_id").alias("url"))
    return linked.unionByName(headed.join(linked.select("url"), "url", "left_anti"))


def pdf_links(links: DataFrame, base: Column) -> DataFrame:
    """Distinct absolute PDF links per page, sorted."""
    rows = links.filter(F.lower("href").endswith(".pdf")).withColumn("url", scalars.join_root(base, F.col("href")))
    return rows.groupBy("page_url").agg(F.sort_array(F.collect_set("url")).alias("pdf_links"))


def with_details(links: DataFrame, pages: DataFrame, source: str, category: str) -> DataFrame:
    """Links with their detail page; a page that never arrived stays as an error row."""
    joined = links.join(pages.withColumn("_there", F.lit(True)), "url", "left")
    error = F.when(F.col("_there").isNull(), "detail page missing")
    return joined.withColumns({"source": F.lit(source), "category": F.lit(category), "listing_title": F.col("title"), "error": error}).drop("_there")


def pagination(template: str, most: int, spark) -> DataFrame:
    """The URLs of a ``{page}`` template."""
    return spark.range(1, most + 1).select(F.replace(F.lit(template), F.lit("{page}"), F.col("id").cast("string")).alias("url"), F.col("id").alias("page"))


def follow_next(edges: DataFrame, starts: DataFrame, most: int) -> DataFrame:
    """(start, url, step) along next links until one repeats, is missing, or ``most`` pages are reached.

    A step joins all chains at once and is written, so a plan has one join whatever the cap, and no step runs once no chain goes on.
    """
    spark = starts.sparkSession
    into = shared.folder(spark, "chains")
    known = edges.filter(F.col("next_url").isNotNull()).select("url", "next_url")
    now = shared.stored(starts.select(F.col("url").alias("start"), "url", F.lit(1).alias("step"), F.array("url").alias("seen")), "chains", f"{into}/part=1")
    schema = now.schema
    for step in range(2, most + 1):
        now = now.join(known, "url").filter(~F.array_contains("seen", F.col("next_url")))
        now = now.select("start", F.col("next_url").alias("url"), F.lit(step).alias("step"), F.concat("seen", F.array("next_url")).alias("seen"))
        now = shared.stored(now, "chains", f"{into}/part={step}")
        if now.isEmpty():
            break
    return spark.read.schema(schema).parquet(f"{into}/part=*").drop("seen")


def section_bodies(headings: DataFrame, bodies: DataFrame, page: list[str] = ["page_url"]) -> DataFrame:  # noqa: B006
    """Headings with the text of the section their id names; headings without one are dropped. ``page`` are the columns that tell pages apart: an
    address alone doesn't where it was fetched twice."""
    return headings.join(bodies.select(*page, "section_id", "body"), [*page, "section_id"])
