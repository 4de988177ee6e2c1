"""Operator 9, line deduplication by winnowing over line hashes. DataFrame functions only.

The lines of a text that hold a word are hashed. In every window of ``min_run`` such lines the least hash
(rightmost on ties) is selected as a fingerprint, so a run of ``min_run`` lines that stands in two places has
a fingerprint in common, at the same line. Only selected lines are staged, each with its extensions: 128-bit hashes
of the k lines before it through the ``min_run`` - 1 - k after it, for every k whose window selected it.
Positions that share a fingerprint are joined through the first place (doc_id, text hash, line) of each extension, not
pair by pair, so a line in millions of texts costs one row each; a window that stands earlier too is a later repeat, and
overlapping ones make up the whole repeated run. Windows are judged on the input; a first occurrence always stays.
Runs shorter than ``min_run`` stay: a lone common line ("All rights reserved.") is no evidence of a copied passage, and
removing it would tear clean texts. A line of ``LONG_LINE`` words or more is a passage by itself, though: it is
always a fingerprint, and a run of one such line counts.

Lines without a word are kept as they are. Null text counts as empty. Rows without a doc_id stay as they are and
are no one's first occurrence. Rows that share a doc_id but not a text are judged apart, the smaller text hash first;
rows equal in both are cut alike. An empty table gives no row. All columns pass through, whatever their names; only
``text`` is cut, and columns called n_lines or n_removed are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import staging

MIN_RUN = 2
LONG_LINE = 20
_WORD = r"[^\x20\x09-\x0D]"
# Possessive and anchored, so that no line is scanned twice.
_LONG = rf"^[\x20\x09-\x0D]*+(?:{_WORD}++[\x20\x09-\x0D]++){{{LONG_LINE - 1}}}{_WORD}"


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _spots(lines):
    """Numbers of the lines that hold a word."""
    numbered = F.transform(lines, lambda line, i: F.struct(i.alias("at"), line.alias("line")))
    return F.transform(F.filter(numbered, lambda x: x["line"].rlike(_WORD)), lambda x: x["at"])


def _copy():
    """Tells rows of one doc_id apart."""
    return F.xxhash64("text")


def fingerprints(documents: DataFrame, min_run: int) -> DataFrame:
    """doc_id, copy, spot (among lines with a word), mark, and the extensions: lines back, lines, window hash one and two."""
    real = F.filter(_lines(F.col("text")), lambda line: line.rlike(_WORD))
    hashed = documents.filter(F.col("doc_id").isNotNull() & F.col("text").rlike(_WORD)).select(
        F.col("doc_id").cast("long").alias("doc_id"), _copy().alias("copy"),
        F.transform(real, lambda line: F.struct(F.xxhash64(line).alias("one"), F.xxhash64(F.lit(min_run), line).alias("two"), line.rlike(_LONG).alias("long"))).alias("h"),
    )

    def selects(start, spot):
        """Whether the window at ``start`` has its least hash at ``spot``: of equals the last, which has the smaller negated offset."""
        low = F.array_min(F.transform(F.slice("h", start + 1, min_run), lambda x, j: F.struct(x["one"].alias("mark"), (-j).alias("back"))))
        return (start <= F.size("h") - min_run) & (start - low["back"] == spot)

    def extension(spot, k, lines=min_run):
        part = F.slice("h", spot - k + 1, lines)
        whole = (F.xxhash64(F.transform(part, lambda x: x[name])).alias(name) for name in ("one", "two"))
        return F.struct(k.alias("back"), F.lit(lines).alias("lines"), *whole)

    def position(x, spot):
        reach = F.filter(F.sequence(F.lit(0), F.least(F.lit(min_run - 1), spot)), lambda k: selects(spot - k, spot))
        extensions = F.transform(reach, lambda k: extension(spot, k))
        if min_run > 1:
            extensions = F.when(x["long"], F.array_append(extensions, extension(spot, F.lit(0), 1))).otherwise(extensions)
        return F.struct(spot.alias("spot"), x["one"].alias("mark"), extensions.alias("extensions"))

    return hashed.select("doc_id", "copy", F.inline(F.filter(F.transform("h", position), lambda p: F.size(p["extensions"]) > 0)))


def later_windows(documents: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, copy, starts): windows, as first line and number of lines, that start earlier too."""
    each = staging.staged(fingerprints(documents, min_run), "marks")
    # Staged, here and below, so that joins are of plain exchanges and a hot key's rows can be split.
    shared = staging.staged(each.groupBy("mark").agg(F.count("*").alias("n")).filter("n > 1").select("mark"), "shared")
    near = each.join(shared, "mark").select("doc_id", "copy", "spot", F.inline("extensions"))
    near = staging.staged(near.select("doc_id", "copy", (F.col("spot") - F.col("back")).alias("start"), "lines", "one", "two"), "near")
    staging.release(each)
    place = F.struct("doc_id", "copy", "start")
    first = staging.staged(near.groupBy("one", "two").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first < last").select("one", "two", "first"), "firsts")
    later = near.join(first, ["one", "two"]).filter(place > F.col("first"))
    # A document's own windows: bounded by its lines.
    return later.groupBy("doc_id", "copy").agg(F.collect_set(F.struct("start", "lines")).alias("starts"))


def remove_repeated_lines(documents: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """All columns of ``documents`` with ``text`` cut, and n_lines (with a word) and n_removed."""
    named = documents.drop("n_lines", "n_removed")
    doc, copy, starts, mine, lines, spots, gone = staging.fresh(named.columns, "doc", "copy", "starts", "mine", "lines", "spots", "gone")
    later = later_windows(documents, min_run).withColumnsRenamed({"doc_id": doc, "copy": copy, "starts": starts})
    keyed = named.withColumn(mine, _copy())
    joined = keyed.join(later, (F.col("doc_id").cast("long") == F.col(doc)) & (F.col(mine) == F.col(copy)), "left")
    split = joined.withColumn(lines, _lines(F.col("text"))).withColumn(spots, _spots(F.col(lines)))
    found = F.array_distinct(F.flatten(F.transform(starts, lambda s: F.slice(spots, s["start"] + 1, s["lines"]))))
    marked = split.withColumn(gone, F.coalesce(found, F.array().cast("array<int>")))
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(gone))
    cut = F.array_join(F.transform(left, lambda i: F.element_at(lines, i + 1)), "\n")
    text = F.when(F.size(gone) > 0, cut).otherwise(F.col("text"))
    counted = marked.withColumn("n_lines", F.size(spots).cast("long")).withColumn("n_removed", F.size(gone).cast("long")).withColumn("text", text)
    return counted.drop(doc, copy, starts, mine, lines, spots, gone)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove later repeated runs of lines, and long lines that stand earlier, from the whole corpus."""
    found = remove_repeated_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP9_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
),
spoken AS (
  SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS i
  FROM lines WHERE regexp_matches(line, '{_WORD}')
),
windows AS (
  SELECT a.doc_id, a.i, 2 AS width, a.line AS x, b.line AS y
  FROM spoken a JOIN spoken b ON a.doc_id = b.doc_id AND b.i = a.i + 1
  UNION ALL
  SELECT doc_id, i, 1, line, '' FROM spoken
  WHERE len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) >= {LONG_LINE}
),
ranked AS (SELECT doc_id, i, width, row_number() OVER (PARTITION BY width, x, y ORDER BY doc_id, i) AS turn FROM windows),
gone AS (
  SELECT DISTINCT doc_id, i + d AS i FROM ranked, (VALUES (0), (1)) AS t(d) WHERE turn > 1 AND d < width
),
marked AS (
  SELECT l.doc_id, l.pos, l.line, s.i IS NOT NULL AS spoken, g.i IS NOT NULL AS gone
  FROM lines l LEFT JOIN spoken s ON l.doc_id = s.doc_id AND l.pos = s.pos
  LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.i = g.i
)
SELECT doc_id, count(*) FILTER (WHERE spoken)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
