"""Acquisition runs: clone and download status, budgets, rate limits, directory totals."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone import shared
from quarrystone.functions import scalars


def clone_summary(results: DataFrame) -> DataFrame:
    """Totals by status, and success and failure by category and by priority, as grouping rows."""
    good = F.col("status").isin("cloned", "updated")
    sets = results.groupingSets([["category"], ["priority"], []], "category", "priority")
    return sets.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "cloned").alias("cloned"), F.count_if(F.col("status") == "updated").alias("updated"),
        F.count_if(good).alias("success"), F.count_if(~good).alias("failed"),
    )


def clone_errors(results: DataFrame) -> DataFrame:
    return results.filter(F.coalesce("error", F.lit("")) != "").select(F.col("name").alias("repo"), "error")


def registry_summary(sources: DataFrame) -> DataFrame:
    """Counts by type and category with subtotals; every priority is counted by itself."""
    rows = sources.rollup("source_type", "category").agg(F.count("*").alias("total"), *(F.count_if(F.col("priority") == p).alias(p) for p in ("high", "medium", "low")), F.grouping_id().alias("level"))
    return rows


def download_rollup(results: DataFrame, group: list[str]) -> DataFrame:
    """Total, successes (a path is there), failures, and whether all succeeded."""
    good = F.col("path").isNotNull()
    return results.groupBy(*group).agg(F.count("*").alias("total"), F.count_if(good).alias("success"), F.count_if(~good).alias("failed"), F.bool_and(good).alias("all_success"))


def extension_histogram(files: DataFrame, path: str = "rel_path") -> DataFrame:
    return files.groupBy(scalars.extension(F.col(path)).alias("extension")).agg(F.count("*").alias("n"))


def directory_totals(files: DataFrame, directory: Column, marker: str = ".downloaded") -> DataFrame:
    """Per directory: files and bytes without marker files, and the size as text."""
    real = files.filter(~F.col("rel_path").endswith(marker)).withColumn("directory", directory)
    totals = real.groupBy("directory").agg(F.count("*").alias("file_count"), F.sum("size_bytes").alias("total_bytes"))
    return totals.withColumn("total_size", scalars.human_size(F.col("total_bytes")))


def dataset_status(defaults: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Every default dataset with whether it is on disk, and its totals."""
    joined = defaults.join(found.withColumn("_there", F.lit(True)), key, "left")
    return joined.withColumn("downloaded", F.coalesce("_there", F.lit(False))).drop("_there")


def budget_phases(phases: DataFrame, rate: float) -> DataFrame:
    hours = F.col("gpu_count") * F.col("hours")
    return phases.withColumns({"gpu_hours": hours, "cost_usd": hours * rate})


def budget_totals(phases: DataFrame, rate: float, budget: float) -> DataFrame:
    """One row: planned, purchased and reserve hours and the cost, with a flag where the plan exceeds the budget."""
    totals = budget_phases(phases, rate).agg(F.coalesce(F.sum("gpu_hours"), F.lit(0.0)).alias("planned"), F.coalesce(F.sum("cost_usd"), F.lit(0.0)).alias("cost"))
    bought = F.lit(budget) / F.lit(rate)
    return totals.select(F.round("planned", 4).alias("planned_hours"), F.round("cost", 4).alias("planned_cost_usd"), F.round(bought, 4).alias("purchased_hours"), F.round(bought - F.col("planned"), 4).alias("reserve_hours"), (bought < F.col("planned")).alias("over_budget"))


def budget_table(phases: DataFrame, rate: float) -> DataFrame:
    """Aligned text lines."""
    rows = budget_phases(phases, rate)
    return rows.select("name", F.format_string("%-28s %4d x %8.2f h = %10.2f h  $%12.2f", F.col("name"), F.col("gpu_count"), F.col("hours"), F.col("gpu_hours"), F.col("cost_usd")).alias("line"))


def rate_limited(calls: DataFrame, service: str, seconds: Column, period: int, calls_allowed: int, burst: int = 0) -> DataFrame:
    """Earlier calls of the same service inside the trailing period, whether this one may proceed, and how
    long it would wait. The call itself doesn't count; equal seconds count for each other.

    A service's calls are dealt by periods, each with the one before for context, so no task holds its history.
    """
    at = calls.withColumn("_s", seconds)
    now = F.floor(F.col("_s") / period)
    spread = at.withColumn("_period", F.explode(F.array(now, now + 1)))
    frame = Window.partitionBy(service, "_period").orderBy("_s").rangeBetween(-period + 1, 0)
    rows = spread.withColumns({"earlier": F.count("*").over(frame) - 1, "_oldest": F.min("_s").over(frame)})
    rows = rows.filter(F.col("_period") == now).drop("_period")
    allowed = F.col("earlier") < calls_allowed + burst
    wait = F.when(allowed, F.lit(0)).otherwise(F.greatest(F.lit(0), F.col("_oldest") + period - F.col("_s")))
    return rows.withColumns({"can_proceed": allowed, "wait_seconds": wait}).drop("_s", "_oldest")


def carried(blocks: DataFrame, keys: list[str], block: str, value: str, how: Callable[[Column], Column], join: Callable[[Column, Column], Column], group: int = 1024) -> DataFrame:
    """``blocks`` with ``before``: ``how`` over the values of the key's earlier blocks (null for none).

    In two levels, inside groups of ``group`` blocks and over groups, so no window sees all blocks of a key.
    """
    rows = blocks.withColumn("_group", F.floor(F.col(block) / group))
    inner = Window.partitionBy(*keys, "_group").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    groups = rows.groupBy(*keys, "_group").agg(how(F.col(value)).alias("_all")).withColumn("_groups", how(F.col("_all")).over(outer)).drop("_all")
    inside = rows.withColumn("_inside", how(F.col(value)).over(inner)).join(groups, [*keys, "_group"])
    both = F.when(F.col("_inside").isNull(), F.col("_groups")).when(F.col("_groups").isNull(), F.col("_inside")).otherwise(join(F.col("_inside"), F.col("_groups")))
    return inside.withColumn("before", both).drop("_group", "_inside", "_groups")


def delayed_calls(calls: DataFrame, service: str, seconds: Column, event: str, period: int, calls_allowed: int, burst: int = 0) -> DataFrame:
    """When each call starts (``start_second``) and how long it has waited, if calls wait for their turn and are recorded when they start.

    Calls are taken by second, then by ``event``. With m = ``calls_allowed`` + ``burst``, call i starts at its second or, if that is later, one
    period after call i - m has started. So calls i, i + m, i + 2m, ... are a chain, and the k-th of a chain starts at
    k * period + the largest (second - k * period) among its first k: a running maximum. Numbers and maxima are taken inside
    blocks of a service's calls of one period and carried over blocks, so no task sees the history of a service, only the calls of
    a period. Calls without a second start never (null); a null service is one of its own.
    """
    most = calls_allowed + burst
    if most < 1:
        raise ValueError("no call is ever allowed")
    named = calls.withColumns({"_key": F.struct(service), "_s": seconds}).withColumn("_block", F.floor(F.col("_s") / period))
    known = named.filter("_s IS NOT NULL")
    add, larger = (lambda x, y: x + y), F.greatest
    sizes = carried(known.groupBy("_key", "_block").agg(F.count("*").alias("_n")), ["_key"], "_block", "_n", F.sum, add).select("_key", "_block", F.col("before").alias("_before"))
    turn = F.row_number().over(Window.partitionBy("_key", "_block").orderBy("_s", event)) - 1
    placed = known.withColumn("_turn", turn).join(sizes, ["_key", "_block"]).withColumn("_turn", F.col("_turn") + F.coalesce("_before", F.lit(0))).drop("_before")
    linked = placed.withColumns({"_chain": F.pmod("_turn", F.lit(most)), "_link": F.floor(F.col("_turn") / most)}).withColumn("_free", F.col("_s") - F.col("_link") * period)
    linked = shared.stored(linked, "calls")
    tops = carried(linked.groupBy("_key", "_block", "_chain").agg(F.max("_free").alias("_top")), ["_key", "_chain"], "_block", "_top", F.max, larger).select("_key", "_block", "_chain", F.col("before").alias("_before"))
    own = F.max("_free").over(Window.partitionBy("_key", "_block", "_chain").orderBy("_link").rowsBetween(Window.unboundedPreceding, 0))
    rows = linked.withColumn("_own", own).join(tops, ["_key", "_block", "_chain"])
    start = F.col("_link") * period + F.greatest("_own", "_before")
    done = rows.select(*calls.columns, start.alias("start_second"), (start - F.col("_s")).alias("waited"))
    never = named.filter("_s IS NULL").select(*calls.columns, F.lit(None).cast("long").alias("start_second"), F.lit(None).cast("long").alias("waited"))
    return done.union(never)


def phase_summary(phases: list[DataFrame]) -> DataFrame:
    """Results of several phases as one table; columns that a phase lacks are null."""
    out = phases[0]
    for more in phases[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


# Ecosystems that the first version takes.
ECOSYSTEMS = ("evm", "solidity")


def eligibility(findings: DataFrame) -> DataFrame:
    """``eligibility`` of findings (``ecosystem``, ``is_loss_of_funds``): ``eligible``, ``other ecosystem``, ``no loss of funds``, or ``review`` where one of both is
    unknown and nothing speaks against it. A severity decides nothing, since firms rate differently. Every finding stays."""
    ecosystem, loss = F.lower(scalars.stripped(F.col("ecosystem"))), F.col("is_loss_of_funds")
    known = F.nullif(ecosystem, F.lit(""))
    state = F.when(~known.isin(*ECOSYSTEMS), "other ecosystem").when(~loss, "no loss of funds").when(known.isNull() | loss.isNull(), "review").otherwise("eligible")
    return findings.withColumn("eligibility", state)


def eligible_findings(findings: DataFrame) -> DataFrame:
    """Findings that may become tasks; all others stay in the inventory."""
    return eligibility(findings).filter("eligibility = 'eligible'").drop("eligibility")


def scored_matches(reports: DataFrame, repositories: DataFrame, key: str, evidence: dict[str, Column]) -> DataFrame:
    """The best repository of each report on a shared key, by weighted evidence, with a confidence class.

    Evidence is any condition on a pair, so all pairs of a key are made: for keys of few repositories. ``best_matches`` makes none.
    """
    score = F.lit(0.0)
    for condition in evidence.values():
        score = score + F.when(condition, 1.0 / len(evidence)).otherwise(0.0)
    rows = reports.join(repositories, key).withColumn("score", score)
    best = rows.withColumn("_turn", F.row_number().over(Window.partitionBy("pdf_id").orderBy(F.desc("score"), "repo_id"))).filter("_turn = 1").drop("_turn")
    return best.withColumn("confidence", confidence(F.col("score")))


def confidence(score: Column) -> Column:
    return F.when(score >= 0.99, "exact").when(score >= 0.5, "probable").otherwise("weak")


# Cells of doubles near each other go so far, and what lies beyond is in the last ones. Doubles there are 1 / 4,096 of a cell apart.
CELLS = 2.0**40


def best_matches(reports: DataFrame, repositories: DataFrame, key: str, same: dict[str, tuple[Column, Column]], near: dict[str, tuple] | None = None) -> DataFrame:
    """(pdf_id, repo_id, score, confidence): the best repository of each report on a shared key, without a pair of both being made.

    Evidence is what a report and a repository have the ``same`` of (two columns of one type; null agrees with nothing), and for at most one
    name two numbers ``near`` each other, less than so much apart: (x, y, width) for whole numbers, or (x, y, width, unit) for what is near where
    ``abs(x - y) < width`` in doubles. The score is the share of evidence that agrees; of equal scores the smallest
    repo_id wins. For each subset of evidence the smallest repo_id is aggregated by the values of that subset, so a report meets one
    row a subset, however many repositories share its key. Near numbers meet in dyadic intervals: a repository stands in one
    interval a level, a report asks for the few that make up its range. Doubles stand in cells of one unit, and are compared one by one
    in the cells at the ends of a range only, so the unit should be about the step of most. Reports whose key no repository has, or is null, have no row; those of one pdf_id are one.
    """
    if len(near or {}) > 1:
        raise ValueError("one near number at most")
    subsets = [s for k in range(len(same) + 1) for s in itertools.combinations(same, k)]
    # Named this way, since aliases inside of conditions are lost.
    named = lambda **fields: F.named_struct(*(c for name, v in fields.items() for c in (F.lit(name), v)))
    exact = any(len(given) > 3 for given in (near or {}).values())
    node = lambda level, prefix, number=None: named(level=F.lit(level), prefix=prefix, **({"number": F.lit(number).cast("double")} if exact else {}))
    whole = F.array(node(-1, F.lit(0).cast("long")))
    held, asked, bounds, limit = whole, whole, ({}, {}), F.lit(None)
    shifted = lambda number, level: F.call_function("shiftright", number, level)
    for mine, theirs, width, *unit in (near or {}).values():
        if exact:
            mine, theirs, limit = mine.cast("double"), theirs.cast("double"), F.lit(float(width))
            # Of cells the order alone is used: what stands in a later one is larger. The slack is more than rounding takes.
            cell = lambda x: F.when(x.isNotNull(), F.floor(F.greatest(F.least(x / unit[0] + 0.5, F.lit(CELLS)), F.lit(-CELLS))))
            slack = unit[0] / 64
            bounds = ({"_first": cell(mine - width - slack), "_low": cell(mine - width + slack) + 1, "_high": cell(mine + width - slack), "_last": cell(mine + width + slack), "_number": mine}, {"_there": cell(theirs), "_number": theirs})
            span = math.ceil(2 * width / unit[0]) + 1
        else:
            bounds, span = ({"_low": mine.cast("long") - width + 1, "_high": mine.cast("long") + width}, {"_there": theirs.cast("long")}), 2 * width
        levels = F.sequence(F.lit(0), F.lit(span.bit_length()))
        number = lambda level: F.when(level == 0, F.col("_number")) if exact else None
        held = F.when(F.col("_there").isNull(), whole).otherwise(F.concat(whole, F.transform(levels, lambda level: node(level, shifted(F.col("_there"), level), number(level)))))

        # What is left of [low, high) at a level: odd ends are intervals of their own, the rest goes a level up.
        first, end = (lambda level: -shifted(-F.col("_low"), level)), (lambda level: shifted(F.col("_high"), level))
        left = F.filter(levels, lambda level: (first(level) < end(level)) & (F.abs(first(level) % 2) == 1))
        right = F.filter(levels, lambda level: (first(level) < end(level)) & (F.abs(end(level) % 2) == 1))
        ends = [whole, F.transform(left, lambda level: node(level, first(level))), F.transform(right, lambda level: node(level, end(level) - 1))]
        if exact:
            cells = F.array_distinct(F.concat(F.sequence("_first", F.col("_low") - 1), F.sequence("_high", "_last")))
            ends.append(F.transform(cells, lambda at: node(0, at, F.col("_number"))))
        asked = F.when(F.col("_low").isNull(), whole).otherwise(F.concat(*ends))

    values, places = [f"_v{i}" for i in range(len(same))], ["level", "prefix", *["number"] * exact]
    tasks = int(reports.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def spread(rows: DataFrame, side: int, nodes: Column, *kept: str) -> DataFrame:
        choices = []
        for at, subset in enumerate(subsets):
            known, chosen = F.lit(True), {}
            for v, name in zip(values, same):
                chosen[v] = F.when(F.lit(name in subset), same[name][side])
                known = known & (same[name][side].isNotNull() | F.lit(name not in subset))
            choices.append(F.when(known, named(_of=F.lit(at), **chosen)))
        # Dealt by their ids first, while they are narrow: what follows makes tens of rows of one. Both are exploded as they are made:
        # of columns that hold them a filter is inferred, which makes them once more where the few files are read.
        flat = rows.withColumns(bounds[side]).repartition(tasks, *kept).select("*", F.explode(nodes).alias("_node"))
        flat = flat.select(key, *kept, "_node", F.explode(F.array_compact(F.array(*choices))).alias("_value"))
        return flat.select(key, *kept, *(f"_value.{c}" for c in ("_of", *values)), *(f"_node.{c}" for c in places))

    # Plain columns and minima of single values, which are hashed, not sorted. Written, so that the join is of plain exchanges
    # and the reports of a frequent key can be split.
    least = spread(repositories, 1, held, "repo_id").groupBy(key, "_of", *values, *places).agg(F.min("repo_id").alias("repo_id"))
    least = shared.stored(least, "matches").select("repo_id", *(F.col(c).alias(f"_their{c}") for c in (key, "_of", *values, *places)))
    mine = spread(reports, 0, asked, "pdf_id")
    meet = F.lit(True)
    for c in (key, "_of", "level", "prefix"):
        meet = meet & (mine[c] == least[f"_their{c}"])
    for v in values:
        meet = meet & mine[v].eqNullSafe(least[f"_their{v}"])
    if exact:
        meet = meet & (mine["number"].isNull() | (F.abs(mine["number"] - least["_theirnumber"]) < limit))
    sizes = F.array(*(F.lit(len(subset)) for subset in subsets))
    agreed = F.get(sizes, mine["_of"]) + (mine["level"] >= 0).cast("int")
    # Its rows are many times their bytes in files: never sent whole through the driver.
    met = mine.join(least.hint("merge"), meet).select("pdf_id", (-agreed).alias("rank"), "repo_id")
    ranks = met.groupBy("pdf_id", "rank").agg(F.min("repo_id").alias("repo_id"))
    best = ranks.groupBy("pdf_id").agg(F.min(F.struct("rank", "repo_id")).alias("_best"))
    score = -F.col("_best.rank") / F.lit(float(max(1, len(same) + len(near or {}))))
    return best.select("pdf_id", F.col("_best.repo_id").alias("repo_id"), score.alias("score")).withColumn("confidence", confidence(F.col("score")))


def findings_with_evidence(findings: DataFrame, pages: DataFrame) -> DataFrame:
    """Findings with their evidence pages, joined on exploded page numbers."""
    flat = findings.select("*", F.explode("evidence_pages").alias("page_number"))
    return flat.join(pages, ["pdf_id", "page_number"])


def severity_counts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """Finding headings such as ``H-01`` by severity."""
    found = F.explode(F.regexp_extract_all(F.col(text), F.lit(r"\b([HMLQG])-\d{1,3}\b"), F.lit(1)))
    return texts.select(key, found.alias("severity")).groupBy(key, "severity").agg(F.count("*").alias("n"))


def inverted_index(documents: DataFrame) -> DataFrame:
    """term, documents it is in, occurrences."""
    terms = documents.select("doc_id", F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("term")).filter("term <> ''")
    return terms.groupBy("term", "doc_id").agg(F.count("*").alias("n")).groupBy("term").agg(F.count("*").alias("documents"), F.sum("n").alias("occurrences"))


def category_overlay(sources: DataFrame, results: DataFrame, category: str, priority: str | None = None) -> DataFrame:
    """The sources of one category (and priority) with what their clone came to; those without a result are null."""
    wanted = sources.filter(F.col("category") == category)
    if priority:
        wanted = wanted.filter(F.col("priority") == priority)
    return wanted.join(results.select("url", "status", "error"), "url", "left")


# The fields of a normalised record behind its id, in order.
RECORD_FIELDS = ("source", "type", "swc_id", "cwe_id", "severity", "title", "description", "code_snippet", "file_path", "line_numbers", "tags", "timestamp")
_RECORD_LISTS = {"line_numbers": "array<int>", "tags": "array<string>"}


def normalized_records(rows: DataFrame, kind: str = "vulnerability") -> DataFrame:
    """The thirteen fields of a normalised record: those that ``rows`` has, cleaned, and nulls (empty lists) for the others.

    Severities are in lower case, weakness ids as ``SWC-n`` and ``CWE-n``, lists sorted and distinct, the timestamp in UTC; ``id``
    is the digest of the other fields.
    """
    there = set(rows.columns)

    def field(name: str) -> Column:
        if name in _RECORD_LISTS:
            given = F.col(name).cast(_RECORD_LISTS[name]) if name in there else F.lit(None).cast(_RECORD_LISTS[name])
            return F.sort_array(F.array_distinct(F.coalesce(given, F.array().cast(_RECORD_LISTS[name]))))
        if name not in there:
            return F.lit(kind if name == "type" else None).cast("string")
        if name == "timestamp":
            return F.date_format(F.col(name).cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
        text = F.nullif(scalars.stripped(F.col(name).cast("string")), F.lit(""))
        if name in ("swc_id", "cwe_id"):
            number = F.nullif(F.regexp_extract(text, r"(\d+)", 1), F.lit(""))
            return F.concat(F.lit(f"{name[:3].upper()}-"), number)
        return F.lower(text) if name == "severity" else text

    fields = rows.select(*(field(name).alias(name) for name in RECORD_FIELDS))
    texts = [F.array_join(name, ",") if name in _RECORD_LISTS else F.coalesce(F.col(name), F.lit("")) for name in RECORD_FIELDS]
    return fields.select(F.sha2(F.concat_ws("\u001f", *texts), 256).alias("id"), "*")


def vulnerability_records(rows: DataFrame, fields: list[str]) -> DataFrame:
    """Rows with a content id over the normalised fields."""
    return rows.withColumn("id", F.sha2(F.concat_ws("\u001f", *(F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields)), 256))


def candidates(findings: DataFrame) -> DataFrame:
    """Findings grouped to one candidate per report and matched repository."""
    return findings.groupBy("pdf_id", "match_id").agg(F.count("*").alias("findings"), F.sort_array(F.collect_set("severity")).alias("severities"))
