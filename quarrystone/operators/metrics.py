"""Evaluation metrics, group statistics, splits and gates. These follow written specifications; where
they leave a choice open it is stated: population deviation, epsilon 1e-6, equal weights, ten equal bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrystone import shared

EPSILON = 1e-6
BINS = 10


def precision_recall(predictions: DataFrame, group: list[str], truth: Column, predicted: Column) -> DataFrame:
    """tp, fp, fn, precision, recall, f1 and false-positive rate per bucket; buckets aren't averaged."""
    tp, fp, fn, tn = (F.count_if(t & p) for t, p in ((truth, predicted), (~truth, predicted), (truth, ~predicted), (~truth, ~predicted)))
    rows = predictions.groupBy(*group).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    precision = F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fp"))
    recall = F.col("tp") / F.greatest(F.lit(1), F.col("tp") + F.col("fn"))
    rows = rows.withColumns({"precision": precision, "recall": recall, "fpr": F.col("fp") / F.greatest(F.lit(1), F.col("fp") + F.col("tn"))})
    return rows.withColumn("f1", 2 * F.col("precision") * F.col("recall") / F.greatest(F.lit(1e-9), F.col("precision") + F.col("recall")))


def set_scores(rows: DataFrame, expected: str, actual: str) -> DataFrame:
    """Precision, recall and F1 of two array columns per row."""
    both = F.size(F.array_intersect(expected, actual))
    precision = both / F.greatest(F.lit(1), F.size(F.array_distinct(actual)))
    recall = both / F.greatest(F.lit(1), F.size(F.array_distinct(expected)))
    return rows.withColumns({"precision": precision, "recall": recall}).withColumn("f1", 2 * F.col("precision") * F.col("recall") / F.greatest(F.lit(1e-9), F.col("precision") + F.col("recall")))


def calibration_bins(rows: DataFrame, score: str, truth: str, bins: int = BINS) -> DataFrame:
    """Per equal-width bin of the score: rows, accuracy, confidence."""
    number = F.least(F.lit(bins), F.floor(F.col(score) * bins) + 1).cast("int")
    return rows.groupBy(number.alias("bin")).agg(F.count("*").alias("n"), F.avg(truth).alias("accuracy"), F.avg(score).alias("confidence"), F.sum(F.pow(F.col(score) - F.col(truth), 2)).alias("squared"))


def brier_ece(rows: DataFrame, score: str, truth: str, bins: int = BINS) -> DataFrame:
    """One row: the Brier score and the expected calibration error."""
    gap = F.col("n") * F.abs(F.col("accuracy") - F.col("confidence"))
    return calibration_bins(rows, score, truth, bins).agg((F.sum("squared") / F.sum("n")).alias("brier"), (F.sum(gap) / F.sum("n")).alias("ece"))


def selective_risk(rows: DataFrame, score: str, error: Column, thresholds: list[float]) -> DataFrame:
    """Coverage and mean error of the rows at or above each threshold."""
    cuts = F.explode(F.array(*(F.lit(t) for t in thresholds)))
    marked = rows.select(F.col(score).alias("_score"), error.cast("double").alias("_error"), cuts.alias("threshold"))
    kept = F.col("_score") >= F.col("threshold")
    return marked.groupBy("threshold").agg((F.count_if(kept) / F.count("*")).alias("coverage"), F.avg(F.when(kept, F.col("_error"))).alias("risk"))


def recall_at_k(rows: DataFrame, score: str, truth: Column, key: str, ks: list[int]) -> DataFrame:
    """recall@k, enrichment@k and the share of replays saved, for the k best by score (ties by key).

    Only the largest k rows are ranked, by a distributed top-k.
    """
    marked = rows.select(F.col(score).alias("_score"), F.col(key).alias("_key"), truth.cast("int").alias("_truth"))
    totals = marked.agg(F.sum("_truth").alias("positives"), F.count("*").alias("total"))
    top = marked.orderBy(F.desc("_score"), "_key").limit(max(ks)).withColumn("_rank", F.row_number().over(Window.orderBy(F.desc("_score"), "_key")))
    cuts = top.select("*", F.explode(F.array(*(F.lit(k) for k in ks))).alias("k")).filter("_rank <= k")
    found = cuts.groupBy("k").agg(F.sum("_truth").alias("hits"))
    share = F.col("hits") / F.greatest(F.lit(1), F.col("positives"))
    return found.crossJoin(F.broadcast(totals)).select("k", "hits", share.alias("recall"), (share / (F.col("k") / F.col("total"))).alias("enrichment"), (1 - F.col("k") / F.col("total")).alias("replay_savings"))


def first_divergence(steps: DataFrame, group: str, step: str, error: str, threshold: float) -> DataFrame:
    """The first step whose error passes the threshold (null: none) and the number of steps."""
    return steps.groupBy(group).agg(F.min(F.when(F.col(error) > threshold, F.col(step))).alias("first_divergence"), F.max(step).alias("last_step"))


def survival_at_k(divergence: DataFrame, ks: list[int]) -> DataFrame:
    """The share of sequences that haven't diverged within k steps."""
    rows = divergence.select("first_divergence", F.explode(F.array(*(F.lit(k) for k in ks))).alias("k"))
    alive = F.col("first_divergence").isNull() | (F.col("first_divergence") > F.col("k"))
    return rows.groupBy("k").agg(F.avg(alive.cast("int")).alias("survival"))


def group_advantage(rows: DataFrame, group: str, reward: str) -> DataFrame:
    """Reward against its group's mean in population deviations; the raw reward stays. Group sums are
    joined back, so a group of any size is spread over tasks."""
    # Written, so that the join is of plain exchanges and the rows of a large group can be split.
    stats = shared.stored(rows.groupBy(group).agg(F.avg(reward).alias("_mean"), F.stddev_pop(reward).alias("_std")), "groups")
    return rows.join(stats, group).withColumn("advantage", (F.col(reward) - F.col("_mean")) / (F.col("_std") + EPSILON)).drop("_mean", "_std")


def temporal_holdout(rows: DataFrame, time: str, share: float) -> DataFrame:
    """``split``: the newest whole days that hold at most ``share`` of the rows evaluate, older days train.

    Only the counts per day are ranked, so no task sees the rows' whole order.
    """
    day = F.to_date(time)
    days = rows.groupBy(day.alias("_day")).agg(F.count("*").alias("_n"))
    newer = Window.orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, 0)
    total = Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    split = F.when(F.sum("_n").over(newer) <= share * F.sum("_n").over(total), "evaluate").otherwise("train")
    return rows.withColumn("_day", day).join(days.select("_day", split.alias("split")), "_day").drop("_day")


def mix_quota(rows: DataFrame, source: str, key: str, quota: dict[str, float], total: int) -> DataFrame:
    """At most each source's share of ``total`` rows, smallest digests of keys first.

    Digests fall into 4,096 ranges. Running sums over the ranges' counts say which are in whole and which holds a source's last
    row; only that one is ranked, so no task orders a source.
    """
    items = list(quota.items())
    share = F.coalesce(F.create_map(*(F.lit(x) for kv in items for x in kv))[F.col(source)], F.lit(0.0))
    digest = F.md5(F.col(key).cast("string").cast("binary"))
    dealt = rows.filter(F.col(source).isNotNull()).withColumn("_range", F.conv(F.substring(digest, 1, 3), 16, 10).cast("int"))
    sizes = dealt.groupBy(source, "_range").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(source).orderBy("_range"))
    sizes = sizes.withColumns({"_upto": upto, "_most": F.floor(share * total)}).filter(F.col("_upto") - F.col("_n") < F.col("_most"))
    near = dealt.join(sizes, [source, "_range"])
    whole = near.filter("_upto <= _most").select(*rows.columns)
    turn = F.row_number().over(Window.partitionBy(source, "_range").orderBy(digest, key))
    last = near.filter("_upto > _most").withColumn("_turn", turn).filter("_turn + _upto - _n <= _most").select(*rows.columns)
    return whole.union(last)


def acceptance_gates(metrics: DataFrame, gates: DataFrame) -> DataFrame:
    """``metrics(metric, value)`` against ``gates(metric, op, threshold)``; a missing metric fails."""
    rows = gates.join(metrics, "metric", "left")
    passed = F.when(F.col("op") == ">=", F.col("value") >= F.col("threshold")).otherwise(F.col("value") <= F.col("threshold"))
    return rows.withColumn("passed", F.coalesce(passed, F.lit(False)))


def split_counts(rows: DataFrame, split: str, label: str) -> DataFrame:
    return rows.groupBy(split).agg(F.count("*").alias("n"), F.count_distinct(label).alias("labels"))


def item_sketches(rows: DataFrame, dataset: str, item: str, lg_entries: int = 14) -> DataFrame:
    """(dataset, sketch): a mergeable sketch of each dataset's distinct items, exact up to 2**``lg_entries`` of them."""
    return rows.filter(F.col(item).isNotNull()).groupBy(F.col(dataset).alias("dataset")).agg(F.theta_sketch_agg(item, lg_entries).alias("sketch"))


def merged_sketches(parts: DataFrame, lg_entries: int = 14) -> DataFrame:
    """Sketches of parts of datasets as one a dataset."""
    return parts.groupBy("dataset").agg(F.theta_union_agg("sketch", lg_entries).alias("sketch"))


def duplication_risk(sketches: DataFrame) -> DataFrame:
    """For every two datasets the estimated distinct items of each and of both, and the share of the smaller one that the other has too.

    Rows are read once, into one sketch a dataset; pairs are made of sketches only, of which there are as many as datasets (a registry's tens).
    A sketch of more than m = 2**lg_entries items keeps the m least hashes: its count has a relative standard error of 1 / sqrt(m), and that of
    an overlap is larger by the square root of the union's size over the overlap's.
    """
    one = sketches.select(F.col("dataset").alias("a"), F.col("sketch").alias("x"))
    other = sketches.select(F.col("dataset").alias("b"), F.col("sketch").alias("y"))
    size = lambda c: F.theta_sketch_estimate(c)
    pairs = one.join(other, F.col("a") < F.col("b")).select("a", "b", size("x").alias("items_a"), size("y").alias("items_b"), size(F.theta_intersection("x", "y")).alias("shared"))
    return pairs.withColumn("risk", F.col("shared") / F.greatest(F.lit(1), F.least("items_a", "items_b")))


def shared_items(rows: DataFrame, dataset: str, item: str) -> DataFrame:
    """What ``duplication_risk`` estimates, counted: for every two datasets the distinct items of each and of both, and the share of the smaller one.

    Items are dealt by digest and meet as the set of datasets that hold them; sets are counted before they are made pairs, so an item with
    many copies is one row a dataset. Null items, and those of no dataset, don't count.
    """
    there = rows.filter(F.col(item).isNotNull() & F.col(dataset).isNotNull())
    once = there.select(F.col(dataset).alias("dataset"), F.sha2(F.col(item).cast("string"), 256).alias("item")).distinct()
    # One entry a dataset.
    held = once.groupBy("item").agg(F.sort_array(F.collect_list("dataset")).alias("datasets")).groupBy("datasets").agg(F.count("*").alias("n"))
    held = shared.stored(held, "held")
    sizes = held.select(F.explode("datasets").alias("dataset"), "n").groupBy("dataset").agg(F.sum("n").alias("items"))
    firsts = held.filter(F.size("datasets") > 1).select(F.posexplode("datasets").alias("i", "a"), "datasets", "n")
    both = firsts.select("a", F.explode(F.slice("datasets", F.col("i") + 2, F.size("datasets"))).alias("b"), "n").groupBy("a", "b").agg(F.sum("n").alias("shared"))
    one, other = sizes.select(F.col("dataset").alias("a"), F.col("items").alias("items_a")), sizes.select(F.col("dataset").alias("b"), F.col("items").alias("items_b"))
    pairs = one.join(other, F.col("a") < F.col("b")).join(both, ["a", "b"], "left").withColumn("shared", F.coalesce("shared", F.lit(0).cast("long")))
    return pairs.select("a", "b", "items_a", "items_b", "shared", (F.col("shared") / F.least("items_a", "items_b")).alias("risk"))


def minimum_quality(rows: DataFrame, checks: list[str]) -> DataFrame:
    """``admissible``: all checks hold; a null check doesn't."""
    return rows.withColumn("admissible", F.forall(F.array(*(F.coalesce(F.col(c), F.lit(False)) for c in checks)), lambda x: x))


def admitted(rows: DataFrame, evaluation_splits: list[str]) -> DataFrame:
    """Reviewed and approved rows outside evaluation splits."""
    return rows.filter((F.col("review_state") == "approved_for_admission") & ~F.col("split").isin(*evaluation_splits))
