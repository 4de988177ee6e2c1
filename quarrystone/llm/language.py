"""Operator 4, language identification by rank-order profiles (out-of-place distance).

A text is lower-cased and split into runs of letters; each run is padded with one blank on either
side and gives n-grams of one to three characters. A language's profile is its ``RANKS`` most
frequent n-grams over all learning rows; a document's is ranked the same way, and the distance sums
the rank differences, ``RANKS`` for an n-gram that the profile lacks. Ties rank by code.

Learning counts every whole text with a non-null language: each task sums its rows per language, the
sums meet by n-gram, and profiles (``RANKS`` rows a language) are the only thing sent to all tasks.
A null text, or one without a letter, is ``und`` with score 0, as is everything when nothing is learned. Of languages
at one distance the first by name wins. Rows that repeat each count in learning and get the same prediction; a null doc_id
stays null; other columns, whatever their names, are ignored; an empty table gives no row. ``MAX_LANGUAGES`` bounds what
reaches the driver (``RANKS`` rows each); a column with more values isn't one of languages, and learning fails on it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANKS = 400
UNKNOWN = "und"
MAX_LANGUAGES = 2000
_LETTERS = re.compile(r"[^\W\d_]+")


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of one text (21 bits a character, length implied) and their counts."""
    if not text:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    runs = _LETTERS.findall(text.lower())
    if not runs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    flat = np.frombuffer((" " + "  ".join(runs) + " ").encode("utf-32-le"), "<u4").astype(np.int64)
    blank = flat == 0x20
    two = (flat[:-1] << 21) | flat[1:]
    three = (two[:-1] << 21) | flat[2:]
    # Two blanks in a row part the words; n-grams across them, and lone blanks, don't count.
    part = blank[:-1] & blank[1:]
    keep3 = ~(part[:-1] | part[1:])
    codes, counts = np.unique(np.concatenate([flat[~blank], two[~part], three[keep3]]), return_counts=True)
    return codes, counts


def ranked(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The most frequent codes, best first; ties by code."""
    if len(codes) > RANKS:
        least = np.partition(counts, len(counts) - RANKS)[len(counts) - RANKS]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))][:RANKS]


def learn(documents: DataFrame) -> dict[str, np.ndarray]:
    """Profiles from all rows of ``documents(text, lang)`` whose lang isn't null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, dict[int, int]] = {}

        def give() -> Iterator[pa.RecordBatch]:
            for lang, n in seen.items():
                columns = [pa.array([lang] * len(n), pa.string()), pa.array(list(n), pa.int64()), pa.array(list(n.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "code", "n"])
            seen.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                codes, counts = grams(text.as_py())
                n = seen.setdefault(lang, {})
                for c, k in zip(codes.tolist(), counts.tolist()):
                    n[c] = n.get(c, 0) + k
            if sum(map(len, seen.values())) > 400_000:
                yield from give()
        yield from give()

    rows = documents.filter(F.col("lang").isNotNull()).select("text", "lang").mapInArrow(count, "lang string, code long, n long")
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = rows.groupBy("lang", "code").agg(F.sum("n").alias("n")).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= RANKS)
    out: dict[str, list[int]] = {}
    # At most RANKS rows a language; a column with thousands of values isn't a language column.
    for row in top.orderBy("lang", "rank").limit(RANKS * MAX_LANGUAGES + 1).collect():
        out.setdefault(row.lang, []).append(row.code)
    if sum(map(len, out.values())) > RANKS * MAX_LANGUAGES:
        raise ValueError("more languages than MAX_LANGUAGES")
    return {k: np.array(v, np.int64) for k, v in sorted(out.items())}


class Profiles:
    """All languages' ranks in one table over the union of their n-grams."""

    def __init__(self, profiles: dict[str, np.ndarray]):
        self.languages = list(profiles)
        self.codes = np.unique(np.concatenate([*profiles.values(), np.empty(0, np.int64)]))
        self.ranks = np.full((len(self.codes) + 1, len(profiles)), -1, np.int64)
        for k, v in enumerate(profiles.values()):
            self.ranks[np.searchsorted(self.codes, v), k] = np.arange(len(v))

    def classify(self, text: str | None) -> tuple[str, float]:
        codes, counts = grams(text)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0
        own = ranked(codes, counts)
        at = np.searchsorted(self.codes, own)
        at[at == len(self.codes)] = 0
        at = np.where(self.codes[at] == own, at, len(self.codes))
        ranks = self.ranks[at]
        away = np.where(ranks < 0, RANKS, np.abs(ranks - np.arange(len(own))[:, None]))
        distance = away.sum(axis=0)
        k = int(np.argmin(distance))
        return self.languages[k], 1.0 - float(distance[k]) / (RANKS * len(own))


def identify(documents: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score for every row; only the text is looked at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Profiles(profiles)
        for batch in batches:
            got = [table.classify(text.as_py()) for text in batch.column(1)]
            columns = [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id="doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from three folds of the corpus, predict every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    profiles = learn(documents.filter(~held_out()))
    found = identify(documents, profiles)
    return found.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
