"""Operator 12, phrase collocation mining: counted n-grams, decimal scores, one-word extensions.

A-Z is lower-cased, a text falls into pieces at ``[.,;:!?\\x0A-\\x0D]`` and a piece into words ``[^\\x20\\x09]+``. Everything is per lang (null:
``und``). n-grams of 1 to ``max_n`` words become rows (lang, phrase, n) and are hash-aggregated by lang and phrase, in order of their length: words first, then
pairs of words that reach ``min_count`` each, then all longer n-grams of pairs that do. A phrase is never more frequent than its parts, so what is left
out can't reach ``min_count``, nor can any phrase that holds it: counts are those of all n-grams. What reaches the count is
known to tasks by a bit table of fixed size (``FILTER_BITS``); a bit set by chance costs rows that the count drops, and a full table would
cost more rows, but no result. Phrases are compared as texts, nothing is told apart by hashes.

A phrase's parts have at least its count, so prefix and suffix counts of every cut are equi-joined from the same table. Scores are exact
in decimal(38,0). A phrase goes when a one-word extension of it has ``keep_below`` per cent of its count or more; counts only
fall with length, so that says the same as any longer phrase. Ranks are taken in two rounds, by ``SALTS`` shares of a lang and then over their first
``top``, so no task sorts a whole lang.

Null texts are empty; texts that repeat count each time. A very long text is read in parts of about ``CHUNK`` bytes that end at
piece ends, so memory grows with the longest piece only. An empty table, and one without a phrase of ``min_count``, gives no row. Only lang and
text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarrystone.llm import staging

MAX_N = 5
MIN_COUNT = 100
TOP = 2000
KEEP_BELOW = 100
SALTS = 1024
CHUNK = 2_000_000
FILTER_BITS = 26
BREAKS = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(BREAKS)] = 2
_LOW = np.arange(256, dtype=np.uint8)
_LOW[ord("A") : ord("Z") + 1] += 32
COUNTED = "lang string, phrase string, words int, n long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_AT = _mixed(np.arange(1, 4097, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


class Words:
    """The words of a run of bytes: their texts, one blank apart, their hashes, and the piece that each lies in."""

    def __init__(self, raw: bytes) -> None:
        low = _LOW[np.frombuffer(raw, np.uint8)]
        kind = _KIND[low]
        inside = kind == 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]])))
        begin, end = edge[::2], edge[1::2]
        self.n = len(begin)
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), begin)
        size = end - begin
        self.begin = np.cumsum(size + 1) - size - 1
        self.end = self.begin + size
        letters = low[inside]
        first = np.cumsum(size) - size
        place = np.arange(len(letters))
        self.text = np.full(len(letters) + self.n, 0x20, np.uint8)
        self.text[place + np.repeat(np.arange(self.n), size)] = letters
        if self.n:
            code = _BYTE[letters] * _AT[(place - np.repeat(first, size)) % len(_AT)]
            self.hash = _mixed(np.add.reduceat(code, first))
        else:
            self.hash = np.empty(0, np.uint64)

    def starts(self, words: int) -> np.ndarray:
        """Where n-grams of so many words start that lie in one piece."""
        if self.n < words:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.piece[words - 1 :] == self.piece[: self.n - words + 1])

    def phrases(self, at: np.ndarray, words: int) -> pa.Array:
        begin, size = self.begin[at], self.end[at + words - 1] - self.begin[at]
        upto = np.cumsum(size)
        take = np.arange(upto[-1] if len(upto) else 0) + np.repeat(begin - upto + size, size)
        offsets = np.concatenate([[0], upto]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(self.text[take]))


def _bit(lang: str, *hashes: np.ndarray) -> np.ndarray:
    """The bit of a word, or of a pair of words, of a language."""
    with np.errstate(over="ignore"):
        code = np.full(len(hashes[0]), np.uint64(sum((b + 1) * 257**i for i, b in enumerate(lang.encode()[:64])) % 2**64))
        for h in hashes:
            code = _mixed(code * np.uint64(0x9E3779B97F4A7C15) + h)
    return code >> np.uint64(64 - FILTER_BITS)


def _runs(texts: Iterator[str | None], chunk: int) -> Iterator[bytes]:
    """Texts, joined by line ends and cut at piece ends, in runs of about ``chunk`` bytes."""
    held, size = [], 0
    for text in texts:
        raw = text.encode() if text else b""
        while len(raw) > chunk:
            cut = max(raw.rfind(b, 0, chunk) for b in (BREAKS[i : i + 1] for i in range(len(BREAKS))))
            if cut < 0:
                later = [raw.find(BREAKS[i : i + 1], chunk) for i in range(len(BREAKS))]
                cut = min((x for x in later if x >= 0), default=len(raw))
            yield raw[:cut]
            raw = raw[cut + 1 :]
        held.append(raw)
        size += len(raw) + 1
        if size > chunk:
            yield b"\n".join(held)
            held, size = [], 0
    if held:
        yield b"\n".join(held)


def _set(table: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (table[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1) == 1


def _ngrams(orders: range, frequent, chunk: int):
    """Rows (lang, phrase, words, n) of the n-grams in a run: of words that are set, or of pairs that are; with words a null phrase has the total."""

    def wanted(words: Words, lang: str, order: int, table: np.ndarray | None) -> np.ndarray:
        at = words.starts(order)
        if table is None or not len(at):
            return at
        parts = order if order == 2 else order - 1
        bits = _bit(lang, words.hash) if order == 2 else _bit(lang, words.hash[:-1], words.hash[1:])
        good = _set(table, bits)
        for i in range(parts):
            at = at[good[at + i]]
        return at

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if frequent is None else np.frombuffer(frequent.value, np.uint64)
        for batch in batches:
            langs = batch.column(0)
            for lang in pc.unique(langs).to_pylist():
                texts = batch.column(1).filter(pc.equal(langs, lang))
                for raw in _runs((t.as_py() for t in texts), chunk):
                    words = Words(raw)
                    for order in orders:
                        at = wanted(words, lang, order, table)
                        if not len(at):
                            continue
                        counted = pc.value_counts(words.phrases(at, order))
                        phrase, n = counted.field(0).cast(pa.string()), counted.field(1)
                        if order == 1:
                            phrase, n = pa.concat_arrays([phrase, pa.nulls(1, pa.string())]), pa.concat_arrays([n, pa.array([words.n], pa.int64())])
                        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), phrase, pa.array(np.full(len(n), order, np.int32)), n], ["lang", "phrase", "words", "n"])

    return run


def _filter(counted: DataFrame, order: int):
    """A bit table of the phrases of ``counted``, broadcast; it has 2**FILTER_BITS bits whatever their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0)
            for lang in pc.unique(langs).to_pylist():
                words = Words("\n".join(batch.column(1).filter(pc.equal(langs, lang)).to_pylist()).encode())
                at = words.starts(order)
                bits = _bit(lang, *(words.hash[at + i] for i in range(order)))
                value = (np.uint64(1) << (bits & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array((bits >> np.uint64(6)).astype(np.int32)), pa.array(value)], ["slot", "bits"])

    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    slots = counted.select("lang", "phrase").mapInArrow(run, "slot int, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    for batch in slots.toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return counted.sparkSession.sparkContext.broadcast(table.tobytes())


def phrase_counts(documents: DataFrame, max_n: int = MAX_N, min_count: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of all phrases with ``min_count``, and (lang, total) words of each language."""
    texts = documents.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").filter(F.col("text") != "")

    def counted(orders: range, frequent, label: str) -> DataFrame:
        rows = texts.mapInArrow(_ngrams(orders, frequent, CHUNK), COUNTED).groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.sum("n").alias("n"))
        return staging.staged(rows.filter((F.col("n") >= min_count) | F.col("phrase").isNull()), label)

    every = counted(range(1, 2), None, "words")
    totals, words = every.filter("phrase IS NULL").select("lang", F.col("n").alias("total")), every.filter("phrase IS NOT NULL")
    found = [words]
    if max_n > 1:
        known = _filter(words, 1)
        pairs = counted(range(2, 3), known, "pairs")
        known.destroy()
        found.append(pairs)
    if max_n > 2:
        known = _filter(pairs, 2)
        found.append(counted(range(3, max_n + 1), known, "phrases"))
        known.destroy()
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out, totals


def collocations(documents: DataFrame, max_n: int = MAX_N, min_count: int = MIN_COUNT, top: int = TOP, keep_below: int = KEEP_BELOW) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of each language in ``documents(lang, text)``."""
    counts, totals = phrase_counts(documents, max_n, min_count)
    candidates = counts.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))

    # Within [lang, phrase] the joins meet one row on the counts' side.
    cut = candidates.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    part = lambda k: F.call_function("substring_index", F.col("phrase"), F.lit(" "), k)
    cut = cut.withColumns({"head": part(F.col("k")), "tail": part(F.col("k") - F.col("words"))})
    known = lambda name, n: counts.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cut = cut.join(known("head", "l"), ["lang", "head"]).join(known("tail", "r"), ["lang", "tail"]).join(totals.withColumnRenamed("total", "n"), "lang")
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    cut = cut.withColumns({"over": F.lit(1000).cast("decimal(38,0)") * whole("a") * whole("n"), "under": whole("l") * whole("r")})
    least = F.min(F.struct(F.expr("over div under").alias("score"), "k", "l", "r", "n")).alias("least")
    scored = cut.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "least.l", "least.r", "least.n", "least.score")

    longer = candidates.filter("words > 2").select("lang", F.explode(F.array(part(F.col("words") - 1), part(1 - F.col("words")))).alias("part"), "a")
    longer = longer.groupBy("lang", "part").agg(F.max("a").alias("extended")).withColumnRenamed("lang", "part_lang")
    inside = (F.col("lang") == F.col("part_lang")) & (F.col("phrase") == F.col("part")) & (F.lit(100).cast("decimal(38,0)") * whole("extended") >= F.lit(keep_below).cast("decimal(38,0)") * whole("a"))
    kept = scored.join(longer, inside, "left_anti")

    order = [F.desc("score"), F.desc("a"), "phrase"]
    shares = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    first = shares.withColumn("turn", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).filter(F.col("turn") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collocations of each language of the whole corpus."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, words, k, unnest(generate_series(1, len(words) - k + 1)) AS i FROM w, generate_series(1, {MAX_N}) AS t(k) WHERE len(words) >= k)
),
counts AS (SELECT lang, phrase, k, count(*) AS f FROM grams GROUP BY lang, phrase, k),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE k > 1 AND f >= {MIN_COUNT}),
cuts AS (
  SELECT lang, phrase, a, cut, array_to_string(words[1 : cut], ' ') AS head, array_to_string(words[cut + 1 :], ' ') AS tail
  FROM (SELECT *, unnest(generate_series(1, k - 1)) AS cut FROM candidates)
),
scores AS (
  SELECT c.lang, c.phrase, c.a, c.cut, h.f AS l, t.f AS r, totals.n, (1000::HUGEINT * c.a * totals.n) // (h.f::HUGEINT * t.f) AS score
  FROM cuts c JOIN counts h ON c.lang = h.lang AND c.head = h.phrase JOIN counts t ON c.lang = t.lang AND c.tail = t.phrase JOIN totals ON c.lang = totals.lang
),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM lowest p WHERE NOT EXISTS (
    SELECT 1 FROM candidates q WHERE q.lang = p.lang AND 100 * q.a >= {KEEP_BELOW} * p.a AND length(q.phrase) > length(p.phrase) AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')
  )
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= {TOP}
"""
