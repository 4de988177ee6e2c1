"""Operator 8, quality rules: repetition coverage by rolling hashes of several n-gram lengths.

Words are runs without ASCII white space. Each distinct word of a text gets a number, so counts of
one word are exact; an n-gram's hash is rolled from the hash one word shorter (multiply by an odd
constant, add the word's mixed number, modulo 2**64). For lengths 2 to 4 the rule looks at the
characters inside the most frequent n-gram, for 5 to 10 at the characters inside n-grams found
twice or more, for lines at the characters inside lines equal to an earlier one, each as a share of the
word characters. A text also fails when symbols are frequent against its words.

Null and empty texts have no words and fail the base rule. Rows that repeat are judged alike; a null doc_id stays null.
``quality`` ignores other columns, ``kept_documents`` passes them through whatever their names; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

MIN_WORDS = 50
MAX_REPEAT_WORDS = 50  # per cent of the words, in repeated windows of three
REPEAT_WINDOW = 3
# The largest share of characters in the most frequent n-gram, by n-gram length.
TOP_NGRAM = {2: 0.20, 3: 0.18, 4: 0.16}
# The largest share of characters covered by n-grams found before, by n-gram length.
DUPLICATE_NGRAM = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
MAX_DUPLICATE_LINES = 0.30
MAX_DUPLICATE_LINE_CHARS = 0.20
MAX_SYMBOLS_PER_WORD = 0.10
SYMBOLS = b"#*$%&|<>"
_ROLL = np.uint64(0x9E3779B97F4A7C15)
_NO_SYMBOL = bytes(b for b in range(256) if b not in SYMBOLS)

VERDICT = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, top_share double, duplicate_share double, line_share double"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _covered(repeated: np.ndarray, width: int) -> np.ndarray:
    """Words inside the flagged windows of ``width`` words."""
    edge = np.zeros(len(repeated) + width, np.int64)
    edge[: len(repeated)] += repeated
    edge[width:] -= repeated
    return np.cumsum(edge)[:-1] > 0


def measure(text: str | None) -> tuple:
    """Everything but the id of a ``VERDICT`` row, for one whole text."""
    raw = text.encode() if text else b""
    words = raw.split()
    n = len(words)
    symbols = len(raw.translate(None, _NO_SYMBOL))
    if not n:
        return 0, 0, symbols, 0, 0, True, False, 0.0, 0.0, 0.0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    distinct = list(number)
    sizes = np.array([len(w) if w.isascii() else len(w.decode()) for w in distinct], np.int64)
    chars = sizes[ids]
    total = int(chars.sum())

    seen: set[bytes] = set()
    lines = dup_lines = dup_line_chars = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup_lines += 1
            dup_line_chars += sum(map(len, line.split()))
            lines += 1
        elif line.strip():
            seen.add(line)
            lines += 1
    raw_chars = sum(map(len, words))

    code = _mixed(np.arange(len(distinct)))[ids]
    top_share = duplicate_share = 0.0
    verdict = symbols <= MAX_SYMBOLS_PER_WORD * n and dup_lines <= MAX_DUPLICATE_LINES * lines and dup_line_chars <= MAX_DUPLICATE_LINE_CHARS * raw_chars
    repeat_words = 0
    running = np.concatenate([[0], np.cumsum(chars)])
    rolled = code
    for width in range(2, max(DUPLICATE_NGRAM) + 1):
        if width > n:
            break
        rolled = rolled[:-1] * _ROLL + code[width - 1 :]
        order = np.argsort(rolled, kind="stable")
        ordered = rolled[order]
        same = ordered[1:] == ordered[:-1]
        if not same.any():
            break  # a longer n-gram found twice holds a shorter one found twice
        later = np.zeros(len(rolled), bool)
        later[order[1:]] = same
        if width == REPEAT_WINDOW:
            either = later.copy()
            either[order[:-1]] |= same
            repeat_words = int(_covered(either, width).sum())
        if width in TOP_NGRAM:
            begin = np.flatnonzero(np.concatenate([[True], ~same]))
            count = np.diff(np.append(begin, len(ordered)))
            first = order[begin]
            weight = np.where(count > 1, count * (running[first + width] - running[first]), 0)
            share = float(weight.max()) / total
            top_share = max(top_share, share)
            verdict &= share <= TOP_NGRAM[width]
        if width in DUPLICATE_NGRAM:
            share = float(chars[_covered(later, width)].sum()) / total
            duplicate_share = max(duplicate_share, share)
            verdict &= share <= DUPLICATE_NGRAM[width]
    failed = n < MIN_WORDS or 100 * repeat_words > MAX_REPEAT_WORDS * n
    return n, total, symbols, dup_lines, repeat_words, failed, bool(verdict and not failed), top_share, duplicate_share, dup_line_chars / max(1, raw_chars)


def quality(documents: DataFrame) -> DataFrame:
    """A ``VERDICT`` row per row of ``documents(doc_id, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in VERDICT.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.float64()] * 3
        for batch in batches:
            rows = [(doc, *measure(text.as_py())) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1))]
            columns = list(zip(*rows)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return documents.select("doc_id", "text").mapInArrow(run, VERDICT)


def kept_documents(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` whose text is kept, all columns as they were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([measure(t.as_py())[6] for t in texts], pa.bool_()))

    return documents.mapInArrow(run, documents.schema)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every whole text of the corpus."""
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
