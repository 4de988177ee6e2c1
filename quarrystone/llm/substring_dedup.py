"""Operator 6, substring deduplication by recompression. Exact for windows of 50 words.

Texts are recompressed for ``ROUNDS`` rounds (names are hashes, so tasks agree on them). Each window of 50
words takes as anchor its least interior symbol, one that rests on words of the window alone, so a window
takes the same anchor wherever it stands; a window without any (long runs of a word) stands for itself.
Consecutive windows with one anchor make a row: ``key`` hashes the words the anchor rests on, ``body`` all
words of those windows.

* A key in one document only can't be in a repeat; the other rows stay.
* Rows equal in key and body hold equal windows: all but those of the least document are repeats.
* Where a key has several bodies (ends of a repeat), the least document's windows of each body
  are hashed one by one and looked for in smaller documents among windows of the same key.

Removed ranges are applied to the whole text; windows are judged on the input alone. Null texts have no
words. Documents of fewer than 50 words lose nothing. Rows with one doc_id never count as each other's
copies, and each loses what its own text repeats.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import recompression, staging
from quarrystone.llm.recompression import mix
from quarrystone.llm.wordbpe import text_slices

WINDOW = 50
ROUNDS = 3
_BASE = 0x9E3779B97F4A7C15
_SALT = np.uint64(0xD6E8FEB86659FD93)
ANCHORS = "doc_id long, copy long, key long, body long, first int, last int"


def _word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each text's words begin and end."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    first = parts.offsets.to_numpy().astype(np.int64)
    coded = parts.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
    names = coded.dictionary.to_pylist()
    code = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), np.uint64, len(names))
    real = np.fromiter((bool(w) for w in names), bool, len(names))
    at = coded.indices.to_numpy()
    keep = real[at]
    return code[at][keep], np.concatenate([[0], np.cumsum(keep)])[first - first[0]]


class Hashes:
    """Hashes of any range of a sequence, from prefix sums of codes times powers of an odd base."""

    def __init__(self, codes: np.ndarray):
        n = len(codes) + 1
        power = np.full(n, _BASE, np.uint64)
        back = np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
        power[0] = back[0] = 1
        self.back = np.multiply.accumulate(back)
        terms = codes * np.multiply.accumulate(power)[:-1]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[begin]) * self.back[begin] + (end - begin).astype(np.uint64))


def anchor_rows(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Row number, key, body, first and last window start of every run of windows with one anchor."""
    flat, cut = _word_codes(texts)
    n = len(texts)
    counts = np.diff(cut)
    # A separator that no text can hold before, between and after the texts.
    fences = np.frombuffer(os.urandom(8 * (n + 1)), np.uint64)
    begins = cut[:-1] + np.arange(1, n + 1)
    codes = np.empty(len(flat) + n + 1, np.uint64)
    owner = np.repeat(np.arange(n), counts)
    codes[np.arange(len(flat)) + owner + 1] = flat
    codes[np.append(begins - 1, len(codes) - 1)] = fences
    windows = np.maximum(counts - WINDOW + 1, 0)
    row = np.repeat(np.arange(n), windows)
    starts = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows) + np.repeat(begins, windows)
    if not len(starts):
        return (np.empty(0, np.int64),) * 5
    symbols = recompression.compress(recompression.words(codes), ROUNDS)
    anchor = recompression.windows_anchor(symbols, starts, WINDOW)
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (anchor[1:] < 0)
    head = np.flatnonzero(new)
    first, last = starts[head], starts[np.append(head[1:], len(starts)) - 1]
    hashes = Hashes(codes)
    found = anchor[head]
    alone = found < 0
    low = np.where(alone, first, symbols.low[found])
    high = np.where(alone, first + WINDOW, symbols.high[found])
    key = mix(hashes.of(low, high) ^ np.where(alone, _SALT, symbols.name[found]))
    at = np.where(alone, first, symbols.at[found])
    body = mix(hashes.of(first, last + WINDOW) + (at - first).astype(np.uint64) * _SALT)
    who = row[head]
    return who, key.astype(np.int64), body.astype(np.int64), first - begins[who], last - begins[who]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, copies, at = batch.column(0), batch.column(1), 0
        for some in text_slices(batch.column(2), 4 << 20):
            who, key, body, first, last = anchor_rows(some)
            take = pa.array(who + at)
            columns = [docs.take(take), copies.take(take), pa.array(key, pa.int64()), pa.array(body, pa.int64()), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in ANCHORS.split(", ")])
            at += len(some)


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, copy, key, body, at) of single windows; here body hashes the one window."""
    for batch in batches:
        for doc, copy, text, spans in zip(*(batch.column(i) for i in range(4))):
            codes, _ = _word_codes(pa.array([text.as_py()], pa.string()))
            keys, firsts, lasts = (spans.values.field(i).to_numpy() for i in range(3))
            n = lasts - firsts + 1
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(firsts, n)
            body = Hashes(codes).of(at, at + WINDOW).astype(np.int64)
            size = len(at)
            columns = [pa.array([doc.as_py()] * size, pa.int64()), pa.array([copy.as_py()] * size, pa.int64()), pa.array(np.repeat(keys, n)), pa.array(body), pa.array(at.astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", "key", "body", "at"])


def repeated_ranges(documents: DataFrame) -> DataFrame:
    """(doc_id, copy, ranges): window starts [first, last] whose words start in a smaller document too.
    ``copy`` is the text's crc32."""
    rows = documents.select(F.col("doc_id").cast("long"), F.crc32(F.col("text").cast("binary")).alias("copy"), "text")
    anchors = staging.staged(rows.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).mapInArrow(_anchors, ANCHORS), "anchors")
    # Staged, so that both sides of the join are plain exchanges and a hot key's rows can be split.
    wide = staging.staged(anchors.groupBy("key").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("key"), "keys")
    shared = staging.staged(anchors.join(wide, "key"), "shared")
    staging.release(anchors)

    bodies = staging.staged(shared.groupBy("key", "body").agg(F.min("doc_id").alias("least")), "bodies")
    forked = bodies.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key")
    own = shared.join(bodies, ["key", "body"])
    whole = own.filter("doc_id > least").select("doc_id", "copy", "first", "last")
    ends = own.filter("doc_id = least").join(forked, "key").select("doc_id", "copy", "key", "first", "last")
    # A document's own rows: bounded by its words.
    spans = ends.groupBy("doc_id", "copy").agg(F.collect_list(F.struct("key", "first", "last")).alias("spans"))
    singles = rows.join(spans, ["doc_id", "copy"]).select("doc_id", "copy", "text", "spans").dropDuplicates(["doc_id", "copy"])
    singles = staging.staged(singles.mapInArrow(_window_hashes, "doc_id long, copy long, key long, body long, at int"), "windows")
    seen = staging.staged(singles.groupBy("key", "body").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most").select("key", "body", "least"), "seen")
    part = singles.join(seen, ["key", "body"]).filter("doc_id > least").select("doc_id", "copy", F.col("at").alias("first"), F.col("at").alias("last"))
    return whole.union(part).groupBy("doc_id", "copy").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))


RESULT = "doc_id long, n_words long, n_removed long, kept string"


def remove_repeats(documents: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by blanks (or their SHA-256)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, ranges in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                n = len(words)
                if ranges.is_valid:
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, ranges.values.field(0).to_numpy(), 1)
                    np.add.at(edge, ranges.values.field(1).to_numpy() + WINDOW, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    words = [words[i] for i in np.flatnonzero(~gone).tolist()]
                kept = b" ".join(words)
                rows.append((n, n - len(words), hashlib.sha256(kept).hexdigest() if digest else kept.decode()))
            columns = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_words", "n_removed", "kept"])

    rows = documents.select(F.col("doc_id").cast("long"), F.crc32(F.col("text").cast("binary")).alias("copy"), "text")
    return rows.join(repeated_ranges(documents), ["doc_id", "copy"], "left").select("doc_id", "text", "ranges").mapInArrow(cut, RESULT)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove repeated passages of 50 words and more from the whole corpus."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest=True).withColumnRenamed("kept", "kept_sha256")
