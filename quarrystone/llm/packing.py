"""Operator 5, sum-of-squares online packing into token windows.

A document's ids (end id included; null and empty texts have only that) are cut into whole windows
and a rest. A rest goes to the fill level that minimises the sum of squared counts of partially
filled windows, read from an array of counts by level. When a task's input ends, some windows are still below
``FULL``: the fullest of them, as many as can hold all their ids, stay as they were placed, and only the
others are taken apart, their pieces cut freely to fill the gaps. So a task pads nearly full windows by one per
cent at most, and the others by less than one window in all. Each task packs its own rows, online and with
bounded memory: at most ``OPEN`` windows wait, and beyond that the fullest are closed.

Rows that repeat are packed once each. An empty table gives no piece. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from quarrystone.llm import wordbpe

WINDOW = 4096
OPEN = 2048
FULL = 4055
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_SEQUENCES_PER_TASK = 33


class Packer:
    """Pieces are (doc_id, start, ids, doc_tokens); ``closed`` yields finished windows as lists of them."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)  # partially filled windows by level; 0 stands for a new one
        self.levels: list[list[list]] = [[] for _ in range(window + 1)]
        self.open = 0

    def place(self, size: int) -> int:
        """The level to put a piece of ``size`` on; 0 opens a window.

        Moving a window from level h to h+s changes the sum of squares by -2N(h)+1 and, unless it
        is then full, by 2N(h+s)+1; a new window only has the second part. Ties go to the fullest.
        """
        top = self.window - size
        n = self.count
        gain = 2 * n[size : self.window + 1] + 1
        gain[-1] = 0
        gain[1:] += 1 - 2 * n[1 : top + 1]
        gain[1:][n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        return top - int(np.argmin(gain[::-1]))

    def add(self, piece: tuple) -> list | None:
        size = len(piece[2])
        at = self.place(size)
        if at:
            pieces = self.levels[at].pop()
            self.count[at] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if at + size == self.window:
            return pieces
        self.levels[at + size].append(pieces)
        self.count[at + size] += 1
        self.open += 1
        if self.open > OPEN:
            level = int(np.flatnonzero(self.count)[-1])
            self.count[level] -= 1
            self.open -= 1
            return self.levels[level].pop()
        return None

    def finish(self) -> Iterator[list]:
        """Close what is nearly full, then let the emptiest windows fill the gaps of the fullest."""
        rest = []
        for level in range(self.window, 0, -1):
            if level >= FULL * self.window // WINDOW:
                yield from self.levels[level]
            else:
                rest += [(level, pieces) for pieces in self.levels[level]]
        # As many windows stay as hold all ids; what the others hold fits their gaps, all but the last one's.
        stay = -(-sum(level for level, _ in rest) // self.window)
        given = iter([piece for _, pieces in rest[stay:] for piece in pieces])
        doc, start, ids, total = next(given, (None, 0, (), 0))
        for level, pieces in rest[:stay]:
            room = self.window - level
            while room and len(ids):
                pieces.append((doc, start, ids[:room], total))
                start, room, ids = start + len(ids[:room]), room - len(ids[:room]), ids[room:]
                if not len(ids):
                    doc, start, ids, total = next(given, (None, 0, (), 0))
            yield pieces


def pack(documents: DataFrame, vocabulary: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece of ``documents(doc_id, text)``; sequence_id is unique across tasks."""
    vocabulary = vocabulary or wordbpe.default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, packer = wordbpe.load(vocabulary), Packer(window)
        sequence = TaskContext.get().partitionId() << _SEQUENCES_PER_TASK
        end = np.array([wordbpe.END_ID], np.uint32)
        rows: list[tuple] = []

        def emit(pieces: list) -> None:
            nonlocal sequence
            offset = 0
            for doc, start, ids, total in pieces:
                rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset))
                offset += len(ids)
            sequence += 1

        def flush() -> pa.RecordBatch:
            names = [x.split()[0] for x in PIECES.split(", ")]
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            keys, at = batch.column(0).to_pylist(), 0
            for some in wordbpe.text_slices(batch.column(1)):
                flat, cut = encoder.encode_all(some)
                for k in range(len(some)):
                    ids = np.concatenate([flat[cut[k] : cut[k + 1]], end])
                    total = len(ids)
                    whole = total - total % window
                    for start in range(0, whole, window):
                        emit([(keys[at + k], start, ids[start : start + window], total)])
                    # A copy: a view would keep its whole document while the window is open.
                    if whole < total and (done := packer.add((keys[at + k], whole, ids[whole:].copy(), total))):
                        emit(done)
                at += len(some)
                yield flush()
        for done in packer.finish():
            emit(done)
        yield flush()

    return documents.select("doc_id", "text").mapInArrow(run, PIECES)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack the whole corpus; one row per piece."""
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
