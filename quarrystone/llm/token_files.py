"""Operator 2, token-id binary output: corpus ids in range-ANS blocks, in ascending document order.

Null and empty texts have only the end id. Rows that share a doc_id keep their own entries, ordered
by a hash of their text; a null doc_id comes first and is read back as null. An empty table gives an empty file set. Other input columns are ignored.

Texts never travel: documents are tokenised where they are read, and their ids (two bytes each where the vocabulary
allows) are staged. One pass over them counts every id for the shared table, another range-partitions them by doc_id
and encodes blocks of whole documents, about ``BLOCK_IDS`` ids each (a longer document makes a longer block with more
checkpoints). ``part`` and ``first`` (ids of the part before the block) order the blocks without
a global sort, and a part's total is one number per task. Ties of doc_id and text are parted by the place they were
staged at, so one id that holds many rows is spread over parts.

``read_ids`` decodes block by block; ``read_segments`` deals the checkpointed segments of all blocks over tasks, so a long
block is decoded in parallel too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarrystone.llm import rans, staging, wordbpe

BLOCK_IDS = 1 << 18
STAGED = "doc_id long, tie long, task int, row int, ids binary"
FILE = "part int, first long, n_ids long, n_docs long, block binary"
NULL_DOC = -(1 << 63)
#: Blocks per output file, so that a reader's batch is bounded whatever the size of a part.
FILE_BLOCKS = 64


def _names(kind: str) -> list[str]:
    return [x.split()[0] for x in kind.split(", ")]


def _tokenised(documents: DataFrame, vocabulary: str, kind: str) -> DataFrame:
    """A STAGED row per document; ``ids`` holds little-endian numbers of ``kind``, the end id last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, task, row = wordbpe.load(vocabulary), TaskContext.get().partitionId(), 0
        end = np.array([wordbpe.END_ID], kind).tobytes()
        for batch in batches:
            at = 0
            for some in wordbpe.text_slices(batch.column(2)):
                ids, cut = encoder.encode_all(some)
                raw = memoryview(ids.astype(kind).tobytes())
                size, cut = np.dtype(kind).itemsize, cut.tolist()
                packed = pa.array([b"".join((raw[size * i : size * j], end)) for i, j in zip(cut, cut[1:])], pa.binary())
                n = len(some)
                columns = [batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array([task] * n, pa.int32()), pa.array(range(row, row + n), pa.int32()), packed]
                yield pa.RecordBatch.from_arrays(columns, _names(STAGED))
                at, row = at + n, row + n

    return documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tie"), "text").mapInArrow(run, STAGED)


def _counts(staged: DataFrame, kind: str, size: int) -> np.ndarray:
    """How often each id occurs. One row per vocabulary entry at most reaches the driver."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                ids = np.frombuffer(raw.as_buffer(), kind)
                if len(ids) < size // 8:
                    np.add.at(seen, ids, 1)
                else:
                    seen += np.bincount(ids, minlength=size)
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(seen[used], pa.int64())], ["id", "n"])

    counts = np.zeros(size, np.int64)
    for row in staged.select("ids").mapInArrow(total, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row.id] = row.n
    return counts


def write_tokens(documents: DataFrame, path: str, vocabulary: str | None = None, partitions: int | None = None, lanes: int = rans.LANES, every: int = rans.EVERY) -> str:
    """Encode ``documents(doc_id, text)`` into ``path``: ``blocks`` and the shared ``table``.

    A block deals its ids over ``lanes`` coders and has a checkpoint every ``every`` steps.
    """
    spark = documents.sparkSession
    vocabulary = vocabulary or wordbpe.default_vocabulary()
    size = wordbpe.load(vocabulary).vocab_size
    kind = "<u2" if size <= 1 << 16 else "<u4"
    staged = staging.staged(_tokenised(documents, vocabulary, kind), "ids")
    frozen = rans.Table(_counts(staged, kind, size)).to_bytes()
    block_ids = BLOCK_IDS

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shared = rans.Table.from_bytes(frozen)
        part, first = TaskContext.get().partitionId(), 0
        docs: list[int] = []
        held: list[np.ndarray] = []
        n = 0

        def block() -> pa.RecordBatch:
            raw = rans.encode_block(shared, np.concatenate(held), docs, [len(x) for x in held], lanes, every)
            columns = [pa.array([part], pa.int32()), pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([len(docs)], pa.int64()), pa.array([raw], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, _names(FILE))

        for batch in batches:
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                # A copy: a view would keep its whole batch.
                held.append(np.frombuffer(raw.as_buffer(), kind).astype(np.uint32))
                docs.append(NULL_DOC if doc is None else doc)
                n += len(held[-1])
                if n >= block_ids:
                    yield block()
                    first, docs, held, n = first + n, [], [], 0
        if docs:
            yield block()

    order = ["doc_id", "tie", "task", "row"]
    dealt = staged.repartitionByRange(partitions or staging.shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    blocks = dealt.select("doc_id", "ids").mapInArrow(encode, FILE)
    blocks.write.option("compression", "none").option("maxRecordsPerFile", FILE_BLOCKS).parquet(f"{path}/blocks")
    spark.createDataFrame([(bytearray(frozen),)], "freq binary").coalesce(1).write.parquet(f"{path}/table")
    staging.release(staged)
    return path


def read_table(spark: SparkSession, path: str) -> bytes:
    return bytes(spark.read.parquet(f"{path}/table").first().freq)


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Decode a file set: doc_id, start, n_tokens, ids_crc32, ids (little-endian unsigned 32-bit)."""
    blocks = spark.read.schema(FILE).parquet(f"{path}/blocks")
    frozen = read_table(spark, path)
    # One number per writing task.
    totals = {r.part: r.n for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    base, before = {}, 0
    for part in sorted(totals):
        base[part], before = before, before + totals[part]

    def decode(batches):
        shared = rans.Table.from_bytes(frozen)
        for batch in batches:
            for part, first, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                block = rans.Block(raw.as_py(), shared)
                ids = block.ids().astype("<u4").tobytes()
                ends = np.cumsum(block.lengths)
                starts = ends - block.lengths
                view = memoryview(ids)
                each = [view[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                columns = [pa.array(block.docs, mask=block.docs == NULL_DOC), pa.array(base[part] + first + starts), pa.array(block.lengths), pa.array([zlib.crc32(x) for x in each], pa.int64())]
                if with_ids:
                    columns.append(pa.array([bytes(x) for x in each], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    names = [x.split()[0] for x in kind.split(", ")]
    return blocks.select("part", "first", "block").mapInArrow(decode, kind)


SEGMENT = "part int, start long, n_ids long, lanes int, steps int, crc long, states binary, words binary"


def read_segments(spark: SparkSession, path: str, tasks: int | None = None) -> DataFrame:
    """part, start (ids of the part before the segment), ids: every checkpointed segment, decoded by itself.

    Blocks are only cut at their checkpoints where they are read; the pieces are dealt over ``tasks``.
    """
    frozen = read_table(spark, path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rans.Table.from_bytes(frozen)
        for batch in batches:
            for part, first, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                block = rans.Block(raw.as_py(), shared)
                rows = [(part, first + at, n, block.lanes, steps, crc, states, words) for at, n, steps, crc, states, words in map(block.piece, range(block.segments))]
                if rows:
                    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], _names(SEGMENT))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = rans.Table.from_bytes(frozen)
        for batch in batches:
            for part, start, n, lanes, steps, crc, states, words in zip(*(c.to_pylist() for c in batch.columns)):
                if zlib.crc32(words) != crc:
                    raise ValueError(f"segment at {part}, {start}: checksum differs")
                ids = rans.decode_words(shared, np.frombuffer(states, "<u8"), np.frombuffer(words, "<u4"), lanes, steps)[:n]
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([ids.astype("<u4").tobytes()], pa.binary())], ["part", "start", "ids"])

    pieces = spark.read.schema(FILE).parquet(f"{path}/blocks").select("part", "first", "block").mapInArrow(cut, SEGMENT)
    return pieces.repartition(tasks or staging.shuffle_partitions(spark), "part", "start").mapInArrow(decode, "part int, start long, ids binary")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the corpus as range-ANS blocks, read them back, and digest every document's ids."""
    path = write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), staging.new_path(spark, "tokens"))
    return read_ids(spark, path, with_ids=False)
