"""Static range asymmetric numeral system over token ids, vectorised across interleaved lanes.

A frequency table shared by the whole corpus is quantised to 2**20 slots. A block holds whole
documents; its ids are dealt round-robin to ``lanes`` 64-bit states in [2**31, 2**63) that give off
32-bit words. Every ``every`` steps the block stores the states and the word offset, so segments
of a block decode in parallel, each with its own checksum.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"QRA1"
SLOT_BITS = 20
LANES = 1024
EVERY = 128
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4sIHHQQII")  # magic, table crc, lanes, every, ids, documents, segments, head crc
_SEGMENT = struct.Struct("<QII")  # word offset, words, crc of the words


class Table:
    """Quantised frequencies: every id that occurs keeps at least one slot."""

    def __init__(self, counts: np.ndarray):
        counts = np.asarray(counts, np.int64)
        slots = 1 << SLOT_BITS
        freq = np.zeros(len(counts), np.int64)
        seen = np.flatnonzero(counts)
        if len(seen) > slots:
            raise ValueError("more distinct ids than slots")
        if len(seen):
            share = counts[seen].astype(np.float64) / counts.sum()
            part = np.maximum(1, np.floor(share * (slots - len(seen))).astype(np.int64))
            order = np.lexsort((seen, -part))
            part[order[0]] += slots - part.sum()
            freq[seen] = part
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64) if len(freq) else self.freq
        self.crc = zlib.crc32(self.to_bytes())

    @property
    def symbol(self) -> np.ndarray:
        if not hasattr(self, "_symbol"):
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol

    def to_bytes(self) -> bytes:
        return self.freq.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, raw: bytes) -> "Table":
        table = cls.__new__(cls)
        table.freq = np.frombuffer(raw, "<u4").astype(np.uint64)
        table.start = np.concatenate([[0], np.cumsum(table.freq)[:-1]]).astype(np.uint64)
        table.crc = zlib.crc32(table.to_bytes())
        return table


def encode_block(table: Table, ids: np.ndarray, docs: list[int], lengths: list[int], lanes: int = LANES, every: int = EVERY) -> bytes:
    """One self-contained block: header, document index, checkpoints, words.

    Layout: header; documents (signed 64-bit ids, unsigned 64-bit lengths); per segment its word
    offset, word count and checksum, then its entry states; the words of all segments.
    """
    n = len(ids)
    lanes = max(1, min(lanes, n))
    steps = -(-n // lanes)
    filler = int(np.argmax(table.freq)) if len(table.freq) else 0
    grid = np.full(steps * lanes, filler, np.int64)
    grid[:n] = ids
    grid = grid.reshape(steps, lanes)
    freq, start = table.freq[grid], table.start[grid]
    limit = freq << np.uint64(63 - SLOT_BITS)
    shift, word = np.uint64(SLOT_BITS), np.uint64(32)
    state = np.full(lanes, _LOW, np.uint64)
    given: list[np.ndarray] = [None] * steps
    states: dict[int, np.ndarray] = {}
    for t in range(steps - 1, -1, -1):
        f = freq[t]
        over = state >= limit[t]
        given[t] = state[over].astype("<u4")
        state = np.where(over, state >> word, state)
        whole = state // f
        state = (whole << shift) + (state - whole * f) + start[t]
        if t % every == 0:
            states[t // every] = state
    index, body, offset = [], [], 0
    for k in range(-(-steps // every)):
        part = np.concatenate(given[k * every : (k + 1) * every]).tobytes()
        index.append(_SEGMENT.pack(offset, len(part) // 4, zlib.crc32(part)) + states[k].astype("<u8").tobytes())
        body.append(part)
        offset += len(part) // 4
    documents = np.asarray(docs, "<i8").tobytes() + np.asarray(lengths, "<u8").tobytes()
    fixed = documents + b"".join(index)
    head = _HEAD.pack(MAGIC, table.crc, lanes, every, n, len(docs), len(index), zlib.crc32(fixed))
    return head + fixed + b"".join(body)


def decode_words(table: Table, states: np.ndarray, words: np.ndarray, lanes: int, steps: int) -> np.ndarray:
    """The ids of one segment, with those that fill its last step."""
    state, words = states.astype(np.uint64), words.astype(np.uint64)
    symbol, freq, start = table.symbol, table.freq, table.start
    mask, shift, word = np.uint64((1 << SLOT_BITS) - 1), np.uint64(SLOT_BITS), np.uint64(32)
    out = np.empty((steps, lanes), np.uint32)
    at = 0
    for t in range(steps):
        slot = state & mask
        ids = symbol[slot]
        out[t] = ids
        state = freq[ids] * (state >> shift) + slot - start[ids]
        low = np.flatnonzero(state < _LOW)
        if len(low):
            state[low] = (state[low] << word) | words[at : at + len(low)]
            at += len(low)
    return out.reshape(-1)


class Block:
    """A parsed block; ``segment(k)`` decodes one checkpointed part alone."""

    def __init__(self, raw: bytes, table: Table):
        magic, crc, self.lanes, self.every, self.n, docs, self.segments, fixed_crc = _HEAD.unpack_from(raw)
        if magic != MAGIC or crc != table.crc:
            raise ValueError("not a block of this table")
        at = _HEAD.size
        size = self.segments * (_SEGMENT.size + 8 * self.lanes)
        if zlib.crc32(raw[at : at + 16 * docs + size]) != fixed_crc:
            raise ValueError("block index checksum differs")
        self.docs = np.frombuffer(raw, "<i8", docs, at)
        self.lengths = np.frombuffer(raw, "<u8", docs, at + 8 * docs).astype(np.int64)
        self.index = at + 16 * docs
        self.words = self.index + size
        self.raw, self.table = raw, table

    def piece(self, k: int) -> tuple[int, int, int, int, bytes, bytes]:
        """Of segment k: ids before it, its ids, its steps, checksum, entry states and words."""
        at = self.index + k * (_SEGMENT.size + 8 * self.lanes)
        offset, count, crc = _SEGMENT.unpack_from(self.raw, at)
        begin, states = self.words + 4 * offset, at + _SEGMENT.size
        before, steps = k * self.every * self.lanes, min(self.every, -(-self.n // self.lanes) - k * self.every)
        return before, min(steps * self.lanes, self.n - before), steps, crc, self.raw[states : states + 8 * self.lanes], self.raw[begin : begin + 4 * count]

    def segment(self, k: int) -> np.ndarray:
        _, n, steps, crc, states, words = self.piece(k)
        if zlib.crc32(words) != crc:
            raise ValueError(f"segment {k}: checksum differs")
        return decode_words(self.table, np.frombuffer(states, "<u8"), np.frombuffer(words, "<u4"), self.lanes, steps)[:n]

    def ids(self) -> np.ndarray:
        return np.concatenate([self.segment(k) for k in range(self.segments)] or [np.empty(0, np.uint32)])
