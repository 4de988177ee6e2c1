"""Recompression of token sequences: locally consistent naming in rounds, with what each name rests on.

A round first names runs of one symbol, then pairs. A pair joins a symbol whose coin for this round
says "left" with a following one whose coin says "right"; coins are bits of the symbol's own hash, and
a new name is a hash of the names it joins, so every task names alike without exchanging a
dictionary. Equal substrings therefore get equal symbols inside, and differ only near their edges.

Each symbol carries the word range [low, high) that decided it: the words it spans and the neighbours
that were looked at. A symbol whose range lies inside a window of words is found, at the same place,
in every copy of that window.
"""

from __future__ import annotations

import numpy as np

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Symbols:
    """Parallel arrays: name, first word, and the deciding range [low, high)."""

    def __init__(self, name: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.name, self.at, self.low, self.high = name, at, low, high

    def __len__(self) -> int:
        return len(self.name)

    def take(self, keep: np.ndarray) -> "Symbols":
        return Symbols(self.name[keep], self.at[keep], self.low[keep], self.high[keep])


def words(codes: np.ndarray) -> Symbols:
    """One symbol a word, or a separator with a name of its own between texts."""
    at = np.arange(len(codes), dtype=np.int64)
    return Symbols(codes, at, at, at + 1)


def runs(s: Symbols) -> Symbols:
    """Name maximal runs. A run rests on the symbols around it, which differ from it."""
    if not len(s):
        return s
    new = np.concatenate([[True], s.name[1:] != s.name[:-1]])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(s)) - 1
    count = (last - first + 1).astype(np.uint64)
    name = np.where(count > 1, mix(s.name[first] * _A + count * _B), s.name[first])
    low = s.low[np.maximum(first - 1, 0)]
    high = s.high[np.minimum(last + 1, len(s) - 1)]
    return Symbols(name, s.at[first], low, high)


def pairs(s: Symbols, level: int) -> Symbols:
    """Join left-coin symbols with right-coin successors."""
    if len(s) < 2:
        return s
    right = (mix(s.name + np.array([level], np.uint64) * _B) >> np.uint64(37)) & np.uint64(1) == 1
    joins = np.append(~right[:-1] & right[1:], False)
    joined = np.concatenate([[False], joins[:-1]])
    after = np.minimum(np.arange(len(s)) + 1, len(s) - 1)
    before = np.maximum(np.arange(len(s)) - 1, 0)
    name = np.where(joins, mix(mix(s.name * _A) + s.name[after] * _B + np.uint64(1)), s.name)
    # A joined pair rests on its two symbols; one left alone rests on the neighbour it didn't join.
    low = np.where(~joins & right, s.low[before], s.low)
    high = np.where(joins | ~right, s.high[after], s.high)
    return Symbols(name, s.at, np.minimum(low, s.low), np.maximum(high, s.high)).take(~joined)


def compress(s: Symbols, rounds: int) -> Symbols:
    for level in range(rounds):
        s = pairs(runs(s), level)
    return s


def windows_anchor(s: Symbols, starts: np.ndarray, width: int) -> np.ndarray:
    """For each window [start, start + width) the symbol of least name among those resting on words
    of the window alone (leftmost on ties), or -1 where there is none."""
    if not len(s):
        return np.full(len(starts), -1, np.int64)
    # No step lets a range's ends fall behind those before it, so a window's symbols are consecutive.
    begin = np.searchsorted(s.low, starts, "left")
    end = np.searchsorted(s.high, starts + width, "right")
    out = np.full(len(starts), -1, np.int64)
    some = end > begin
    if not some.any():
        return out
    order = np.argsort(mix(s.name ^ _A), kind="stable")
    rank = np.empty(len(s), np.int64)
    rank[order] = np.arange(len(s))
    length = end - begin
    table = rank
    size = 1
    best = np.full(len(starts), len(s), np.int64)
    while True:
        here = np.flatnonzero(some & (length >= size) & (length < 2 * size))
        if len(here):
            best[here] = np.minimum(table[begin[here]], table[end[here] - size])
        if 2 * size > length.max():
            break
        table = np.minimum(table[:-size], table[size:])
        size *= 2
    hit = np.flatnonzero(some)
    out[hit] = order[best[hit]]
    return out
