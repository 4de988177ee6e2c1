"""Word-piece encoding with the ``tokenizers`` library behind a bounded memo of white-space chunks.

The vocabulary's pre-tokenizer drops white space and none of its merges crosses it, and its
normaliser (NFC, per-character lower case) never looks past an ASCII blank. A text's ids are
therefore the concatenation of the ids of its blank-separated chunks, so every distinct chunk is
encoded by the library once and looked up afterwards. Splitting, dictionary coding, look-up and
gathering run in Arrow and numpy over about 8 MB of text at a time; only new chunks become objects.
"""

from __future__ import annotations

import ctypes
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 2
MEMO_ENTRIES = 800_000
MEMO_BYTES = 24 << 20
LONG_CHUNK = 64
SLICE_BYTES = 8 << 20

_LOADED: dict[str, "WordBpe"] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def load(path: str) -> "WordBpe":
    """One encoder per worker process and file."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def text_slices(texts: pa.Array, most: int = SLICE_BYTES):
    """Cut a string array into runs of rows of about ``most`` bytes, a longer row by itself."""
    sizes = np.nan_to_num(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)).astype(np.int64)
    group = np.cumsum(sizes) // most
    cuts = np.flatnonzero(np.diff(group)) + 1
    at = 0
    for end in [*cuts.tolist(), len(texts)]:
        if end > at:
            yield texts.slice(at, end - at)
        at = end


def give_back() -> None:
    """Return freed memory to the system: an idle worker shouldn't hold a batch's scratch space."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


class WordBpe:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        #: Known chunks, how many ids each has, and the ids of all end to end.
        self.known = pa.array([""], pa.string())
        self.sizes = np.zeros(1, np.int64)
        self.table = np.empty(0, np.uint32)

    def _learn(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An order of the chunks, their numbers of ids in it, and the ids end to end.

        They are encoded joined by blanks and cut where each begins. A chunk of stable lower-case
        letters is one pre-token, so the library's cheap word numbers find its ids; any other chunk
        is found by character offsets.
        """
        one = [c.isalpha() and (c.isascii() or (c == c.lower() and unicodedata.is_normalized("NFC", c))) for c in chunks]
        plain = [k for k, p in enumerate(one) if p]
        other = [k for k, p in enumerate(one) if not p]
        sizes, ids = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
        for group, by_word in ((plain, True), (other, False)):
            for at in range(0, len(group), 128):
                some = [chunks[k] for k in group[at : at + 128]]
                got = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
                if by_word:
                    owner = np.asarray(got.word_ids)
                else:
                    ends = np.cumsum([len(t) + 1 for t in some])
                    owner = np.searchsorted(ends, [o[0] for o in got.offsets], "right")
                sizes.append(np.bincount(owner.astype(np.int64), minlength=len(some)))
                ids.append(np.asarray(got.ids, np.uint32))
        return np.array(plain + other, np.int64), np.concatenate(sizes), np.concatenate(ids)

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of one whole text; null is empty."""
        return self.encode_all(pa.array([text], pa.string()))[0]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat unsigned 32-bit ids of every whole text, and where each text's ids begin and end."""
        flat, ends = [], [np.zeros(1, np.int64)]
        for some in text_slices(texts):
            ids, offsets = self._slice(some)
            flat.append(ids)
            ends.append(offsets[1:] + ends[-1][-1])
        give_back()
        return np.concatenate(flat or [np.empty(0, np.uint32)]), np.concatenate(ends)

    def _slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts, "")
        # The normaliser lower-cases; doing ASCII first lets more chunks share a memo entry.
        low = pc.ascii_lower(texts)
        special = pc.match_substring(texts, "<|")
        if pc.any(special).as_py():
            low = pc.if_else(special, texts, low)
        parts = pc.ascii_split_whitespace(low)
        first = parts.offsets.to_numpy().astype(np.int64)
        coded = parts.values.slice(first[0], first[-1] - first[0]).dictionary_encode()
        words = coded.dictionary
        entry = pc.index_in(words, value_set=self.known)
        missing = entry.is_null().to_numpy(zero_copy_only=False)
        entry = pc.fill_null(entry, 0).to_numpy().copy()
        if missing.any():
            new = words.filter(pa.array(missing)).to_pylist()
            order, sizes, ids = self._learn(new)
            entry[np.flatnonzero(missing)[order]] = len(self.sizes) + np.arange(len(order))
            self.known = pa.concat_arrays([self.known, pa.array([new[k] for k in order], pa.string())])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.table = np.concatenate([self.table, ids])
        ends = np.cumsum(self.sizes)
        at = entry[coded.indices.to_numpy()]
        n = self.sizes[at]
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        ids = self.table[np.arange(total[-1]) + np.repeat((ends - self.sizes)[at] - total[:-1], n)]
        if len(self.sizes) > MEMO_ENTRIES or pc.sum(pc.binary_length(self.known)).as_py() > MEMO_BYTES:
            # Frequent chunks enter first, so the rare ones and any long one are behind.
            keep = np.flatnonzero(pc.binary_length(self.known).to_numpy() <= LONG_CHUNK)[: MEMO_ENTRIES // 2]
            sizes = self.sizes[keep]
            last = np.cumsum(sizes)
            self.table = self.table[np.arange(last[-1] if len(last) else 0) + np.repeat((ends - self.sizes)[keep] - (last - sizes), sizes)]
            self.known, self.sizes = self.known.take(pa.array(keep)), sizes
        return ids, total[first - first[0]]
