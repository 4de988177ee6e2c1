"""Operator 7, offset-preserving SentencePiece encoding and decoding.

The normaliser reads the model's compiled character map (a double-array trie over byte prefixes)
itself and replaces the longest matching prefix at each position, recording for every normalised
byte the original byte it came from. A normalised text is cut before each run of word marks; since no
piece holds a mark after another character, no merge crosses such a cut, and each distinct segment
is encoded once by the library (with the model's own normaliser switched off). Pieces are projected
through the alignment to spans of original UTF-8 bytes: span i runs from the source of its first
normalised byte to the source of the byte after its last.

Null and empty texts have only the end id; rows that repeat are encoded once each; other columns are ignored and an empty
table gives no row. A model with user-defined pieces and a map is refused. A model whose pieces could cross a cut is encoded whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

MARK = "▁"
MEMO_ENTRIES = 400_000
LONG_SEGMENT = 96
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_bytes long, spans_sha256 string"

_LOADED: dict[str, "PieceCodec"] = {}


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str) -> "PieceCodec":
    """One codec per worker process and file."""
    if path not in _LOADED:
        with open(path, "rb") as f:
            _LOADED[path] = PieceCodec(f.read())
    return _LOADED[path]


class CharacterMap:
    """Longest-prefix replacement by a compiled map: trie size, double-array units, replacements."""

    def __init__(self, compiled: bytes):
        self.units: list[int] = []
        self.replacements = b""
        if compiled:
            size = int.from_bytes(compiled[:4], "little")
            self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
            self.replacements = compiled[4 + size :]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``data[at:]`` and its replacement."""
        units = self.units
        if not units:
            return None
        found = None
        node = units[0]
        node = (node >> 10) << ((node & 0x200) >> 6)
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != data[k]:
                break
            node ^= (unit >> 10) << ((unit & 0x200) >> 6)
            if unit & 0x100:
                begin = units[node] & 0x7FFFFFFF
                found = (k + 1 - at, self.replacements[begin : self.replacements.index(b"\0", begin)])
        return found


class PieceCodec:
    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece import sentencepiece_model_pb2 as proto

        spec = proto.ModelProto()
        spec.ParseFromString(model)
        self.normalizer = spec.normalizer_spec
        self.map = CharacterMap(self.normalizer.precompiled_charsmap)
        self.dummy = self.normalizer.add_dummy_prefix
        self.squeeze = self.normalizer.remove_extra_whitespaces
        self.escape = self.normalizer.escape_whitespaces
        self.suffix = spec.trainer_spec.treat_whitespace_as_suffix
        inner = proto.ModelProto()
        inner.CopyFrom(spec)
        inner.normalizer_spec.CopyFrom(proto.NormalizerSpec(name="identity", add_dummy_prefix=False, remove_extra_whitespaces=False, escape_whitespaces=False))
        self.inner = SentencePieceProcessor(model_proto=inner.SerializeToString())
        self.outer = SentencePieceProcessor(model_proto=model)
        kinds = proto.ModelProto.SentencePiece
        self.user = any(p.type == kinds.USER_DEFINED for p in spec.pieces)
        #: Pieces never hold a mark behind another character, so segments are independent.
        self.by_segment = spec.trainer_spec.model_type == proto.TrainerSpec.BPE and not self.user and not any(MARK in p.piece.lstrip(MARK) for p in spec.pieces)
        self.cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.end = spec.trainer_spec.eos_id
        self.unknown = spec.trainer_spec.unk_id
        self.lengths = np.array([1 if p.type == kinds.BYTE else len(p.piece.encode()) for p in spec.pieces], np.int64)
        self.marked = np.array([p.piece.startswith(MARK) for p in spec.pieces])
        self.memo: dict[str, tuple[int, bytes, str]] = {}
        if self.end < 0:
            raise ValueError("the model has no end id")
        if self.user and (self.map.units or self.squeeze):
            raise ValueError("user-defined pieces, which the library's normaliser protects, aren't supported with a map")

    def normalize(self, text: str) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them (and the end) the original byte offset."""
        data = text.encode()
        mark = MARK.encode() if self.escape else b" "
        if not self.map.units and not self.squeeze and not self.suffix:
            return self._identity(data, mark)
        out, source = bytearray(), []
        at, n = 0, len(data)

        def step(at: int) -> tuple[int, bytes]:
            if found := self.map.longest(data, at):
                return found
            lead = data[at]
            size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return size, data[at : at + size]

        if self.squeeze:
            while at < n:
                size, new = step(at)
                if new != b" ":
                    break
                at += size
        if at == n and n:
            return b"", np.array([n], np.int64)
        if not n:
            return b"", np.zeros(1, np.int64)

        def put(new: bytes, origin: int) -> None:
            out.extend(new)
            source.extend([origin] * len(new))

        if self.dummy and not self.suffix:
            put(mark, at)
        blank = self.squeeze
        while at < n:
            size, new = step(at)
            while blank and new.startswith(b" "):
                new = new[1:]
            if new:
                for byte in new:
                    one = mark if byte == 0x20 else bytes([byte])
                    put(one, at)
                blank = new.endswith(b" ")
            at += size
            if not self.squeeze:
                blank = False
        if self.squeeze:
            while out.endswith(mark):
                at = source[len(out) - len(mark)]
                del out[len(out) - len(mark) :]
                del source[len(out) :]
        if self.dummy and self.suffix:
            put(mark, at)
        return bytes(out), np.array([*source, at], np.int64)

    def _identity(self, data: bytes, mark: bytes) -> tuple[bytes, np.ndarray]:
        """No map and no squeezing: only blanks become marks and a mark may come first."""
        if not data:
            return b"", np.zeros(1, np.int64)
        raw = np.frombuffer(data, np.uint8)
        width = np.where(raw == 0x20, len(mark), 1)
        source = np.repeat(np.arange(len(raw), dtype=np.int64), width)
        front = np.zeros(len(mark) if self.dummy else 0, np.int64)
        return mark * bool(self.dummy) + data.replace(b" ", mark), np.concatenate([front, source, [len(raw)]])

    def _learn(self, segments: list[str]) -> None:
        """Encode new segments. Those of one mark and a word are encoded end to end, and cut where a
        piece starts with a mark, which only the first of a segment does."""
        plain = [s for s in segments if s[0] == MARK and len(s) > 1 and s.count(MARK) == 1]
        if self.by_segment:
            for at in range(0, len(plain), 64):
                some = plain[at : at + 64]
                ids = np.asarray(self.inner.encode("".join(some)), "<i4")
                cuts = np.append(np.flatnonzero(self.marked[ids]), len(ids)).tolist()
                texts, raw = list(map(str, ids.tolist())), ids.tobytes()
                for segment, i, j in zip(some, cuts[:-1], cuts[1:], strict=True):
                    self.memo[segment] = (j - i, raw[4 * i : 4 * j], " ".join(texts[i:j]))
            segments = [s for s in segments if s not in self.memo]
        for segment, ids in zip(segments, self.inner.encode(segments, num_threads=1)):
            self.memo[segment] = (len(ids), np.asarray(ids, "<i4").tobytes(), " ".join(map(str, ids)))

    def _segments(self, normal: str) -> list[tuple[int, bytes, str]]:
        parts = self.cut.findall(normal) if self.by_segment else [normal] if normal else []
        memo = self.memo
        fresh = list(set(parts).difference(memo))
        if fresh:
            self._learn(fresh)
        got = [memo[p] for p in parts]
        for p in fresh:
            if len(p) > LONG_SEGMENT or not self.by_segment:
                del memo[p]
        if len(memo) > MEMO_ENTRIES:
            for p in list(memo)[MEMO_ENTRIES // 2 :]:
                del memo[p]
        return got

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
        """Ids with the end id, begin and end of every piece's span of original bytes (the end id's
        is empty), and the ids as decimal text."""
        normal, source = self.normalize(text or "")
        got = self._segments(normal.decode())
        ids = np.frombuffer(b"".join([g[1] for g in got]), "<i4")
        size = self.lengths[ids]
        unknown = np.flatnonzero(ids == self.unknown)
        if len(unknown):
            size = self._unknown_sizes(normal, size, unknown)
        ends = np.cumsum(size)
        begin, end = source[ends - size], source[ends]
        last = source[-1:]
        text_ids = " ".join([g[2] for g in got if g[0]] + [str(self.end)])
        return np.append(ids, self.end), np.append(begin, last), np.append(end, last), text_ids

    def _unknown_sizes(self, normal: bytes, size: np.ndarray, unknown: np.ndarray) -> np.ndarray:
        """An unknown piece covers a run of text; its length is read from the library's pieces."""
        surfaces = [p for g in (self.cut.findall(normal.decode()) if self.by_segment else [normal.decode()]) for p in self.inner.encode(g, out_type=str)]
        size = size.copy()
        size[unknown] = [len(surfaces[k].encode()) for k in unknown.tolist()]
        return size

    def decode(self, ids: np.ndarray) -> str:
        return self.outer.decode(ids.tolist())


def encode_pieces(documents: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids, and each piece's begin and end in the original UTF-8 bytes."""
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(model)
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1)):
                ids, begin, end, _ = codec.encode(text.as_py())
                columns = [pa.array([doc.as_py()], pa.int64()), *(pa.array([x.tolist()], pa.list_(kind)) for x, kind in ((ids, pa.int32()), (begin, pa.int64()), (end, pa.int64())))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "begin", "end"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>, begin array<long>, end array<long>")


def span_digest(begin: np.ndarray, end: np.ndarray) -> str:
    return hashlib.sha256(begin.astype("<i8").tobytes() + end.astype("<i8").tobytes()).hexdigest()


def digest_pieces(documents: DataFrame, model: str | None = None) -> DataFrame:
    """Encode and decode every whole text; keep digests. n_bytes is where the last span ends; spans_sha256 is that of
    every piece's begin and end as little-endian signed 64-bit integers, all begins first."""
    model = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = load(model)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, begin, end, decimal = codec.encode(text.as_py())
                if np.any(begin[1:] < begin[:-1]) or np.any(end < begin):
                    raise ValueError("spans run backwards")
                decoded = codec.decode(ids)
                rows.append((doc, len(ids), hashlib.sha256(decimal.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), int(end[-1]), span_digest(begin, end)))
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [x.split()[0] for x in DIGEST.split(", ")])

    return documents.select("doc_id", "text").mapInArrow(run, DIGEST)


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset-preserving encoding of the whole corpus, decoded again and digested."""
    return digest_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"))
