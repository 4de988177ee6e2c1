import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from quarrystone.llm import packing, pieces, rans, staging, token_files, wordbpe

EDGES = [(5, None), (3, ""), (1, "a b"), (1, "a b"), (2, "ß" * 300 + " x"), (None, "lost id"), (4, "word " * 9000), (7, " \t\n "), (6, "Hello, WORLD's <|endoftext|> ok")]


def test_memo_equals_library():
    encoder = wordbpe.WordBpe(wordbpe.default_vocabulary())
    rng = random.Random(3)
    alphabet = list("abcXYZ éÉßİΣσñ12٣̧́\u0085\x1c\t\n,.!#日本ﬁ한가🎉") + ["'s", "<|endoftext|>", " ", "the ", "ing "]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    ids, cut = encoder.encode_all(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[cut[k] : cut[k + 1]].tolist() == encoder.tokenizer.encode(t, add_special_tokens=False).ids


def test_memo_eviction_changes_nothing(monkeypatch):
    monkeypatch.setattr(wordbpe, "MEMO_ENTRIES", 40)
    encoder = wordbpe.WordBpe(wordbpe.default_vocabulary())
    for k in range(6):
        text = " ".join(f"word{k}{i}" for i in range(50)) + " the end"
        assert encoder.encode_all(pa.array([text]))[0].tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize(("n", "lanes", "every"), [(0, 8, 4), (1, 8, 4), (1000, 8, 4), (5000, 64, 16), (777, 1024, 256)])
def test_rans_round_trip_and_checkpoints(n, lanes, every):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.3, n).clip(0, 499).astype(np.uint32)
    table = rans.Table(np.bincount(ids, minlength=500) if n else np.zeros(500))
    raw = rans.encode_block(table, ids, [4], [n], lanes, every)
    block = rans.Block(raw, rans.Table.from_bytes(table.to_bytes()))
    assert block.ids().tolist() == ids.tolist() and block.docs.tolist() == [4]
    step = block.lanes * every
    for k in reversed(range(block.segments)):
        assert block.segment(k).tolist() == ids[k * step : (k + 1) * step].tolist()
    if n > 100:
        with pytest.raises(ValueError, match="checksum"):
            rans.Block(raw[:-2] + bytes([raw[-2] ^ 1]) + raw[-1:], table).ids()
        assert len(raw) < 4 * n + 16 * lanes * block.segments + 200


def _expected(rows):
    tokenizer = wordbpe.load(wordbpe.default_vocabulary()).tokenizer
    return [(d, tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for d, t in rows]


def test_token_files(spark, documents, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 64)
    path = token_files.write_tokens(documents(EDGES), staging.new_path(spark, "t"), partitions=3)
    got = sorted(token_files.read_ids(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in EDGES), key=lambda d: (d is not None, d or 0))
    want, start = {}, 0
    for d, ids in _expected(EDGES):
        want[d] = np.array(ids, "<u4").tobytes()
    for r in got:
        assert (r.start, r.n_tokens, bytes(r.ids), r.ids_crc32) == (start, len(want[r.doc_id]) // 4, want[r.doc_id], zlib.crc32(want[r.doc_id]))
        start += r.n_tokens


def test_segments_decode_alone(spark, documents):
    """Blocks of several checkpoints, cut apart and dealt over tasks, hold the ids that the library gives."""
    path = token_files.write_tokens(documents(EDGES), staging.new_path(spark, "t"), partitions=2, lanes=16, every=8)
    got = sorted((r.part, r.start, bytes(r.ids)) for r in token_files.read_segments(spark, path, 5).collect())
    assert len(got) > 50
    flat = b"".join(x for _, _, x in got)
    want = {d: np.array(ids, "<u4").tobytes() for d, ids in _expected(EDGES)}
    assert flat == b"".join(want[d] for d in sorted((d for d, _ in EDGES), key=lambda d: (d is not None, d or 0)))
    before = {}
    for part, start, ids in got:
        assert start == before.get(part, 0)
        before[part] = start + len(ids) // 4


def test_one_id_with_many_rows_is_spread(spark, documents):
    rows = [(7, f"text number {i % 5}") for i in range(90)] + [(3, "a"), (9, "b")]
    path = token_files.write_tokens(documents(rows), staging.new_path(spark, "t"), partitions=4)
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    assert len({r.part for r in blocks}) == 4 and max(r.n_docs for r in blocks) < 60
    got = sorted((r.start, r.doc_id, bytes(r.ids)) for r in token_files.read_ids(spark, path).collect())
    assert [d for _, d, _ in got] == [3] + [7] * 90 + [9]
    assert sorted((d, x) for _, d, x in got) == sorted((d, np.array(ids, "<u4").tobytes()) for d, ids in _expected(rows))


def test_token_query_equals_library(spark, sf, texts):
    """The query of operator 2 over its whole table: ids, places and checksums."""
    start = 0
    got = {r.doc_id: r for r in token_files.op2_token_files(spark, sf).collect()}
    assert set(got) == set(texts)
    for d, ids in _expected(sorted(texts.items())):
        assert (got[d].start, got[d].n_tokens, got[d].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_token_files_of_nothing(spark, documents):
    path = token_files.write_tokens(documents(EDGES).limit(0), staging.new_path(spark, "t"))
    assert token_files.read_ids(spark, path).count() == 0


def test_placement_minimises_squares():
    packer, rng = packing.Packer(64), random.Random(5)
    for _ in range(600):
        size = rng.randint(1, 63)
        before = packer.count.copy()

        def squares(h):
            n = before.copy()
            if h:
                n[h] -= 1
            if h + size < 64:
                n[h + size] += 1
            return int((n[1:64] ** 2).sum())

        options = [0] + [h for h in range(1, 64 - size + 1) if before[h]]
        assert squares(packer.place(size)) == min(map(squares, options))
        packer.add((0, 0, np.zeros(size, np.uint32), size))


def test_packing_covers_every_id(spark, documents):
    rows = EDGES + [(100 + i, "tok " * (37 * i % 5000)) for i in range(60)]
    got = packing.pack(documents(rows), window=512).collect()
    want = {}
    for d, ids in _expected(rows):
        want.setdefault(d, []).append(ids)
    for d, lists in want.items():
        mine = sorted((r for r in got if r.doc_id == d), key=lambda r: r.start)
        assert sum(r.length for r in mine) == sum(map(len, lists))
        for r in mine:
            assert r.doc_tokens == len(lists[0]) and zlib.crc32(np.array(lists[0][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 512 and sum(fill.values()) > 0.95 * 512 * (len(fill) - 3)
    assert packing.pack(documents(rows).limit(0)).count() == 0


def test_pieces_equal_library_and_spans_cover(spark, documents, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    rng = random.Random(1)
    odd = ["".join(rng.choice(list("ab  ▁é\n\t🎉日ẞ")) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    codec = pieces.load(pieces.default_model())
    for t in [*odd, *(t for _, t in EDGES if t), *list(texts.values())[:40]]:
        ids, begin, end, decimal = codec.encode(t)
        assert ids.tolist() == library.encode(t, add_eos=True) and decimal == " ".join(map(str, ids.tolist()))
        assert codec.decode(ids) == library.decode(ids.tolist())
        assert begin[0] == 0 and end[-1] == len(t.encode()) and (begin[1:] == end[:-1]).all()
    rows = {(r.doc_id, tuple(r.ids)) for r in pieces.encode_pieces(documents(EDGES)).collect()}
    assert rows == {(d, tuple(library.encode(t or "", add_eos=True))) for d, t in EDGES}


def test_compiled_map_is_read_like_the_library(tmp_path):
    """A map of the library's own rules: longest prefixes, squeezing, alignment to source bytes."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    rules = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
    spec = proto.ModelProto()
    with open(pieces.default_model(), "rb") as f:
        spec.ParseFromString(f.read())
    made = proto.ModelProto()
    made.ParseFromString(rules.serialized_model_proto())
    spec.normalizer_spec.CopyFrom(made.normalizer_spec)
    codec = pieces.PieceCodec(spec.SerializeToString())
    assert codec.map.units
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice(list("ab ①ﬁ㌔ÅＡ１が゙   …½") + ["  "]) for _ in range(rng.randint(1, 20)))
        ids, begin, end, _ = codec.encode(text)
        assert ids.tolist() == codec.outer.encode(text, add_eos=True)
        assert (end >= begin).all() and (begin[1:] >= begin[:-1]).all() and end[-1] <= len(text.encode())


def test_packing_query_equals_library(spark, sf, texts):
    """The query of operator 5: every id of every document once, in order, in gapless sequences."""
    got = {}
    for r in packing.op5_packing(spark, sf).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert set(got) == set(texts)
    for d, ids in _expected(texts.items()):
        at = 0
        for r in sorted(got[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    fill = {}
    for r in sorted((r for rows in got.values() for r in rows), key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 4096


def test_piece_query_equals_library(spark, sf, texts):
    """The query of operator 7: ids, decoded text and, piece by piece, the library's own surfaces as spans of source bytes."""
    import hashlib

    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    got = {r.doc_id: r for r in pieces.op7_pieces(spark, sf).collect()}
    assert set(got) == set(texts)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    compared = 0
    for d, t in texts.items():
        t = t or ""
        ids = library.encode(t, add_eos=True)
        r = got[d]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.n_bytes) == (len(ids), sha(" ".join(map(str, ids)).encode()), sha(library.decode(ids).encode()), len(t.encode()))
        found = library.encode(t, return_type="proto").pieces
        if any(library.is_byte(p.id) and p.begin == p.end for p in found):
            continue  # of the pieces of a character of several bytes the library spans only the last
        compared += 1
        begin = np.array([p.begin for p in found] + [len(t.encode())], np.int64)
        end = np.array([p.end for p in found] + [len(t.encode())], np.int64)
        assert r.spans_sha256 == pieces.span_digest(begin, end), d
    assert compared > 50


def test_only_the_emptiest_windows_are_taken_apart():
    packer, rng, placed = packing.Packer(64), random.Random(9), []
    for d in range(300):
        size = rng.randint(1, 63)
        done = packer.add((d, 0, np.full(size, d, np.uint32), size))
        if done:
            placed.append(done)
    before = [(level, [p[0] for p in w]) for level in range(64, 0, -1) for w in packer.levels[level]]
    full = packing.FULL * 64 // packing.WINDOW
    rest = sum(level for level, _ in before if level < full)
    stay = sum(level >= full for level, _ in before) + -(-rest // 64)
    finished = list(packer.finish())
    assert len(finished) == stay
    # The fullest keep what was placed there; the gaps of all that weren't nearly full come to less than one window.
    assert all([p[0] for p in w][: len(own)] == own for w, (_, own) in zip(finished, before))
    gaps = [64 - sum(len(p[2]) for p in w) for w, (level, _) in zip(finished, before) if level < full]
    assert sum(gaps) < 64
    parts = {}
    for w in placed + finished:
        assert sum(len(p[2]) for p in w) <= 64
        for d, start, ids, total in w:
            assert (ids == d).all()
            parts.setdefault(d, []).append((start, len(ids), total))
    for cut in parts.values():
        at = 0
        for start, length, total in sorted(cut):
            assert start == at
            at += length
        assert at == total
