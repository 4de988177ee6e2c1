import io
import re
import zlib

import pyarrow as pa
import pytest

from quarrystone.sources import pdf


def _file(objects, root="1 0 R", header=b"%PDF-1.5\n", shift=0, extra="", prev=None, before=b""):
    """Objects by number behind ``before``, with a cross-reference table of their own."""
    out = bytearray(before or header)
    places = {}
    for number, body in objects.items():
        places[number] = len(out)
        out += f"{number} 0 obj\n".encode() + (body if isinstance(body, bytes) else body.encode()) + b"\nendobj\n"
    start = len(out)
    out += b"xref\n" + (b"" if before else b"0 1\n0000000000 65535 f \n")
    for number, place in sorted(places.items()):
        out += f"{number} 1\n{place:010d} 00000 n \n".encode()
    last = f" /Prev {prev}" if prev is not None else ""
    out += f"trailer\n<< /Size {max(objects) + 1} /Root {root}{last}{extra} >>\nstartxref\n{start + shift}\n%%EOF\n".encode()
    return bytes(out)


def _stream(head, data):
    packed = zlib.compress(data)
    return f"<< {head} /Filter /FlateDecode /Length {len(packed)} >>\nstream\n".encode() + packed + b"\nendstream"


def _compressed(count, predictor=None, encrypt=""):
    """Catalog and page tree in an object stream, places in a cross-reference stream."""
    bodies = [b"<</Type/Catalog/Pages 2 0 R>>", f"<</Type/Pages/Kids[]/Count {count}>>".encode()]
    head = f"1 0 2 {len(bodies[0]) + 1} ".encode()
    out = bytearray(b"%PDF-1.5\n")
    held = len(out)
    out += b"3 0 obj\n" + _stream(f"/Type /ObjStm /N 2 /First {len(head)}", head + b" ".join(bodies)) + b"\nendobj\n"
    start = len(out)
    rows = [(0, 0, 255), (2, 3, 0), (2, 3, 1), (1, held, 0), (1, start, 0)]
    plain = [bytes([k]) + x.to_bytes(2, "big") + bytes([y]) for k, x, y in rows]
    parms = ""
    if predictor:
        parms, known, packed = " /DecodeParms << /Predictor 12 /Columns 4 >>", bytes(4), []
        for row, kind in zip(plain, predictor):
            ahead = {0: bytes(4), 1: b"\0" + row[:3], 2: known}[kind]
            packed.append(bytes([kind]) + bytes((x - y) % 256 for x, y in zip(row, ahead)))
            known = row
        plain = packed
    out += b"4 0 obj\n" + _stream(f"/Type /XRef /W [1 2 1] /Size 5 /Root 1 0 R{parms}{encrypt}", b"".join(plain)) + b"\nendobj\n"
    out += f"startxref\n{start}\n%%EOF".encode()
    return bytes(out)


TREE = {1: "<< /Type /Catalog /Pages 2 0 R >>", 2: "<< /Type /Pages /Kids [3 0 R] /Count 7 >>", 3: "<< /Type /Page /Parent 2 0 R >>"}
PLAIN = _file(TREE)
NESTED = {1: "<< /Pages 2 0 R >>", 2: "<< /Type /Pages /Kids [3 0 R 4 0 R 2 0 R] >>", 3: "<< /Type /Page >>", 4: "<< /Kids [5 0 R 6 0 R 3 0 R] >>", 5: "<< /Type /Page >>", 6: "<< /Type /Page >>"}
PUT = r"<< /Title (a \) >> (b) /Count 99) % /Count 98 >>" + "\n" + "/ID <4f7B> /Type/Pages/Count 12/Kids[]>>"
UPDATED = _file({2: "<< /Type /Pages /Kids [] /Count 8 >>"}, before=PLAIN, prev=int(re.findall(rb"startxref\s(\d+)", PLAIN)[-1]))


@pytest.mark.parametrize(
    ("content", "pages"),
    {
        "plain": (PLAIN, 7),
        "updated": (UPDATED, 8),
        "junk ahead": (b"HTTP/1.1 200 OK\n\n" + PLAIN, 7),
        "count by reference": (_file(TREE | {2: "<< /Type /Pages /Count 9 0 R >>", 9: "31"}), 31),
        "count as a real number": (_file(TREE | {2: "<< /Type /Pages /Count 4.0 >>"}), 4),
        "one page as the tree": (_file(TREE | {2: "<< /Type /Page >>"}), 1),
        "no count, kids in a circle": (_file(NESTED), 3),
        "strings and comments": (_file(TREE | {2: PUT}), 12),
        "object stream": (_compressed(300), 300),
        "predictor": (_compressed(300, [2, 2, 2, 2, 2]), 300),
        "mixed predictors": (_compressed(300, [0, 2, 1, 0, 2]), 300),
        "wrong startxref": (_file(TREE, shift=5), 7),
        "cut behind the trees": (PLAIN[: PLAIN.index(b"xref")], 7),
        "an update that is cut is not read": (UPDATED[: UPDATED.rindex(b"startxref")], 7),
        "updated, without any startxref": (UPDATED.replace(b"startxref", b"x"), 8),
        "cut inside of a trailer": (PLAIN[: PLAIN.index(b"/Root")], 7),
        "lines of other lengths": (PLAIN.replace(b" n \n", b" n\n"), 7),
        "long dictionary": (_file(TREE | {2: "<< /Kids [" + "3 0 R " * 50_000 + "] /Count 50000 >>"}), 50_000),
        "deep prefix": (PLAIN.replace(b"%PDF-1.5\n", b"%PDF-1.5\n" + b"%" + b"x" * 9_000 + b"\n"), 7),
    }.values(),
)
def test_pages(content, pages):
    assert pdf.pages_of(pa.BufferReader(content)) == (pages, None)


@pytest.mark.parametrize(
    ("content", "error"),
    [
        (b"", "no PDF header"), (b"<html>", "no PDF header"), (b"%PDF-1.4\n", "no startxref"), (PLAIN[: PLAIN.index(b"1 0 obj") + 20], "no startxref"),
        (_compressed(3, encrypt=" /Encrypt 9 0 R"), "encrypted object streams"), (_file(TREE | {1: "<< /Pages 1 0 R >>", 2: "7"}, root="2 0 R"), "no page tree"),
        (_file({1: "2 0 R", 2: "1 0 R"}), "references in a circle"),
    ],
)
def test_errors(content, error):
    assert pdf.pages_of(pa.BufferReader(content)) == (None, error)


def test_any_cut_or_flip_is_a_count_or_an_error():
    for content in (PLAIN, UPDATED, _compressed(300, [2, 2, 2, 2, 2])):
        for at in range(0, len(content), 3):
            for odd in (content[:at], content[:at] + b"\xff" + content[at + 1 :], content[:at] + b"(" + content[at:]):
                pages, error = pdf.pages_of(pa.BufferReader(odd))
                assert (pages is None) != (error is None)


def test_scans_find_what_crosses_blocks(monkeypatch):
    broken = UPDATED.replace(b"startxref", b"x")
    for block in (1, 7, 64, len(broken) + 1):
        monkeypatch.setattr(pdf, "BLOCK", block)
        assert pdf.pages_of(pa.BufferReader(broken)) == (8, None)


def test_reads_little_of_a_large_file(tmp_path):
    """Some kilobytes of a file of 300 MB are read."""
    path = tmp_path / "large.pdf"
    with open(path, "wb") as f:
        f.write(b"%PDF-1.5\n")
        f.seek(300 << 20)
        f.write(_file(TREE, before=b" "))
    # The table counts from the start of what was written behind the hole.
    tail = open(path, "rb").read()[300 << 20 :]
    moved = re.sub(rb"(\d{10}) 00000 n", lambda m: b"%010d 00000 n" % (int(m[1]) + (300 << 20)), tail)
    moved = re.sub(rb"startxref\n(\d+)", lambda m: b"startxref\n%d" % (int(m[1]) + (300 << 20)), moved)
    with open(path, "r+b") as f:
        f.seek(300 << 20)
        f.write(moved)

    class Counted(io.RawIOBase):
        read_bytes = 0

        def __init__(self):
            self.file = pa.OSFile(str(path))

        def size(self):
            return self.file.size()

        def read_at(self, count, offset):
            Counted.read_bytes += count
            return self.file.read_at(count, offset)

    assert pdf.pages_of(Counted()) == (7, None)
    assert Counted.read_bytes < 100_000


def test_frames(spark, tmp_path):
    (tmp_path / "a +(1).pdf").write_bytes(PLAIN)
    (tmp_path / "b.pdf").write_bytes(b"")
    rows = [(1, str(tmp_path / "a +(1).pdf"), 5), (2, f"file:{tmp_path}/b.pdf", None), (3, str(tmp_path / "gone.pdf"), None), (4, None, None)]
    found = {r.id: r for r in pdf.page_counts(spark.createDataFrame(rows, "id int, path string, page_count int")).collect()}
    assert found[1].page_count == 7 and found[1].page_count_error is None and found[2].page_count_error == "no PDF header"
    assert found[3].page_count is None and "gone.pdf" in found[3].page_count_error and found[4].page_count_error == "no file"
    held = spark.createDataFrame([(_compressed(3),), (None,)], "content binary")
    assert {(r.page_count, r.page_count_error) for r in pdf.page_counts(held, "content").collect()} == {(3, None), (None, "no file")}
    assert pdf.page_counts(held.filter("content IS NOT NULL"), "content", strict=True).first().page_count == 3
    with pytest.raises(Exception, match="no page count: no file"):
        pdf.page_counts(held, "content", strict=True).collect()
    assert pdf.page_counts(held.limit(0), "content").count() == 0
