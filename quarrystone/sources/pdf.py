"""Page counts from PDF files themselves: cross-references, catalog and page tree, read in place.

Only what leads to the count is read, by ranges: the end of a file, its cross-reference sections, the catalog and the root of the
page tree (in object streams too). A file whose cross-references are damaged is scanned, block by block, for the
last trailer and the last definition of each object on that way. So a task's memory doesn't grow with a file, but for a
compressed section, which is refused above ``MOST_INFLATED`` bytes.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarrystone.sources import storage

MOST_INFLATED = 1 << 28
WINDOW = 1 << 12
BLOCK = 1 << 22
LONGEST = 1 << 10

_SPACE = rb"(?:[\x00\t\n\x0c\r ]|%[^\r\n]*[\r\n])*"
_TOKEN = re.compile(
    _SPACE + rb"(?:(?P<open><<|\[)|(?P<close>>>|\])|/(?P<name>[^\x00\t\n\x0c\r ()<>\[\]{}/%]*)|(?P<ref>\d+[\x00\t\n\x0c\r ]+\d+[\x00\t\n\x0c\r ]+R(?![A-Za-z]))"
    rb"|(?P<number>[+-]?(?:\d+\.?\d*|\.\d+))|(?P<hex><[0-9A-Fa-f\s]*>)|(?P<text>\()|(?P<word>[A-Za-z]+))"
)
_OBJECT = re.compile(_SPACE + rb"(\d+)\s+\d+\s+obj")


class Damaged(ValueError):
    """What stands where it should isn't what it should be."""


#: What reading damaged bytes can raise.
BROKEN = (Damaged, TypeError, AttributeError, IndexError, OverflowError, RecursionError)


class Short(Exception):
    """A value goes on behind the bytes at hand."""


class Ref(int):
    """The number of an object that a value names."""


def value(data: bytes, at: int = 0) -> tuple[object, int]:
    """The value that begins at ``at`` and where it ends: dict, list, Ref, number, name or word (str); strings are None, since no count needs them."""
    stack: list[list] = []
    kinds: list[bytes] = []
    while True:
        token = _TOKEN.match(data, at)
        if not token:
            raise Short
        at, kind = token.end(), token.lastgroup
        if kind in ("ref", "number", "name", "word") and at == len(data):
            raise Short
        if kind == "open":
            stack.append([])
            kinds.append(token["open"])
            continue
        if kind == "close":
            if not stack or (kinds[-1] == b"<<") != (token["close"] == b">>"):
                raise Damaged("unbalanced brackets")
            items, opened = stack.pop(), kinds.pop()
            found: object = dict(zip(items[::2], items[1::2])) if opened == b"<<" and all(isinstance(k, str) for k in items[::2]) else items
        elif kind == "text":
            depth, found = 1, None
            while depth:
                if at >= len(data):
                    raise Short
                c = data[at : at + 1]
                at += 2 if c == b"\\" else 1
                depth += (c == b"(") - (c == b")")
        elif kind == "ref":
            found = Ref(token["ref"].split()[0])
        elif kind == "number":
            found = float(token["number"]) if b"." in token["number"] else int(token["number"])
        else:
            found = None if kind == "hex" else token[kind].decode("latin-1")
        if not stack:
            return found, at
        stack[-1].append(found)


def _unpredicted(data: bytes, width: int) -> bytes:
    """Rows of ``width`` bytes behind PNG filters: none, left, up."""
    rows = np.frombuffer(data[: len(data) // (width + 1) * (width + 1)], np.uint8).reshape(-1, width + 1)
    filters, out = rows[:, 0], rows[:, 1:].copy()
    if (filters > 2).any():
        raise Damaged("a filter of cross-references that isn't read")
    left = filters == 1
    out[left] = np.cumsum(out[left], axis=1, dtype=np.uint8)
    # Runs of "up" rows are running sums from the row before them.
    starts = np.flatnonzero(filters != 2)
    for first, last in zip([0, *starts[starts > 0]], [*starts[starts > 0], len(out)]):
        out[first:last] = np.cumsum(out[first:last], axis=0, dtype=np.uint8)
    return out.tobytes()


class Reader:
    """The objects of one file that can be read at any place (``size()``, ``read_at(bytes, offset)``)."""

    def __init__(self, source: pa.NativeFile) -> None:
        self.source, self.size = source, source.size()
        head = source.read_at(min(self.size, LONGEST), 0)
        self.base = head.find(b"%PDF-")
        if self.base < 0:
            raise Damaged("no PDF header")
        #: Newest first: ("table", [(first, count, offset)]) or ("stream", widths, [(first, count)], rows).
        self.sections: list[tuple] = []
        self.trailer: dict = {}
        self.scanning = False

    def at(self, offset: int, count: int) -> bytes:
        if not 0 <= offset < self.size:
            raise Damaged("an offset outside of the file")
        return self.source.read_at(min(count, self.size - offset), offset)

    def parsed(self, offset: int) -> tuple[object, int]:
        """The value at an offset and where it ends, from as many bytes as that takes."""
        window = WINDOW
        while True:
            data = self.at(offset, window)
            try:
                found, end = value(data if len(data) == window else data + b"\n")
                return found, offset + end
            except Short:
                if len(data) < window or window >= MOST_INFLATED:
                    raise Damaged("a value without an end") from None
                window *= 4

    def object_at(self, offset: int, number: int | None = None) -> tuple[object, int]:
        head = _OBJECT.match(self.at(offset, LONGEST))
        if not head or number is not None and int(head[1]) != number:
            raise Damaged(f"no object {'' if number is None else number} where it should be")
        return self.parsed(offset + head.end())

    def stream(self, known: dict, end: int) -> bytes:
        """The bytes of the stream whose dictionary ends at ``end``."""
        word = re.match(_SPACE + rb"stream\r?\n", self.at(end, LONGEST))
        length, kind, parms = (self.resolved(known.get(k)) for k in ("Length", "Filter", "DecodeParms"))
        if not word or not isinstance(length, int) or length > MOST_INFLATED:
            raise Damaged("no stream where it should be")
        data = self.at(end + word.end(), length)
        kinds = kind if isinstance(kind, list) else [kind] if kind else []
        if kinds not in ([], ["FlateDecode"]):
            raise Damaged(f"filters {kinds} of cross-references or objects aren't read")
        if kinds:
            inflate = zlib.decompressobj()
            try:
                data = inflate.decompress(data, MOST_INFLATED)
            except zlib.error as broken:
                raise Damaged(f"a damaged stream: {broken}") from None
            if inflate.unconsumed_tail:
                raise Damaged("a stream that inflates beyond bounds")
        parms = parms[0] if isinstance(parms, list) and parms else parms
        if isinstance(parms, dict) and parms.get("Predictor", 1) >= 10:
            data = _unpredicted(data, parms.get("Columns", 1))
        return data

    def read_sections(self) -> None:
        tail = self.at(max(0, self.size - 2 * LONGEST), 2 * LONGEST)
        starts = re.findall(rb"startxref\s+(\d+)", tail)
        if not starts:
            raise Damaged("no startxref")
        ahead, seen = [int(starts[-1])], set()
        while ahead:
            offset = ahead.pop(0)
            if offset in seen:
                continue
            seen.add(offset)
            known = self.section(self.base + offset)
            self.trailer = known | self.trailer
            ahead += [known[k] for k in ("XRefStm", "Prev") if isinstance(known.get(k), int)]

    def section(self, offset: int) -> dict:
        """One cross-reference section joins the others; its trailer."""
        start = re.match(_SPACE + rb"xref\s*", self.at(offset, LONGEST))
        if not start:
            known, end = self.object_at(offset)
            if not isinstance(known, dict) or known.get("Type") != "XRef" or not isinstance(known.get("W"), list):
                raise Damaged("no cross-references where they should be")
            index = known.get("Index") or [0, known.get("Size", 0)]
            self.sections.append(("stream", known["W"], list(zip(index[::2], index[1::2])), self.stream(known, end)))
            return known
        at, parts = offset + start.end(), []
        while part := re.match(rb"\s*(\d+)\s+(\d+)[ \t]*(?:\r\n|\r|\n)", self.at(at, 64)):
            first, count = int(part[1]), int(part[2])
            parts.append((first, count, at + part.end()))
            at += part.end() + 20 * count
        word = re.match(rb"\s*trailer", self.at(at, 64))
        known = self.parsed(at + word.end())[0] if word else None
        if not isinstance(known, dict):
            raise Damaged("no trailer where it should be")
        self.sections.append(("table", parts))
        return known

    def entry(self, number: int) -> tuple[int, int, int]:
        """(1, offset, 0) of an object in the file, (2, object stream, place) of one in a stream."""
        for kind, *known in self.sections:
            if kind == "table":
                for first, count, offset in known[0]:
                    if first <= number < first + count:
                        line = re.match(rb"(\d{10}) \d{5} ([nf])", self.at(offset + 20 * (number - first), 20))
                        if not line:
                            raise Damaged("cross-references out of line")
                        if line[2] == b"n":
                            return 1, self.base + int(line[1]), 0
            else:
                (a, b, c), parts, rows = known
                before = 0
                for first, count in parts:
                    if first <= number < first + count:
                        row = rows[(before + number - first) * (a + b + c) :][: a + b + c]
                        kind, x, y = int.from_bytes(row[:a], "big") if a else 1, int.from_bytes(row[a : a + b], "big"), int.from_bytes(row[a + b :], "big")
                        if kind:
                            return kind, self.base + x if kind == 1 else x, y
                    before += count
        raise Damaged(f"object {number} isn't there")

    def found(self, pattern: bytes) -> Iterator[int]:
        """Where a pattern of at most ``LONGEST`` bytes matches, over the whole file, in blocks."""
        for start in range(0, self.size, BLOCK):
            before = min(start, 1)
            data = self.at(start - before, BLOCK + LONGEST + before)
            yield from (start - before + m.start() for m in re.finditer(pattern, data) if before <= m.start() < BLOCK + before)

    def resolved(self, named: object) -> object:
        hops = 0
        while isinstance(named, Ref):
            hops += 1
            if hops > 16:
                raise Damaged("references in a circle")
            named = self.get(int(named))
        return named

    def get(self, number: int) -> object:
        if self.scanning:
            last = None
            for last in self.found(rb"(?<!\d)%d\s+\d+\s+obj(?![A-Za-z])" % number):
                pass
            if last is None:
                raise Damaged(f"object {number} isn't there")
            return self.object_at(last, number)[0]
        kind, x, y = self.entry(number)
        if kind == 1:
            return self.object_at(x, number)[0]
        place, offset, _ = self.entry(x)
        if place != 1:
            raise Damaged("an object stream inside another")
        if "Encrypt" in self.trailer:
            raise ValueError("encrypted object streams")
        known, end = self.object_at(offset, x)
        if not isinstance(known, dict) or not all(isinstance(known.get(k), int) for k in ("N", "First")):
            raise Damaged("no object stream where it should be")
        data = self.stream(known, end)
        pairs = data[: known["First"]].split()[: 2 * known["N"]]
        for n, begin in zip(pairs[::2], pairs[1::2]):
            if int(n) == number:
                try:
                    return value(data + b"\n", known["First"] + int(begin))[0]
                except Short:
                    raise Damaged("a value without an end") from None
        raise Damaged(f"object {number} isn't there")

    def scanned_root(self) -> object:
        """The catalog of a file without usable cross-references: the last that a trailer names, else the last object that is one."""
        root = None
        for place in self.found(rb"trailer(?![A-Za-z])"):
            try:
                known = self.parsed(place + len("trailer"))[0]
            except Damaged:
                continue
            if isinstance(known, dict) and isinstance(known.get("Root"), Ref):
                root = known["Root"]
        if root is not None:
            return root
        for place in self.found(rb"(?<!\d)\d+\s+\d+\s+obj(?![A-Za-z])\s*<<"):
            try:
                known = self.object_at(place)[0]
            except Damaged:
                continue
            if isinstance(known, dict) and known.get("Type") == "Catalog":
                root = known
            elif isinstance(known, dict) and known.get("Type") == "XRef" and isinstance(known.get("Root"), Ref) and not isinstance(root, dict):
                root = known["Root"]
        return root

    def count(self, root: object) -> int:
        catalog = self.resolved(root)
        pages = self.resolved(catalog.get("Pages")) if isinstance(catalog, dict) else None
        if not isinstance(pages, dict):
            raise Damaged("no page tree")
        if pages.get("Type") == "Page":
            return 1
        total = self.resolved(pages.get("Count"))
        if isinstance(total, (int, float)) and 0 < total < 1 << 31:
            return int(total)
        # No sound total: the leaves are counted, each node once.
        leaves, ahead, seen = 0, [pages], set()
        while ahead:
            kids = self.resolved(ahead.pop().get("Kids"))
            for kid in kids if isinstance(kids, list) else []:
                if isinstance(kid, Ref) and kid in seen:
                    continue
                seen.add(kid if isinstance(kid, Ref) else None)
                node = self.resolved(kid)
                if isinstance(node, dict):
                    if "Kids" in node:
                        ahead.append(node)
                    else:
                        leaves += 1
        return leaves

    def pages(self) -> int:
        try:
            self.read_sections()
            return self.count(self.trailer.get("Root"))
        except BROKEN as first:
            self.scanning = True
            try:
                return self.count(self.scanned_root())
            except BROKEN:
                raise first from None


def pages_of(source: pa.NativeFile) -> tuple[int | None, str | None]:
    """(pages, None), or (None, what is wrong)."""
    try:
        return Reader(source).pages(), None
    except (ValueError, *BROKEN) as wrong:
        return None, str(wrong)


def _probed(item: str | bytes | None) -> tuple[int | None, str | None]:
    if item is None:
        return None, "no file"
    if isinstance(item, bytes):
        return pages_of(pa.BufferReader(item))
    try:
        system, path, _ = storage.located(item)
        with system.open_input_file(path) as source:
            return pages_of(source)
    except OSError as wrong:
        return None, str(wrong)


def page_counts(files: DataFrame, column: str = "path", strict: bool = False) -> DataFrame:
    """``files`` with ``page_count`` and ``page_count_error`` (one of them null) of the PDF that ``column`` names (a URI) or holds (binary).

    Files are dealt over tasks by their paths. A file that can't be opened, a null and an empty file have an error; with ``strict`` the first error
    ends the job instead. Encrypted files are counted where the count isn't in an encrypted stream.
    """
    added = ["page_count", "page_count_error"]
    kept = files.drop(*added)
    where = kept.columns.index(column)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_probed(item) for item in batch.column(where).to_pylist()]
            counts, errors = pa.array([n for n, _ in found], pa.int32()), pa.array([e for _, e in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts, errors], [*batch.schema.names, *added])

    if dict(kept.dtypes)[column] != "binary":
        kept = kept.repartition(int(files.sparkSession.conf.get("spark.sql.shuffle.partitions")), column)
    schema = T.StructType([*kept.schema.fields, T.StructField("page_count", T.IntegerType()), T.StructField("page_count_error", T.StringType())])
    rows = kept.mapInArrow(probe, schema)
    if not strict:
        return rows
    # The count is what is checked, so that it can't be read without the check.
    failed = F.raise_error(F.concat(F.lit("no page count: "), F.col("page_count_error")))
    return rows.withColumn("page_count", F.when(F.col("page_count_error").isNull(), F.col("page_count")).otherwise(failed.cast("int")))
