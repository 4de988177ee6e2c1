"""SQL dumps as rows: files are cut into byte ranges anywhere, and statements are read where they begin.

Whether a cut lies inside a text, a quoted name or a comment can't be told from the bytes around it. So a first pass over the
ranges finds where each one ends for every state it may begin in, the states are chained over the ranges of a file (one short row
a range), and a second pass reads the statements that begin in a range whose first state is now known.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StructType

from quarrystone import shared
from quarrystone.sources import files, storage

CODE, TEXT, DOUBLE, TICK, LINE, BLOCK = range(6)
#: What ends a state that begins with the key, and the states by their first bytes.
OPENS = {b"'": TEXT, b'"': DOUBLE, b"`": TICK, b"-": LINE, b"/": BLOCK}
#: The characters that letters behind a backslash stand for.
CONTROL = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"0": b"\0", b"b": b"\b", b"Z": b"\x1a"}
PACKED = {".gz": "gzip", ".bz2": "bz2", ".zst": "zstd"}
#: What may stand between a statement's verb and its table.
AHEAD = tuple(b"INTO IGNORE LOW_PRIORITY DELAYED HIGH_PRIORITY OR REPLACE ABORT FAIL ROLLBACK IF NOT EXISTS".split())
RANGE = "path string, size long, begin long, stop long"
ROW = "path string, offset long, row long, kind string, table string, columns array<string>, values array<string>"
EXITS = pa.schema([("path", pa.string()), ("size", pa.int64()), ("begin", pa.int64()), ("stop", pa.int64()), ("exits", pa.list_(pa.int32()))])
BATCH = 4096


class Lexer:
    """The patterns of a dialect: with ``escapes`` a backslash in a text takes the next character (MySQL), else only doubled quotes do."""

    def __init__(self, escapes: bool) -> None:
        inside = rb"(?:[^%(q)s\\]++|\\.)*+" if escapes else rb"[^%(q)s]*+"
        text, double = (inside % {b"q": q} + q for q in (b"'", b'"'))
        self.ends = {state: re.compile(p, re.S) for state, p in ((TEXT, text), (DOUBLE, double), (TICK, rb"[^`]*+`"), (LINE, rb"[^\n]*+\n"), (BLOCK, rb".*?\*/"))}
        whole = rb"'" + text + rb'|"' + double + rb"|`[^`]*+`|--[^\n]*+\n|/\*.*?\*/|-(?!-)|/(?!\*)"
        self.code = re.compile(rb"""(?:[^'"`\-/]++|""" + whole + rb")*+", re.S)
        self.statement = re.compile(rb"""(?:[^'"`\-/;]++|""" + whole + rb")*+", re.S)
        # A text may be doubled at its end, which makes it go on.
        quoted = rb"'" + text + rb"(?:'" + text + rb")*+"
        names = rb'"' + double + rb'(?:"' + double + rb")*+|`[^`]*+`(?:`[^`]*+`)*+"
        self.token = re.compile(
            rb"(?P<space>\s++)|(?P<comment>--[^\n]*+\n|/\*.*?\*/)|(?P<text>" + quoted + rb")|(?P<name>" + names + rb")|(?P<mark>[(),;])|(?P<word>(?:[^\s'\"`(),;\-/]|-(?!-)|/(?!\*))++)",
            re.S,
        )
        self.escapes = escapes

    def after(self, data: bytes, state: int) -> tuple[int, bool]:
        """Where a state that ``data`` begins in ends there, and whether it does."""
        if state == CODE:
            return 0, True
        m = self.ends[state].match(data)
        return (m.end(), True) if m else (len(data), False)

    def exit(self, data: bytes, state: int) -> int:
        at, ended = self.after(data, state)
        if not ended:
            return state
        at = self.code.match(data, at).end()
        return CODE if at == len(data) else OPENS[data[at : at + 1]]

    def unquoted(self, token: bytes) -> str:
        """A text or a quoted name without its quotes."""
        quote, body = token[:1], token[1:-1]
        if self.escapes and quote != b"`":
            # One pass, since a quote behind a backslash is no half of a doubled one.
            body = re.sub(rb"\\(.)|" + quote * 2, lambda m: quote if m[1] is None else CONTROL.get(m[1], m[1]), body, flags=re.S)
        else:
            body = body.replace(quote * 2, quote)
        return body.decode(errors="replace")


def _cut(data: bytes) -> int:
    """The first place after a byte that begins no sign of two bytes and is no quote; -1 if there is none."""
    m = re.search(rb"""[^\\\-/*'"`]""", data)
    return m.end() if m else -1


def _placed(handle, at: int, size: int) -> int:
    """Where the cut wanted at ``at`` is made."""
    if at <= 0 or at >= size:
        return max(0, min(at, size))
    while at < size:
        handle.seek(at)
        block = handle.read(storage.BLOCK)
        found = _cut(block)
        if found >= 0:
            return at + found
        at += len(block)
    return size


def _exits(escapes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexer = Lexer(escapes)
        for batch in batches:
            for row in batch.to_pylist():
                system, path, _ = storage.located(row["path"])
                with system.open_input_file(path) as f:
                    begin, stop = _placed(f, row["begin"], row["size"]), _placed(f, row["stop"], row["size"])
                    f.seek(begin)
                    data = f.read(stop - begin)
                yield pa.RecordBatch.from_pylist([row | {"begin": begin, "stop": stop, "exits": [lexer.exit(data, s) for s in range(6)]}], EXITS)

    return run


def _chained(ranges: pd.DataFrame) -> pd.DataFrame:
    """The state that each range of a file begins in."""
    ranges, state, states = ranges.sort_values(["begin", "stop"]), CODE, []
    for exits in ranges["exits"]:
        states.append(state)
        state = exits[state]
    return ranges.assign(state=states)[["path", "size", "begin", "stop", "state"]]


class Statements:
    """Rows of the INSERT, REPLACE and CREATE TABLE statements of a stream of bytes; what is held is a block and one row."""

    def __init__(self, lexer: Lexer, stream, data: bytes, offset: int) -> None:
        self.lexer, self.stream, self.data, self.base, self.at, self.ended = lexer, stream, data, offset, 0, False

    def more(self) -> None:
        kept = self.data[self.at :]
        block = self.stream.read(max(storage.BLOCK, len(kept)))
        self.ended, self.base, self.at = not block, self.base + self.at, 0
        # A comment that the end of the file ends needs no line end of its own.
        self.data = kept + (block or b"\n")

    def token(self) -> tuple[str, bytes] | None:
        """The next token that is no blank and no comment; None at the end."""
        while True:
            m = self.lexer.token.match(self.data, self.at)
            if m and (m.end() < len(self.data) or self.ended):
                self.at = m.end()
                if m.lastgroup not in ("space", "comment"):
                    return m.lastgroup, m[0]
            elif not self.ended:
                self.more()
            elif self.at >= len(self.data):
                return None
            else:
                raise ValueError(f"byte {self.base + self.at}: a text, a name or a comment isn't closed")

    def expect(self) -> tuple[str, bytes]:
        token = self.token()
        if token is None:
            raise ValueError(f"byte {self.base + self.at}: the file ends inside a statement")
        return token

    def named(self, kind: str, token: bytes) -> str:
        return self.lexer.unquoted(token) if kind in ("name", "text") else token.decode(errors="replace")

    def group(self) -> list[list[tuple[str, bytes]]]:
        """The parts between commas of what an opening bracket, just read, begins."""
        parts, depth = [[]], 1
        while True:
            kind, token = self.expect()
            depth += (token == b"(") - (token == b")") if kind == "mark" else 0
            if depth == 0:
                return parts if parts[-1] or len(parts) > 1 else []
            if kind == "mark" and token == b"," and depth == 1:
                parts.append([])
            else:
                parts[-1].append((kind, token))

    def value(self, part: list[tuple[str, bytes]]) -> str | None:
        """A text without quotes (an introducer such as ``_binary`` or ``N`` is dropped), null, or the expression as it is written."""
        if len(part) == 1 and part[0][0] == "word" and part[0][1].upper() == b"NULL":
            return None
        if len(part) == 1 and self.lexer.escapes and part[0][1][:1] == b'"':
            return self.lexer.unquoted(part[0][1])
        if part and part[-1][0] == "text" and (len(part) == 1 or (len(part) == 2 and (part[0][1][:1] == b"_" or part[0][1] in (b"N", b"E")))):
            return self.lexer.unquoted(part[-1][1])
        return b"".join(t for _, t in part).decode(errors="replace")

    def rest(self) -> None:
        while (token := self.token()) is not None and token != ("mark", b";"):
            pass

    def rows(self, stop: int | None) -> Iterator[tuple]:
        """(offset, row, kind, table, columns, values) of the statements that begin ahead of ``stop``."""
        while stop is None or self.base + self.at < stop:
            offset = self.base + self.at
            token = self.token()
            if token is None:
                return
            verb = token[1].upper() if token[0] == "word" else b""
            if verb in (b"INSERT", b"REPLACE"):
                yield from self.inserted(offset)
            elif verb == b"CREATE":
                yield from self.created(offset)
            elif token != ("mark", b";"):
                self.rest()

    def table(self) -> tuple[str, tuple[str, bytes]]:
        """The last part of a table's name, and the token behind it."""
        kind, token = self.expect()
        while kind == "word" and token.upper() in AHEAD:
            kind, token = self.expect()
        name = b""
        while kind in ("word", "name") and (not name or name.endswith(b".") or token.startswith(b".")):
            # An unquoted name may hold its schema's name and the point, or end or begin with the point.
            name, of = (token.rpartition(b".")[2] or token, kind) if kind == "word" else (token, kind)
            kind, token = self.expect()
        return self.named(of, name) if name else "", (kind, token)

    def inserted(self, offset: int) -> Iterator[tuple]:
        name, (kind, token) = self.table()
        columns, n = None, 0
        if token == b"(":
            columns = [self.named(*p[0]) for p in self.group() if p]
            kind, token = self.expect()
        if kind != "word" or token.upper() not in (b"VALUES", b"VALUE"):
            return self.rest()
        while True:
            token = self.token()
            if token is None or token == ("mark", b";"):
                return None
            if token == ("mark", b"("):
                yield offset, n, "row", name, columns, [self.value(p) for p in self.group()]
                n += 1
            elif token != ("mark", b","):
                return self.rest()

    def created(self, offset: int) -> Iterator[tuple]:
        kind, token = self.expect()
        while kind == "word" and token.upper() in (b"TEMPORARY", b"TEMP", b"UNLOGGED"):
            kind, token = self.expect()
        if token.upper() != b"TABLE":
            return self.rest()
        name, token = self.table()
        if token == ("mark", b"("):
            keys = (b"PRIMARY", b"KEY", b"UNIQUE", b"CONSTRAINT", b"INDEX", b"FOREIGN", b"CHECK", b"FULLTEXT", b"SPATIAL", b"EXCLUDE")
            parts = [p for p in self.group() if p and not (p[0][0] == "word" and p[0][1].upper() in keys)]
            yield offset, 0, "table", name, [self.named(*p[0]) for p in parts], [b" ".join(t for _, t in p[1:]).decode(errors="replace") for p in parts]
        elif token == ("mark", b";"):
            return None
        return self.rest()


def _batch(path: str, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    texts = pa.list_(pa.string())
    types = (pa.int64(), pa.int64(), pa.string(), pa.string(), texts, texts)
    return pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), *(pa.array(c, t) for c, t in zip(columns, types))], ["path", "offset", "row", "kind", "table", "columns", "values"])


def _parsed(escapes: bool):
    def statements(lexer: Lexer, row: dict) -> Iterator[tuple]:
        system, path, _ = storage.located(row["path"])
        packed = next((codec for end, codec in PACKED.items() if path.endswith(end)), None)
        if packed:
            with system.open_input_stream(path, compression=packed) as stream:
                yield from Statements(lexer, stream, b"", 0).rows(None)
            return
        with system.open_input_file(path) as f:
            # One byte more is read: a range may begin right behind the end of a statement.
            ahead = min(1, row["begin"])
            f.seek(row["begin"] - ahead)
            data = f.read(row["stop"] - row["begin"] + ahead)
            at = 0
            if ahead and not (row["state"] == CODE and data[:1] == b";"):
                skipped, ended = lexer.after(data[1:], row["state"])
                at = lexer.statement.match(data, 1 + skipped).end() if ended else len(data)
                if data[at : at + 1] != b";":
                    return
            found = Statements(lexer, f, data[at + ahead :], row["begin"] + at)
            yield from found.rows(row["stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexer = Lexer(escapes)
        for batch in batches:
            for row in batch.to_pylist():
                rows, held = [], 0
                try:
                    for found in statements(lexer, row):
                        rows.append(found)
                        held += sum(len(v) for v in found[-1] if v)
                        if len(rows) == BATCH or held > 1 << 24:
                            yield _batch(row["path"], rows)
                            rows, held = [], 0
                except ValueError as e:
                    raise ValueError(f"{row['path']}: {e}") from e
                if rows:
                    yield _batch(row["path"], rows)

    return run


def sql_dump(spark: SparkSession, root: str, escapes: bool = True, split_bytes: int = 32 << 20, names: str = r"(?i)\.sql(\.(gz|bz2|zst))?$") -> DataFrame:
    """(path, offset, row, kind, table, columns, values) of the dumps below ``root``, files whose names match ``names``; .gz, .bz2 and .zst are unpacked.

    A row of kind ``row`` is one group of values of an INSERT or REPLACE statement: the byte its statement begins behind, its number
    there, the table's name without its schema, the columns named (null for none) and the values as text, null for NULL;
    expressions that are no text stay as written. One of kind ``table`` has the columns of a CREATE TABLE and their types. Other
    statements, and COPY with its data, aren't read, and bodies of routines aren't told from the rest. Comments are skipped, those with an exclamation mark too.

    Plain files are cut into ranges of ``split_bytes`` and read twice, packed ones are one task's stream. A task holds a range and the row it is at. A
    statement is read whole by the range it begins in, over as many bytes as it has. Empty files and files without statements give nothing;
    an unclosed text or statement fails with its path and place.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = files.list_files(spark, root, "").filter(F.col("filename").rlike(names)).filter("size_bytes > 0")
    packed = F.col("filename").rlike(r"\.(gz|bz2|zst)$")
    begins = F.when(packed, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("size_bytes") - 1, F.lit(split_bytes).cast("long")))
    ranges = named.select("path", F.col("size_bytes").alias("size"), packed.alias("packed"), F.explode(begins).alias("begin"))
    ranges = ranges.withColumn("stop", F.when(F.col("packed"), F.col("size")).otherwise(F.least(F.col("begin") + split_bytes, "size")))
    plain = ranges.filter("NOT packed").drop("packed").repartition(tasks, "path", "begin").mapInArrow(_exits(escapes), RANGE + ", exits array<int>")
    states = plain.groupBy("path").applyInPandas(_chained, RANGE + ", state int").filter("stop > begin")
    whole = ranges.filter("packed").select("path", "size", "begin", "stop", F.lit(CODE).alias("state"))
    # Written, as what reads the ranges must not find the states once more.
    known = shared.stored(states.unionByName(whole), "dump")
    return known.repartition(tasks, "path", "begin").mapInArrow(_parsed(escapes), ROW)


def dump_table(rows: DataFrame, table: str, schema: StructType | str) -> DataFrame:
    """One table of a ``sql_dump`` as typed columns, by name.

    Where a statement names no columns they are those of the file's last CREATE TABLE of that table, else those of ``schema`` in
    order. A column that isn't there, or a value that its type can't take, is null.
    """
    fields = (StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    mine = rows.filter(F.col("table") == table)
    last = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("offset")))
    declared = mine.filter("kind = 'table'").withColumn("_turn", last).filter("_turn = 1").select("path", F.col("columns").alias("_declared"))
    given = mine.filter("kind = 'row'").join(declared, "path", "left")
    names = F.coalesce("columns", "_declared", F.array(*(F.lit(f.name) for f in fields)))
    place = lambda f: F.nullif(F.array_position("_names", f.name), F.lit(0))
    return given.withColumn("_names", names).select(*(F.get("values", place(f) - 1).try_cast(f.dataType).alias(f.name) for f in fields))


def dump_statements(rows: DataFrame, table: str) -> DataFrame:
    """(value): an INSERT statement for each row, escaped as ``sql_dump`` reads it with ``escapes``; ``write.text`` makes a dump of them, without a shuffle."""
    parts = []
    for f in rows.schema.fields:
        c = F.col(f"`{f.name.replace(chr(96), chr(96) * 2)}`").cast("string")
        if not isinstance(f.dataType, (NumericType, BooleanType)):
            c = F.concat(F.lit("'"), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("''")), F.lit("'"))
        parts += [F.lit(","), F.coalesce(c, F.lit("NULL"))]
    names = ",".join(f"`{name.replace('`', '``')}`" for name in rows.columns)
    return rows.select(F.concat(F.lit(f"INSERT INTO `{table}` ({names}) VALUES ("), *parts[1:], F.lit(");")).alias("value"))
