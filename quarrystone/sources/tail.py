"""Growing text files as a stream: the offset is how far each file has been read."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from quarrystone.sources import storage

SCHEMA = "path string, offset long, line string"
BATCH = 10_000


@dataclass
class Range(InputPartition):
    """Lines of a file that start in [start, end), of bytes that are read up to ``stop``."""

    path: str
    start: int
    end: int
    stop: int
    first: bool


class GrowingLines(DataSource):
    """``growing_lines``: (path, offset, line) of the lines that are appended to the files below ``path``, each once.

    A trigger reads from where the last one ended to each file's last line end, so a line that is still being written waits; with
    ``drain`` it counts as it stands (for a writer that has ended). ``from=end`` leaves out what is there when the query first starts.
    The checkpoint has a number of bytes for each file; files that appear later are read from their start, one that has become
    shorter than it was read is taken for a new one. ``suffix`` picks files by name; ``split_bytes`` cuts large ranges into
    tasks. Bytes that aren't UTF-8 become replacement characters.
    """

    @classmethod
    def name(cls) -> str:
        return "growing_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.suffix = options["path"], options.get("suffix", "")
        self.split = int(options.get("split_bytes", 64 << 20))
        self.from_end, self.drain = options.get("from", "start") == "end", options.get("drain", "false").lower() == "true"
        self.known: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {"files": self.latestOffset()["files"] if self.from_end else {}}

    def latestOffset(self) -> dict:
        found, folders = {}, [self.path]
        while folders:
            for uri, folder, size, _ in storage.entries(folders.pop()):
                if folder:
                    folders.append(uri)
                elif uri.endswith(self.suffix):
                    found[uri] = self._whole(uri, size)
        return {"files": dict(sorted(found.items()))}

    def _whole(self, uri: str, size: int) -> int:
        """The end of a file's last whole line."""
        if self.drain:
            return size
        was, end = self.known.get(uri, (0, 0))
        if size != was:
            end = storage.last_line_end(uri, end if size > was else 0, size)
            self.known[uri] = size, end
        return end

    def partitions(self, start: dict, end: dict) -> list[Range]:
        out = []
        for path, stop in end["files"].items():
            begin = start["files"].get(path, 0)
            begin = begin if begin <= stop else 0
            out += [Range(path, at, min(at + self.split, stop), stop, at == begin) for at in range(begin, stop, self.split)]
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, str]] = []
        for at, line in storage.lines(partition.path, partition.start, partition.end, partition.stop, partition.first):
            rows.append((at, line.decode(errors="replace")))
            if len(rows) == BATCH:
                yield self._batch(partition.path, rows)
                rows = []
        if rows:
            yield self._batch(partition.path, rows)

    @staticmethod
    def _batch(path: str, rows: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["path", "offset", "line"])


def growing_lines(spark: SparkSession, path: str, **options: str):
    """The stream of lines appended below ``path``."""
    spark.dataSource.register(GrowingLines)
    return spark.readStream.format("growing_lines").options(path=path, **options).load()
