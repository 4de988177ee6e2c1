"""The extension point for scrapers: a data source by name over landed pages, one partition a folder."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarrystone.schemas import SCRAPED_ITEM
from quarrystone.sources import storage


@dataclass
class Folder(InputPartition):
    """A folder of landed pages; its files are listed by the task that reads it."""

    uri: str


class Scraper(DataSource):
    """What a site's scraper extends: ``name()`` and ``items``, which turns a landed file into items.

    ``register`` makes it a format: ``spark.read.format(name).option("path", root).load()`` gives the fields of a scraped item and ``folder`` (below
    the root, empty for the root itself) and ``file``. Each folder is a partition. The options ``folders`` and ``files`` (JSON lists) choose partitions before
    anything is read, and files before they are opened; ``suffix`` picks files, .html unless given. Filters aren't pushed down: for Python sources the
    engine keeps those of a frame's last query, so a query without a filter on the same frame would lose rows.
    """

    def schema(self) -> str:
        return f"folder string, file string, {SCRAPED_ITEM}"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _Reader(self, schema.names)

    @classmethod
    def name(cls) -> str:
        return "landed_pages"

    def items(self, uri: str, raw: bytes) -> Iterator[dict[str, Any]]:
        """The items of one landed file, as fields of a scraped item. Here: one, with the page's title."""
        found = re.search(rb"<title[^>]*>(.*?)</title>", raw, re.S | re.I)
        yield {"title": found and re.sub(r"\s+", " ", found.group(1).decode(errors="replace")).strip(), "raw_html_path": uri}


class _Reader(DataSourceReader):
    def __init__(self, scraper: Scraper, columns: list[str]) -> None:
        self.scraper, self.columns = scraper, columns
        self.root, self.suffix = scraper.options["path"], scraper.options.get("suffix", ".html")
        self.wanted = {n: set(json.loads(scraper.options[f"{n}s"])) for n in ("folder", "file") if scraper.options.get(f"{n}s")}

    def _below(self, uri: str) -> str:
        _, base, ahead = storage.located(self.root)
        return uri.removeprefix((ahead + base).rstrip("/")).strip("/")

    def partitions(self) -> list[Folder]:
        _, base, ahead = storage.located(self.root)
        found, queue = [], [ahead + base]
        while queue:
            uri = queue.pop()
            found.append(uri)
            queue += [e[0] for e in storage.entries(uri) if e[1]]
        return [Folder(uri) for uri in sorted(found) if "folder" not in self.wanted or self._below(uri) in self.wanted["folder"]]

    def read(self, partition: Folder | None) -> Iterator[tuple]:
        if partition is None:  # no folder at all
            return
        for uri, is_folder, _, _ in sorted(storage.entries(partition.uri)):
            name = uri.rsplit("/", 1)[-1]
            if is_folder or not name.lower().endswith(self.suffix) or name not in self.wanted.get("file", {name}):
                continue
            for item in self.scraper.items(uri, b"".join(storage.chunks(uri))):
                known = {"folder": self._below(partition.uri), "file": name} | item
                yield tuple(known.get(c) for c in self.columns)


def register(spark: SparkSession, scraper: type[Scraper]) -> str:
    """Make a scraper a format of this session, and give its name."""
    spark.dataSource.register(scraper)
    return scraper.name()


def scraped(spark: SparkSession, scraper: type[Scraper], root: str, folders: list[str] | None = None, files: list[str] | None = None, **options: str) -> DataFrame:
    """Items of the landed pages below ``root``, of all folders and files or of those that are named."""
    chosen = {n: json.dumps(v) for n, v in (("folders", folders), ("files", files)) if v is not None}
    return spark.read.format(register(spark, scraper)).options(path=root, **chosen, **options).load()
