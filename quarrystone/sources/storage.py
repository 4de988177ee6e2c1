"""Files by URI from inside tasks, whatever their size: open, list one folder, find line ends."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

from pyarrow import fs

BLOCK = 1 << 16


def located(uri: str) -> tuple[fs.FileSystem, str, str]:
    """The file system of a URI (or of a local path), its path there, and what stands ahead of paths to make URIs of them."""
    local = re.sub("^file:(//)?(?=/)", "", uri)
    if "://" not in local:
        return fs.LocalFileSystem(), os.path.abspath(local), "file:"
    system, path = fs.FileSystem.from_uri(uri.rstrip("/"))
    return system, path, uri.rstrip("/").removesuffix(path)


def entries(uri: str) -> Iterator[tuple[str, bool, int, int]]:
    """(uri, is a folder, bytes, modified in nanoseconds) of what lies in one folder. Linked folders aren't followed; one that is gone has nothing."""
    system, path, ahead = located(uri)
    if isinstance(system, fs.LocalFileSystem):
        try:
            for e in os.scandir(path):
                if e.is_dir(follow_symlinks=False):
                    yield ahead + e.path, True, 0, 0
                elif e.is_file():
                    yield ahead + e.path, False, (s := e.stat()).st_size, s.st_mtime_ns
        except FileNotFoundError:
            return
    else:
        for e in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
            yield ahead + e.path, e.type == fs.FileType.Directory, e.size or 0, e.mtime_ns or 0


def chunks(uri: str, size: int = 1 << 22) -> Iterator[bytes]:
    """A file's bytes, so many at a time."""
    system, path, _ = located(uri)
    with system.open_input_stream(path) as stream:
        while block := stream.read(size):
            yield block


def last_line_end(uri: str, start: int, end: int) -> int:
    """Where the last whole line of the bytes from ``start`` to ``end`` ends; ``start`` if none does. Read from the end, block by block."""
    system, path, _ = located(uri)
    with system.open_input_file(path) as f:
        while end > start:
            begin = max(start, end - BLOCK)
            f.seek(begin)
            at = f.read(end - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return start


def lines(uri: str, start: int, end: int, stop: int, first: bool) -> Iterator[tuple[int, bytes]]:
    """(offset, line) of the lines that start in [start, end); the last is read to its end or to ``stop``.

    Where ``start`` isn't the ``first`` byte of a line for sure, the line that runs over it belongs to the range before.
    """
    system, path, _ = located(uri)
    with system.open_input_file(path) as f:
        at = start if first else start - 1
        f.seek(at)
        rest = b""
        skipping = not first
        while at < end or rest or skipping:
            block = f.read(min(BLOCK, max(0, stop - at - len(rest))))
            if not block and not rest:
                return
            buffer = rest + block
            *whole, rest = buffer.split(b"\n")
            if not block:
                whole, rest = [rest], b""
            for line in whole:
                if skipping:
                    skipping = False
                elif at < end:
                    yield at, line.removesuffix(b"\r")
                at += len(line) + 1
                if at >= end:
                    return
