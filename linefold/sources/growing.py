"""Log files that still grow, as a stream.

Spark's file source takes a file once, so lines that a server appends later are never
read. Here the position of the stream is a byte offset in every file, cut at the end of a
line: a batch holds the whole lines that were appended since the last one, and an
unfinished last line waits. Long ranges are read by several tasks; one that begins inside a line leaves
it to the task before, as readers of split text files do.

A file that is shorter than its position was truncated or replaced: the stream fails, unless
``onTruncate`` is ``restart``, which reads it anew from its start. Files that are gone keep their place.
Bytes that are no UTF-8 become U+FFFD, and lines end in ``\\n``, ``\\r\\n`` or ``\\r``, as in Spark's text source.
Compressed files cannot grow and are refused.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from fnmatch import fnmatch

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from linefold.sources.landed import filesystem

#: Bytes of a task's range, of a read, and of a look for a line's end from the end of a file.
SPLIT, BLOCK, TAIL = 128 << 20, 4 << 20, 1 << 16
#: Rows of a batch handed to Spark.
ROWS = 20_000


def stream_growing(spark: SparkSession, path: str, *, pattern: str = "*", on_truncate: str = "fail", split_bytes: int = SPLIT) -> DataFrame:
    """Stream of the lines appended to the files of ``path`` whose names match ``pattern``: ``value STRING``."""
    if on_truncate not in ("fail", "restart"):
        raise ValueError("on_truncate must be 'fail' or 'restart'")
    spark.dataSource.register(GrowingFiles)
    options = {"pattern": pattern, "onTruncate": on_truncate, "splitBytes": str(split_bytes)}
    return spark.readStream.format("growing_files").options(**options).load(path)


class GrowingFiles(DataSource):
    """``spark.readStream.format("growing_files")``."""

    @classmethod
    def name(cls) -> str:
        return "growing_files"

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema) -> GrowingReader:  # noqa: N802 - Spark's name
        return GrowingReader(self.options)


class ByteRange(InputPartition):
    """Lines that begin in bytes ``first..until-1`` of a file; ``end`` is where the batch ends in it."""

    def __init__(self, root: str, file: str, first: int, until: int, end: int, begins_line: bool):
        super().__init__((file, first))
        self.root, self.file, self.first, self.until, self.end, self.begins_line = root, file, first, until, end, begins_line


class GrowingReader(DataSourceStreamReader):
    """Position ``{file: bytes}`` and byte ranges of the stream."""

    def __init__(self, options: Mapping[str, str]):
        self.root = options["path"].rstrip("/")
        self.pattern = options.get("pattern", "*")
        self.restart = options.get("onTruncate", "fail") == "restart"
        self.split = int(options.get("splitBytes", SPLIT))
        self.ends: dict[str, tuple[int, int]] = {}  # file: its size, and where its last whole line ended then

    def initialOffset(self) -> dict:  # noqa: N802
        return {}

    def latestOffset(self) -> dict:  # noqa: N802
        store, root = filesystem(self.root)
        for info in store.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            name = info.base_name
            if info.type != pafs.FileType.File or name.startswith((".", "_")) or not fnmatch(name, self.pattern):
                continue
            if re.search(r"\.(gz|bz2|zst|lz4|snappy|deflate)$", name):
                raise ValueError(f"{info.path} is compressed and cannot grow; read it as a file")
            if name not in self.ends or self.ends[name][0] != info.size:
                low = self.ends[name][1] if name in self.ends and self.ends[name][0] <= info.size else 0
                self.ends[name] = (info.size, last_line_end(store, info.path, low, info.size))
        return {name: end for name, (_, end) in sorted(self.ends.items())}

    def partitions(self, start: dict, end: dict) -> list[ByteRange]:
        ranges = []
        for name, upto in end.items():
            first = start.get(name, 0)
            if upto < first:
                if not self.restart:
                    raise ValueError(f"{self.root}/{name} is shorter than what was read of it ({upto} < {first}): truncated or replaced")
                first = 0
            for low in range(first, upto, self.split):
                ranges.append(ByteRange(self.root, name, low, min(low + self.split, upto), upto, low == first))
        return ranges

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        store, root = filesystem(partition.root)
        with store.open_input_file(f"{root}/{partition.file}") as f:
            lines: list[str] = []
            for line in whole_lines(f, partition):
                lines.append(line.decode("utf-8", "replace"))
                if len(lines) >= ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
                    lines = []
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


def last_line_end(store: pafs.FileSystem, path: str, low: int, size: int) -> int:
    """Behind the last ``\\n`` in bytes ``low..size-1`` of a file; ``low`` if there is none."""
    with store.open_input_file(path) as f:
        high = size
        while high > low:
            begin = max(low, high - TAIL)
            f.seek(begin)
            found = f.read(high - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            high = begin
    return low


def whole_lines(f, part: ByteRange) -> Iterator[bytes]:
    """The lines that begin in the range; the last one may end behind it, but not behind ``part.end``."""
    # one byte back: a range that begins right behind a line's end begins a line
    at = part.first if part.begins_line else part.first - 1
    f.seek(at)
    held, skip = b"", not part.begins_line
    while at < part.end:
        block = f.read(min(BLOCK, part.end - at))
        if not block:
            raise OSError(f"{part.file} ends at {at}, before {part.end}")
        at += len(block)
        held += block
        if skip:
            cut = held.find(b"\n")
            if cut < 0:
                held = b""
                continue
            held, skip = held[cut + 1 :], False
        # ranges end and batches end behind a \n, so only that divides tasks
        *done, held = held.split(b"\n")
        begin = at - len(held) - sum(len(x) + 1 for x in done)
        for line in done:
            if begin >= part.until:
                return
            begin += len(line) + 1
            yield from split_returns(line)
        if begin >= part.until:
            return


def split_returns(line: bytes) -> list[bytes]:
    """The lines in what lies between two ``\\n``: a ``\\r`` ends a line, one before the ``\\n`` belongs to it."""
    if b"\r" not in line:
        return [line]
    return (line[:-1] if line.endswith(b"\r") else line).split(b"\r")
