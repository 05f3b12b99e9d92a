"""Gzip files in blocks as a splittable source of records.

Block gzip is a row of small gzip members, each of which says in its header how long it is. A task gets a range of the file:
it looks for the first header in it, follows the members from there, and reads on into later ones for the end of its last
record. A record belongs to the range in which the separator before it begins, so each is read once, whatever the ranges.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes of a range.
RANGE_BYTES = 4 << 20
# What a member of block gzip begins with, and its end-of-file member's length.
MAGIC, EXTRA_ID = b"\x1f\x8b\x08\x04", b"BC"
#: Longest member, and header with the extra fields that writers use.
MOST_MEMBER, HEADER = 1 << 16, 18


def _opened(path: str):
    """The file's store and its path there, of local paths and of addresses that the Arrow library knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def member_size(head: bytes) -> int:
    """The length of the member that begins with ``head``; 0 if none does."""
    if len(head) < HEADER or not head.startswith(MAGIC):
        return 0
    extra, at = struct.unpack_from("<H", head, 10)[0], 12
    end = min(len(head), at + extra)
    while at + 4 <= end:
        size = struct.unpack_from("<H", head, at + 2)[0]
        if head[at : at + 2] == EXTRA_ID and size == 2 and at + 6 <= end:
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return 0


def is_block_gzip(path: str) -> bool:
    """Whether a file begins with a member of block gzip."""
    store, where = _opened(path)
    with store.open_input_file(where) as file:
        return member_size(file.read(HEADER + 64)) > 0


def are_block_gzip(paths: list[str]) -> bool:
    """Whether all paths are files of block gzip, in stores that the Arrow library reads."""
    try:
        return bool(paths) and all(map(is_block_gzip, paths))
    except (OSError, ValueError):
        return False


def _first_member(file, start: int, size: int) -> int | None:
    """Where the first member at or behind ``start`` begins: one that the next member or the file's end follows."""
    data = file.read_at(min(size - start, 2 * MOST_MEMBER + HEADER), start)
    at = data.find(MAGIC)
    while at >= 0:
        n = member_size(data[at : at + HEADER + 64])
        if n and (start + at + n == size or member_size(data[at + n : at + n + HEADER + 64])):
            return start + at
        at = data.find(MAGIC, at + 1)
    return None


def members(file, start: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, content) of the members from the first one at or behind ``start`` on."""
    at = _first_member(file, start, size) if start else 0
    while at is not None and at < size:
        head = file.read_at(min(HEADER + 64, size - at), at)
        n = member_size(head)
        if not n:
            raise ValueError(f"no member of block gzip at {at}")
        yield at, zlib.decompress(file.read_at(n, at), wbits=31)
        at += n


def records(file, start: int, end: int, size: int, separator: bytes) -> list[bytes]:
    """The records of a range, without separators; of lines, without a carriage return too."""
    own, more, whole = [], b"", True
    for at, content in members(file, start, size):
        if at < end:
            own.append(content)
            continue
        if not own:
            return []
        if not more:
            own = [b"".join(own)]
        more += content
        place = (own[0] + more).find(separator, len(own[0]))
        if place >= 0:
            more, whole = more[: place - len(own[0])], False
            break
    if not own:
        return []
    made = (b"".join(own) + more).split(separator)
    if start:
        del made[0]
    if whole and made and not made[-1]:  # the file ends with a separator
        del made[-1]
    return [r.removesuffix(b"\r") for r in made] if separator == b"\n" else made


@dataclass
class Range(InputPartition):
    path: str
    start: int
    end: int
    size: int


class BlockGzipReader(DataSourceReader):
    def __init__(self, options: dict):
        options = {name.lower(): value for name, value in options.items()}  # Spark doesn't tell their case
        self.paths = options["path"].split("\n")
        self.separator = options.get("linesep", "\n").encode()
        self.range = int(options.get("rangebytes", RANGE_BYTES))

    def partitions(self) -> list[Range]:
        made = []
        for path in self.paths:
            store, where = _opened(path)
            size = store.get_file_info(where).size
            made += [Range(path, at, min(size, at + self.range), size) for at in range(0, size, self.range)]
        return made

    def read(self, partition: Range) -> Iterator[tuple]:
        store, where = _opened(partition.path)
        with store.open_input_file(where) as file:
            for i, record in enumerate(records(file, partition.start, partition.end, partition.size, self.separator)):
                yield record.decode("utf-8", "replace"), partition.path, partition.start, i


class BlockGzip(DataSource):
    """Records of block gzip files with their file, the range's begin and their number in it."""

    @classmethod
    def name(cls) -> str:
        return "block_gzip"

    def schema(self) -> str:
        return "value string, path string, block bigint, seq bigint"

    def reader(self, schema) -> BlockGzipReader:
        return BlockGzipReader(dict(self.options))


def read_records(spark: SparkSession, paths: list[str], separator: str = "\n", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(value, path, block, seq) of all records of block gzip files."""
    spark.dataSource.register(BlockGzip)
    return spark.read.format("block_gzip").option("path", "\n".join(paths)).option("lineSep", separator).option("rangeBytes", range_bytes).load()
