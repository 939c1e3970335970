"""Ranged and chunked reads: what an archive's size needs is its last bytes, so whole objects aren't loaded.

Files are listed by Spark's binaryFile source without its content column, which
reads no bytes of them; executors then open each path themselves and seek.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK, TAIL = 1 << 20, 65_557


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, clen) of the files under a path."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.col("length").alias("clen"))


def opened(path: str):
    """A seekable file of a local path or of any URI that Arrow's file systems know."""
    if "://" not in path and not path.startswith("file:"):
        return open(path, "rb")
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
    return system.open_input_file(inner)


def fetch(path: str, start: int, end: int) -> bytes:
    """The bytes [start, end], both included."""
    with opened(path) as f:
        f.seek(start)
        return f.read(end - start + 1)


def chunks(path: str, size: int = CHUNK) -> Iterator[bytes]:
    """All bytes, one chunk in memory at a time."""
    with opened(path) as f:
        while part := f.read(size):
            yield part


class Ranged(io.RawIOBase):
    """A read-only file over ranged reads, whose end is fetched once and kept: an archive's directory takes two reads."""

    def __init__(self, read, size: int, tail: int = TAIL):
        self._read, self.size, self._at, self.reads = read, size, 0, 0
        self._from = max(0, size - tail)
        self._tail: bytes | None = None

    @classmethod
    def of(cls, path: str, size: int) -> Ranged:
        return cls(lambda a, b: fetch(path, a, b), size)

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self._at = max(0, offset + (0, self._at, self.size)[whence])
        return self._at

    def span(self, start: int, end: int) -> bytes:
        """The bytes [start, end)."""
        start, end = max(0, start), min(end, self.size)
        if start >= end:
            return b""
        if start >= self._from:
            if self._tail is None:
                self._tail = self._read(self._from, self.size - 1)
                self.reads += 1
            return self._tail[start - self._from : end - self._from]
        self.reads += 1
        return self._read(start, end - 1)

    def readinto(self, into) -> int:
        got = self.span(self._at, self._at + len(into))
        into[: len(got)] = got
        self._at += len(got)
        return len(got)
