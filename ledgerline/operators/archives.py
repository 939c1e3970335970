"""Directories of zip archives by ranged reads, damaged and oversized ones too, and the services that their entries belong to."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import services as S
from ..sources.ranges import Ranged, fetch

#: The format's marks, record sizes and the value that says "see the 64-bit record".
END, END64, LOCATOR64, ENTRY = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02"
END_BYTES, END64_BYTES, LOCATOR64_BYTES, ENTRY_BYTES = 22, 56, 20, 46
FULL16, FULL32, TAIL, LONG_TAIL, ENTRIES = 0xFFFF, 0xFFFFFFFF, 65_557, 8_000_000, 5_000_000


def _record64(b: bytes, clen: int) -> tuple[int, int, int] | None:
    """(entries, directory size, directory offset) of a 64-bit end record that lies inside the file."""
    if len(b) < END64_BYTES or b[:4] != END64:
        return None
    entries, size, offset = struct.unpack("<QQQ", b[32:56])
    return (entries, size, offset) if entries and size and offset + size <= clen else None


def directory(file: Ranged) -> tuple[int | None, int, int] | str:
    """(entries or None where unknown, directory size, its offset), or why there is none."""
    n = file.size
    if n < END_BYTES:
        return "zip-tiny"
    for length in (TAIL, LONG_TAIL):
        tail = file.span(n - length, n)
        at = tail.rfind(END)
        if at >= 0 or length >= n:
            break
    if at < 0 or at + END_BYTES > len(tail):
        return "zip-no-eocd"
    entries, size, offset = struct.unpack("<HII", tail[at + 10 : at + 20])
    if FULL16 != entries and FULL32 not in (size, offset):
        return entries, size, offset
    locator = tail[max(0, at - LOCATOR64_BYTES) : at]
    if len(locator) == LOCATOR64_BYTES and locator[:4] == LOCATOR64:
        begin = struct.unpack("<Q", locator[8:16])[0]
        if found := _record64(file.span(begin, begin + END64_BYTES), n):
            return found
    mark = tail.rfind(END64, 0, at)  # a locator that is gone or wrong: the record itself stands before the end
    while mark >= 0:
        if found := _record64(tail[mark : mark + END64_BYTES], n):
            return found
        mark = tail.rfind(END64, 0, mark)
    if FULL32 not in (size, offset) and size and offset + size <= n:  # only the count is saturated
        return None, size, offset
    return "zip-loc64-split" if len(locator) < LOCATOR64_BYTES else "zip-loc64-bad"


def entries_of(b: bytes) -> Iterator[tuple[str, int]]:
    """(name, size) of each entry of a directory's bytes, as far as they are whole."""
    at = 0
    while b[at : at + 4] == ENTRY and at + ENTRY_BYTES <= len(b):
        flags = struct.unpack_from("<H", b, at + 8)[0]
        size = struct.unpack_from("<I", b, at + 24)[0]
        name, extra, comment = struct.unpack_from("<HHH", b, at + 28)
        begin = at + ENTRY_BYTES
        if size == FULL32:
            size = _extra64(b[begin + name : begin + name + extra], size)
        raw = b[begin : begin + name]
        try:
            text = raw.decode("utf-8")
        except UnicodeDecodeError:
            text = raw.decode("utf-8" if flags & 0x800 else "cp437", errors="replace")
        yield text, size
        at = begin + name + extra + comment


def _extra64(extra: bytes, size: int) -> int:
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<HH", extra, at)
        if kind == 1 and length >= 8:
            return struct.unpack_from("<Q", extra, at + 4)[0]
        at += 4 + length
    return size


def measured(file: Ranged) -> tuple[int, str, list[tuple[str, int]]]:
    """(size, method, entries (name, size)) of an archive; one without a readable directory counts as stored."""
    found = directory(file)
    if isinstance(found, str):
        return file.size, found, []
    count, size, offset = found
    if not size:
        return 0, "zip:0entries", []
    out = []
    for e in entries_of(file.span(offset, offset + size)):
        if len(out) == min(ENTRIES, count if count is not None else ENTRIES):
            break
        out.append(e)
    whole = count is None or count == len(out)
    return sum(s for _, s in out), f"zip:{len(out)}entries" if whole else f"zip:partial{len(out)}/{count}", out


def members(files: DataFrame, reader: Callable[[str, int, int], bytes] = fetch) -> DataFrame:
    """(path, clen, uncomp, method, entry, size): a row an entry, or one without an entry. files: (path, clen), read by ranges, or (path, content)."""
    held = "content" in files.columns
    columns = ["path", "clen", "uncomp", "method", "entry", "size"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows: list[tuple] = []
            for row in df.itertuples(index=False):
                if held:
                    content = row.content
                    file = Ranged(lambda a, b, content=content: content[a : b + 1], len(content))
                else:
                    file = Ranged(lambda a, b, path=row.path: reader(path, a, b), row.clen)
                try:
                    size, method, entries = measured(file)
                except Exception as e:  # a broken file is a row of its own, not the end of the run
                    size, method, entries = file.size, f"err:{type(e).__name__}", []
                rows += [(row.path, file.size, size, method, n, s) for n, s in entries or [(None, 0)]]
                if len(rows) > 100_000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    return files.mapInPandas(run, "path string, clen long, uncomp long, method string, entry string, size long")


def attributed(rows: DataFrame, aliases: dict[str, str]) -> DataFrame:
    """(path, clen, uncomp, method, entries map<service, bytes>) of members(): each entry's bytes go to the service of its path."""
    sums = rows.withColumn("service", S.of_path(F.col("entry"), aliases)).groupBy("path", "clen", "uncomp", "method", "service").agg(F.sum("size").cast("long").alias("bytes"))
    pairs = F.collect_list(F.when(F.col("service").isNotNull(), F.struct("service", "bytes")))
    return sums.groupBy("path", "clen", "uncomp", "method").agg(F.map_from_entries(pairs).alias("entries"))
