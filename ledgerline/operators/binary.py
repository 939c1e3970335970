"""Logical sizes of archives from their trailers, footers and directories, or exactly by reading them through.

Input is rows (path, length, content) as Spark's binaryFile source gives them,
so files spread over the executors; nothing but measures comes back. Every file
gives a row: what fails is kept at its stored size as err:<type>.
"""

from __future__ import annotations

import bz2
import io
import lzma
import struct
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

#: How far DEFLATE can shrink, and bytes read at a time.
DEFLATE_MOST, STEP = 1032, 1 << 20
SCHEMA = "path string, clen long, uncomp long, kind string, method string"
_ENDS = {".zip": "zip", ".tgz": "gz", ".gz": "gz", ".tbz2": "bz2", ".bz2": "bz2", ".txz": "xz", ".xz": "xz", ".parquet": "parquet"}


def kind_of(path: str) -> str:
    return next((k for e, k in _ENDS.items() if path.lower().endswith(e)), "stored")


def gzip_trailer(data: bytes) -> tuple[int, str]:
    """The last four bytes hold the size modulo 2**32; implausible ones are floored at the stored size."""
    n = len(data)
    if n < 4:
        return n, "gz-tiny"
    size = struct.unpack("<I", data[-4:])[0]
    if size > n * DEFLATE_MOST:
        return n, "gz-bad-trailer"
    return (n, "gz-floor") if size < n else (size, "gz-trailer")


def through(data: bytes, kind: str) -> tuple[int, str]:
    """The exact size over all members, a bounded buffer at a time; a cut-off stream counts what it held."""
    make = {"gz": lambda: zlib.decompressobj(31), "bz2": bz2.BZ2Decompressor, "xz": lzma.LZMADecompressor}[kind]
    total, at, rest = 0, 0, b""
    d = make()
    fresh = True
    while True:
        if not rest:
            rest = data[at : at + STEP]
            at += len(rest)
        if not rest:
            return total, f"{kind}-exact" if fresh or d.eof else f"{kind}-truncated"
        if kind == "gz":
            out = d.decompress(rest, STEP)
            total, fresh, rest = total + len(out), False, d.unconsumed_tail
        else:
            out = d.decompress(rest, STEP)
            total, fresh, rest = total + len(out), False, b""
            while not d.eof and not d.needs_input:
                total += len(d.decompress(b"", STEP))
        if d.eof:
            rest = d.unused_data.lstrip(b"\0") if kind == "xz" else d.unused_data
            d, fresh = make(), True
            if rest and kind == "gz" and rest[:2] != b"\x1f\x8b"[: len(rest[:2])]:
                return total, "gz-exact"


def zip_directory(data: bytes) -> tuple[int, str]:
    n = len(data)
    if n < 22:
        return n, "zip-tiny"
    if b"PK\x05\x06" not in data[-65_557:]:
        return n, "zip-no-eocd"
    entries = zipfile.ZipFile(io.BytesIO(data)).infolist()
    return sum(e.file_size for e in entries), f"zip:{len(entries)}entries"


def zip_through(data: bytes) -> tuple[int, str]:
    """Every entry read through; entries that can't be are trusted to their directory."""
    size, method = zip_directory(data)
    if not method.startswith("zip:") or method == "zip:0entries":
        return size, method
    archive = zipfile.ZipFile(io.BytesIO(data))
    total = trusted = 0
    entries = archive.infolist()
    for e in entries:
        try:
            with archive.open(e) as f:
                total += sum(len(x) for x in iter(lambda f=f: f.read(STEP), b""))
        except (RuntimeError, NotImplementedError, zipfile.BadZipFile, zlib.error, OSError):
            total, trusted = total + e.file_size, trusted + 1
    if trusted:
        return total, f"zip-partial({len(entries) - trusted}/{len(entries)}cd)"
    return total, "zip-exact" if total == size else f"zip-exact-mismatch(cd={size})"


def parquet_footer(data: bytes) -> tuple[int, str]:
    n = len(data)
    if n < 12:
        return n, "parquet-tiny"
    if data[-4:] == b"PARE":
        return n, "parquet-encrypted"
    if data[-4:] != b"PAR1":
        return n, "parquet-bad-magic"
    import pyarrow.parquet as pq

    m = pq.ParquetFile(io.BytesIO(data)).metadata
    total = sum(m.row_group(g).column(c).total_uncompressed_size for g in range(m.num_row_groups) for c in range(m.num_columns))
    return max(total, 0), "parquet-footer"


def measure(path: str, data: bytes, deep: bool = False) -> tuple[int, str, str]:
    kind = kind_of(path)
    try:
        if kind == "stored":
            return len(data), kind, "stored"
        if kind == "zip":
            size, method = (zip_through if deep else zip_directory)(data)
            return size, kind, method
        if kind == "parquet":
            size, method = parquet_footer(data)
        elif kind == "gz":
            size, method = gzip_trailer(data)
            if deep and len(data) >= 4 or method in ("gz-floor", "gz-bad-trailer"):
                size, method = through(data, "gz") if data[:2] == b"\x1f\x8b" else (size, method)
        elif deep:
            size, method = through(data, kind)
        else:
            size, method = len(data), f"{kind}-stored"
        return size, kind, method
    except Exception as e:  # a broken file is a row of its own, not the end of the run
        return len(data), kind, f"err:{type(e).__name__}"


def sized(files: DataFrame, deep: bool = False) -> DataFrame:
    """(path, clen, uncomp, kind, method) of files (path, content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            rows = []
            for path, data in zip(df["path"], df["content"], strict=True):
                size, kind, method = measure(path, data, deep)
                rows.append((path, len(data), size, kind, method))
            yield pd.DataFrame(rows, columns=["path", "clen", "uncomp", "kind", "method"])

    return files.select("path", "content").mapInPandas(run, SCHEMA)


def zip_entries(files: DataFrame) -> DataFrame:
    """A row per archive entry; names that older tools wrote in code page 437 are read as UTF-8 where they are that."""

    def name_of(e: zipfile.ZipInfo) -> str:
        if e.flag_bits & 0x800:
            return e.filename
        try:
            return e.filename.encode("cp437").decode("utf-8")
        except (UnicodeEncodeError, UnicodeDecodeError):
            return e.filename

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            for path, data in zip(df["path"], df["content"], strict=True):
                try:
                    entries = zipfile.ZipFile(io.BytesIO(data)).infolist()
                except zipfile.BadZipFile:
                    continue
                yield pd.DataFrame({"path": path, "entry": [name_of(e) for e in entries], "size": [e.file_size for e in entries]})

    return files.select("path", "content").mapInPandas(run, "path string, entry string, size long")
