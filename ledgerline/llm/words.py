"""Vectorised words, lines and tokens of Arrow text columns.

All operators of this subpackage read text through this module. A batch's
text is one byte buffer with document offsets; words, their hashes and their
places come from whole-buffer numpy passes, so no Python runs per word.

A word is a run of bytes other than ASCII white space (0x20, 0x09-0x0D).
Null text is an empty text. Hashes are 64-bit, keyed by position-free
polynomials over random byte values, and equal in every process.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK = 2 << 20  # bytes looked at in one pass; bounds the temporary arrays

_rng = np.random.default_rng(20240501)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_K = U64(0x9E3779B97F4A7C15)
_K_INV = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        out = np.full(max(n, CHUNK + 4096), base, U64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        _powers[name] = have = out
    return have[:n]


def prefix_hash(b: np.ndarray, fold: bool = False) -> np.ndarray:
    """Prefix sums from which span_hash takes any span's hash."""
    table = _BYTE[FOLD] if fold else _BYTE
    out = np.empty(len(b) + 1, U64)
    out[0] = 0
    np.cumsum(table[b] * _power("k", _K, len(b)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    inverse = _power("inv", _K_INV, len(prefix))
    return mix((prefix[ends] - prefix[starts]) * inverse[starts] + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and its n + 1 offsets; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    _, at, data = column.buffers()
    n = len(column)
    if n == 0 or at is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(at, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = CHUNK) -> list[tuple[int, int]]:
    """Runs of whole documents [i, j) of at most `limit` bytes, or of one document."""
    out, i, n = [], 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = max(i + 1, min(j, n))
        out.append((i, j))
        i = j
    return out


def _cuts(b: np.ndarray, lo: int, hi: int, separator: np.ndarray) -> list[tuple[int, int]]:
    """Parts of a very long text, cut behind separators."""
    out = []
    while lo < hi:
        end = min(hi, lo + CHUNK)
        while end < hi and not separator[b[end - 1]]:
            more = np.flatnonzero(separator[b[end : end + CHUNK]])
            end = end + int(more[0]) + 1 if len(more) else min(hi, end + CHUNK)
        out.append((lo, end))
        lo = end
    return out


def _spans(mask: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of True that don't cross any of the `firsts` positions."""
    n = len(mask)
    begin = mask.copy()
    begin[1:] &= ~mask[:-1]
    firsts = firsts[firsts < n]
    begin[firsts] = mask[firsts]
    end = mask.copy()
    end[:-1] &= ~mask[1:]
    before = firsts[firsts > 0] - 1
    end[before] = mask[before]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


@dataclass
class Words:
    """Words of documents [0, n): hashes and byte spans, with each document's first word in `first`."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(b: np.ndarray, offsets: np.ndarray, fold: bool = False) -> Words:
    """The words of the documents at `offsets` of the bytes b. fold: A-Z count as a-z."""
    hashes, starts, ends = [], [], []
    for i, j in pieces(offsets):
        parts = [(int(offsets[i]), int(offsets[j]))] if offsets[j] - offsets[i] <= 2 * CHUNK else _cuts(b, int(offsets[i]), int(offsets[j]), SPACE)
        for lo, hi in parts:
            if hi <= lo:
                continue
            part = b[lo:hi]
            firsts = offsets[i:j] - lo
            s, e = _spans(~SPACE[part], firsts[firsts >= 0])
            hashes.append(span_hash(prefix_hash(part, fold), s, e))
            starts.append(s + lo)
            ends.append(e + lo)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(
        np.concatenate(hashes) if hashes else np.zeros(0, U64),
        start,
        np.concatenate(ends) if ends else np.zeros(0, np.int64),
        np.searchsorted(start, offsets),
    )


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of `size` words that lie in one document, and the index of each one's first word."""
    n = len(w.hash) - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    doc = w.doc
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    h = np.zeros(n, U64)
    for k in range(size):
        h = h * U64(0xC2B2AE3D27D4EB4F) + w.hash[k : k + n]
    return mix(h[at]), at


def per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of flags between offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def code_points(b: np.ndarray) -> np.ndarray:
    """True at the first byte of each UTF-8 code point."""
    return (b & 0xC0) != 0x80
