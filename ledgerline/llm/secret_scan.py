"""Secrets: keyword automaton, anchored patterns near its hits, checksums.

One Aho-Corasick pass over a batch's bytes finds keywords; only there are the
anchored patterns tried, in text order, so that matches are the leftmost
non-overlapping ones. Runs of hexadecimal digits, which have no keyword, come
from whole-buffer bit passes. Kinds with an embedded checksum are kept only if
it holds: 36-character access tokens end in the base-62 CRC-32 of what stands
before, and a JSON web token's header must decode to JSON with an algorithm.

Each place of a text is looked at a bounded number of times: a keyword inside a
match or inside a run that failed as a web token is passed over.

Spans are code points, end exclusive. Defined cases: null text is an empty text
without secrets; repeated rows give repeated results; equal starts sort by the
kinds' order; an empty table gives an empty table; further columns pass through
redacted().
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words as W
from .common import over_batches, table

#: Kinds in their order.
KINDS = ("assign", "access", "hex", "host_token", "package_token", "web_token")
MASK = "[secret]"
_ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HOST = re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_PACKAGE = re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
_WEB = re.compile(rb"(eyJ[A-Za-z0-9_-]{8,}+)\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")
_WEB_RUN = re.compile(rb"[A-Za-z0-9_-]*+")
#: Keyword (lower case) -> kind and pattern.
_KEYWORDS = {
    **{k: ("assign", _ASSIGN) for k in ("password", "passwd", "secret", "token", "api_key", "apikey")},
    "akia": ("access", _ACCESS),
    **{f"gh{c}_": ("host_token", _HOST) for c in "pousr"},
    "npm_": ("package_token", _PACKAGE),
    "eyj": ("web_token", _WEB),
}
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_HEX_LEAST = 24
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
_automaton: list = []


def base62(n: int, width: int = 6) -> str:
    out = ""
    for _ in range(width):
        n, r = divmod(n, 62)
        out = _DIGITS[r] + out
    return out


def _good(kind: str, m: re.Match) -> bool:
    if kind == "assign":
        return len(m[1]) >= 6
    if kind == "access":
        return len(m[0]) >= 20
    if kind == "web_token":
        try:
            head = json.loads(base64.urlsafe_b64decode(m[1] + b"=" * (-len(m[1]) % 4)))
        except (ValueError, binascii.Error, RecursionError):  # no base64, no JSON, or JSON nested beyond any header
            return False
        return isinstance(head, dict) and "alg" in head
    return base62(zlib.crc32(m[1])).encode() == m[2]


def _keywords() -> ahocorasick.Automaton:
    if not _automaton:
        a = ahocorasick.Automaton()
        for k in _KEYWORDS:
            a.add_word(k, k)
        a.make_automaton()
        _automaton.append(a)
    return _automaton[0]


def _hex_runs(b: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Maximal runs of at least 24 hexadecimal digits inside one document."""
    for i, j in W.pieces(offsets, 8 << 20):
        lo = int(offsets[i])
        m = _HEX[b[lo : int(offsets[j])]]
        if len(m) < _HEX_LEAST:
            continue
        m2 = m[:-1] & m[1:]
        m4 = m2[:-2] & m2[2:]
        m8 = m4[:-4] & m4[4:]
        m16 = m8[:-8] & m8[8:]
        at = np.flatnonzero(m16[: len(m16) - 8] & m8[16:]) + lo
        if not len(at):
            continue
        doc = np.searchsorted(offsets, at, side="right")
        inside = at + _HEX_LEAST <= offsets[doc]
        at, doc = at[inside], doc[inside]
        cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(doc) != 0)) + 1
        for group in np.split(at, cut):
            if len(group):
                yield int(group[0]), int(group[-1]) + _HEX_LEAST


def spans(column: pa.Array) -> list[list[tuple[str, int, int]]]:
    """For each text its secrets (kind, start, end), by start and kind."""
    b, offsets = W.buffers(column)
    n = len(offsets) - 1
    found: list[list[tuple[str, int, int]]] = [[] for _ in range(n)]
    ends: dict[tuple[int, str], int] = {}
    body = b.tobytes()
    places = offsets.tolist()
    # no keyword holds another of its kind, so hits of a kind come in the order of their starts
    for last, keyword in _keywords().iter(body.lower().decode("latin-1")):
        start = last - len(keyword) + 1
        kind, pattern = _KEYWORDS[keyword]
        doc = int(np.searchsorted(offsets, start, side="right")) - 1
        if start < ends.get((doc, kind), 0):
            continue
        m = pattern.match(body, start, places[doc + 1])
        good = m and _good(kind, m)
        if good:
            found[doc].append((kind, start, m.end()))
        if kind == "web_token" and not good:  # no later start in this run can do better, as what must follow the run is the same
            ends[doc, kind] = _WEB_RUN.match(body, start, places[doc + 1]).end()
        elif m:
            ends[doc, kind] = m.end()
    for start, end in _hex_runs(b, offsets):
        found[int(np.searchsorted(offsets, start, side="right")) - 1].append(("hex", start, end))
    out = []
    for doc, some in enumerate(found):
        if some:
            lo = places[doc]
            text = b[lo : places[doc + 1]]
            at = np.zeros(len(text) + 1, np.int64)
            np.cumsum(W.code_points(text), out=at[1:])
            some = sorted(((k, int(at[s - lo]), int(at[e - lo])) for k, s, e in some), key=lambda x: (x[1], KINDS.index(x[0])))
        out.append(some)
    return out


def _listed(some: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in some)


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, secrets array<struct<kind, start, end>>) of each document."""
    kind = docs.schema[key].dataType.simpleString()
    item = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [[{"kind": k, "start": s, "end": e} for k, s, e in some] for some in spans(batch.column(1))]
        return pa.record_batch({key: batch.column(0), "secrets": pa.array(rows, item)})

    return over_batches(docs.select(key, text), scan, f"`{key}` {kind}, secrets array<struct<kind:string,start:long,end:long>>")


def redact(text: str, some: list[tuple[str, int, int]]) -> str:
    """The text with each stretch of touching or overlapping spans replaced by one mask."""
    out, last = [], 0
    stretch: list[int] = []
    for _, s, e in [*some, ("", len(text) + 1, len(text) + 1)]:
        if stretch and s > stretch[1]:
            out += [text[last : stretch[0]], MASK]
            last, stretch = stretch[1], []
        stretch = [s, e] if not stretch else [stretch[0], max(stretch[1], e)]
    return "".join([*out, text[last:]])


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their secrets masked."""
    at = docs.columns.index(text)

    def mask(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = batch.column(at)
        found = {k: some for k, some in enumerate(spans(column)) if some}
        if not found:
            return batch
        values = [redact(v.as_py(), found[k]) if k in found else v.as_py() for k, v in enumerate(column)]
        return pa.RecordBatch.from_arrays([pa.array(values, c.type) if k == at else c for k, c in enumerate(batch.columns)], schema=batch.schema)

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    return over_batches(docs, mask, schema)


def op5_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digests of the secrets in each document."""
    found = scanned(table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda x: x["kind"].isin("assign", "access", "hex"))

    def listed(x: F.Column) -> F.Column:
        return F.array_join(F.transform(x, lambda y: F.concat_ws(":", y["kind"], y["start"].cast("string"), y["end"].cast("string"))), ",")

    def count(k: str) -> F.Column:
        return F.size(F.filter("secrets", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")

    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


def digest(some: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(_listed(some).encode()).hexdigest()
