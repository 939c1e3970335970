"""n-grams of whole corpora: packed texts, and totals of counts that blocks and shards exchange.

Texts are dealt in compressed chunks to blocks of bounded size. A block sends
its distinct n-grams, as sorted, packed hashes with counts, to shards of the
hash range; a shard adds the counts up and replies with totals in the order
asked. A block sends at most 2**FAN_BITS frames. Where more shards are needed,
frames of about as many blocks are first merged in cells, which ask the finer
shards as if they were blocks; so a frame never shrinks to a few keys, however
many blocks and shards there are, and a frequent n-gram is one row a cell.

Hashes of single words have 64 bits. Those of longer n-grams have 18 bits more
than the count of bytes in the corpus has, up to 64; so about one n-gram in a
million shares its hash with another.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import arrow_limits

CHUNK_BYTES, BLOCK_BYTES, SHARD_KEYS, FAN_BITS = 1 << 20, 12 << 20, 1_500_000, 10
U = W.U64
START, END = U(0x5353_0000_AAAA_0001), U(0xE1E1_0000_BBBB_0001)
_STEP = U(0xC2B2AE3D27D4EB4F)
FRAME = "keys array<binary>, counts array<binary>"


def pack(values: np.ndarray) -> bytes:
    """Bytes of whole numbers, plane by plane, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T).tobytes()) if len(values) else b""


def unpack(data: bytes, kind: type) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def token_stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end behind each, and the n + 1 places where texts begin."""
    w = W.words(*W.buffers(column), fold=True)
    n = len(w.first) - 1
    first = w.first + np.arange(n + 1)
    out = np.empty(len(w.hash) + n, U)
    out[np.arange(len(w.hash)) + w.doc] = w.hash
    out[first[1:] - 1] = END
    return out, first


def grams(tokens: np.ndarray, first: np.ndarray, order: int, width: int) -> list[np.ndarray]:
    """For n = 1..order the hash of the n tokens that end at each place; starts stand before each text."""
    place = np.arange(len(tokens)) - np.repeat(first[:-1], np.diff(first))
    out, value = [], np.zeros(len(tokens), U)
    for k in range(order):
        t = np.full(len(tokens), START)
        inside = np.flatnonzero(place >= k)
        t[inside] = tokens[inside - k]
        value = W.mix(value * _STEP + t + U(k + 1))
        out.append(value if k == 0 else value >> U(64 - width))
    return out


def counted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sum of their weights."""
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    at = np.flatnonzero(new)
    return keys[at], np.add.reduceat(weights[order].astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


class Layout:
    """How a corpus of `size` bytes is dealt: blocks, shards (2**bits) and the widths of the hashes of each order."""

    def __init__(self, size: int, orders: range, keys_per_byte: float):
        self.blocks = max(1, -(-size // BLOCK_BYTES))
        self.bits = max(0, int(np.ceil(np.log2(max(1, size * keys_per_byte / SHARD_KEYS)))))
        self.width = min(64, 18 + max(1, int(size)).bit_length())
        self.widths = [64 if n == 1 else self.width for n in orders]
        self.fan = FAN_BITS


def dealt(docs: DataFrame, blocks: int) -> DataFrame:
    """(block, chunk): the rows of docs in compressed chunks. The place of a row decides its block, so repeated rows and null keys spread."""
    spark = docs.sparkSession
    arrow_limits(spark)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordinal = 0
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            if not batch.num_rows:
                continue
            partition = batch.column(0)[0].as_py()
            rows = batch.select(range(1, batch.num_columns))
            _, offsets = W.buffers(rows.column(1))
            blobs = []
            for i, j in W.pieces(offsets, CHUNK_BYTES):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                    writer.write_batch(rows.slice(i, j - i))
                blobs.append(sink.getvalue().to_pybytes())
            at = W.mix(np.arange(ordinal, ordinal + len(blobs), dtype=U) + U(partition * int(_STEP) & (2**64 - 1))) % U(blocks)
            ordinal += len(blobs)
            yield pa.record_batch({"block": pa.array(at.astype(np.int64)), "chunk": pa.array(blobs, pa.binary())})

    return docs.select(F.spark_partition_id().alias("__partition"), *docs.columns).mapInArrow(chunks, "block long, chunk binary")


def opened(table: pa.Table) -> pa.Table:
    """The rows of a block's chunks."""
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in table.column("chunk").to_pylist()])


def frames(keys: list[np.ndarray], counts: list[np.ndarray], widths: list[int], base: int, prefix: int, more: int) -> Iterator[tuple[int, list[bytes], list[bytes]]]:
    """The parts of sorted keys for the 2**more shards under the shard `base` of `prefix` bits."""
    ids = np.arange((base << more), (base + 1 << more) + 1, dtype=U)
    bounds = [np.searchsorted(k >> U(w - prefix - more), ids) if prefix + more else np.array([0, len(k)]) for k, w in zip(keys, widths, strict=True)]
    for s in np.flatnonzero(sum(np.diff(b) for b in bounds)).tolist():
        parts = [slice(b[s], b[s + 1]) for b in bounds]
        yield (base << more) + s, [pack(np.diff(k[p], prepend=U(0))) for k, p in zip(keys, parts, strict=True)], [pack(c[p]) for c, p in zip(counts, parts, strict=True)]


def framed(block: int, rows: list[tuple[int, list[bytes], list[bytes]]]) -> pa.Table:
    kind = pa.list_(pa.binary())
    return pa.table({"block": pa.array([block] * len(rows), pa.int64()), "shard": pa.array([r[0] for r in rows], pa.int64()), "keys": pa.array([r[1] for r in rows], kind), "counts": pa.array([r[2] for r in rows], kind)})


def _merged(t: pa.Table, orders: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each order the distinct keys of all frames, their summed counts, each frame's places among them, and the frames' ends."""
    sent, counts = t.column("keys").to_pylist(), t.column("counts").to_pylist()
    out = []
    for n in range(orders):
        keys = [np.cumsum(unpack(x[n], U), dtype=U) for x in sent]
        all_, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(inverse, weights=np.concatenate([unpack(x[n], np.int64) for x in counts]), minlength=len(all_)).astype(np.int64)
        out.append((all_, sums, inverse, np.cumsum([0] + [len(k) for k in keys])))
    return out


#: What shards reply: for each value its order's index and its type.
Values = list[tuple[int, type]]
REPLY = "block long, shard long, totals array<binary>"


def _replies(t: pa.Table, values: list[np.ndarray], spec: Values, merged: list[tuple]) -> pa.Table:
    """To each frame the values of its keys, in its order."""
    rows = []
    for k in range(t.num_rows):
        places = [inverse[ends[k] : ends[k + 1]] for _, _, inverse, ends in merged]
        rows.append([pack(v[places[n]]) for v, (n, _) in zip(values, spec, strict=True)])
    return pa.table({"block": t.column("block"), "shard": t.column("shard"), "totals": pa.array(rows, pa.list_(pa.binary()))})


def summed(orders: int) -> tuple[Callable[[DataFrame], DataFrame], Values]:
    """Shards that reply with the sums of the counts that they got."""
    spec: Values = [(n, np.int64) for n in range(orders)]

    def total(t: pa.Table) -> pa.Table:
        merged = _merged(t, orders)
        return _replies(t, [m[1] for m in merged], spec, merged)

    return lambda asked: asked.groupBy("shard").applyInArrow(total, REPLY), spec


def looked_up(entries: DataFrame, fields: dict[int, tuple[int, int]]) -> tuple[Callable[[DataFrame], DataFrame], Values]:
    """Shards that reply with whole numbers of a table of entries (shard, field, keys, columns), whose keys and columns are packed, the
    keys' steps being sorted; 0 where it has no entry. fields: by a field's first reply, its order's index and how many columns it has."""
    spec: Values = [(n, np.int64) for n, k in fields.values() for _ in range(k)]
    orders = 1 + max(n for n, _ in fields.values())

    def look(t: pa.Table, known: pa.Table) -> pa.Table:
        if not t.num_rows:  # nobody asks this shard
            return pa.table({"block": pa.array([], pa.int64()), "shard": pa.array([], pa.int64()), "totals": pa.array([], pa.list_(pa.binary()))})
        merged = _merged(t, orders)
        values = [np.zeros(len(merged[n][0]), kind) for n, kind in spec]
        for field, blob, columns in zip(*(known.column(c).to_pylist() for c in ("field", "keys", "columns")), strict=True):
            asked, keys = merged[fields[field][0]][0], np.cumsum(unpack(blob, U), dtype=U)
            at = np.minimum(np.searchsorted(asked, keys), max(len(asked) - 1, 0))
            hit = np.flatnonzero(asked[at] == keys) if len(asked) else np.zeros(0, np.int64)
            for k, c in enumerate(columns):
                values[field + k][at[hit]] = unpack(c, np.int64)[hit]
        return _replies(t, values, spec, merged)

    return lambda asked: asked.groupBy("shard").cogroup(entries.groupBy("shard")).applyInArrow(look, REPLY), spec


def exchanged(asked: DataFrame, layout: Layout, leaf: tuple[Callable[[DataFrame], DataFrame], Values], prefix: int | None = None, blocks: int | None = None) -> DataFrame:
    """(block, shard, totals): the replies to the frames (block, shard of `prefix` bits, keys, counts) of all blocks."""
    orders, widths, bits, spec = len(layout.widths), layout.widths, layout.bits, leaf[1]
    prefix, blocks = min(bits, layout.fan) if prefix is None else prefix, blocks or layout.blocks
    if prefix >= bits:
        return leaf[0](asked)
    more = min(bits - prefix, layout.fan)
    cells = -(-blocks >> layout.fan)
    asked = asked.withColumn("cell", F.shiftleft(F.pmod(F.xxhash64("block"), F.lit(cells)), prefix) + F.col("shard"))

    def ask(t: pa.Table) -> pa.Table:
        merged = _merged(t, orders)
        cell, base = t.column("cell")[0].as_py(), t.column("shard")[0].as_py()
        return framed(cell, list(frames([m[0] for m in merged], [m[1] for m in merged], widths, base, prefix, more)))

    def answer(replies: pa.Table, t: pa.Table) -> pa.Table:
        return _replies(t, gathered(replies, spec), spec, _merged(t, orders))

    deeper = exchanged(asked.groupBy("cell").applyInArrow(ask, f"block long, shard long, {FRAME}"), layout, leaf, prefix + more, cells << prefix)
    return deeper.groupBy("block").cogroup(asked.groupBy("cell")).applyInArrow(answer, REPLY)


def gathered(replies: pa.Table, spec: Values) -> list[np.ndarray]:
    """The values of all of a block's keys, each in its keys' order."""
    by_shard = [x for _, x in sorted(zip(replies.column("shard").to_pylist(), replies.column("totals").to_pylist(), strict=True), key=lambda x: x[0])]
    return [np.concatenate([unpack(x[k], kind) for x in by_shard]) if by_shard else np.zeros(0, kind) for k, (_, kind) in enumerate(spec)]


def first_frames(block: int, keys: list[np.ndarray], counts: list[np.ndarray], layout: Layout) -> pa.Table:
    """A block's frames for the coarsest shards."""
    return framed(block, list(frames(keys, counts, layout.widths, 0, 0, min(layout.bits, layout.fan))))


def vocabulary(docs: DataFrame) -> tuple[int, int]:
    """Training tokens N and distinct training tokens V; docs: (text, train)."""
    arrow_limits(docs.sparkSession)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            keys, n = counted(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
            return pa.record_batch({"w": pa.array(keys.view(np.int64)), "n": pa.array(n)})

        for batch in batches:
            tokens, first = token_stream(batch.column(0))
            keep = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(first))
            if keep.any():
                held.append(counted(tokens[keep], np.ones(int(keep.sum()), np.int64)))
            if sum(len(k) for k, _ in held) > 1_000_000:
                yield out()
                held.clear()
        if held:
            yield out()

    row = docs.select("text", "train").mapInArrow(send, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    return int(row[0]), int(row[1])
