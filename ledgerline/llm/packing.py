"""Bulk-synchronous best-fit packing of tokenised documents into sequences.

Documents become pieces of at most `capacity` ids. Packing looks only at piece
lengths and sequence gaps, of which at most `capacity` different values exist, so
documents and gaps are held as classes (length, ranks) and (gap, sequences). Long
lengths go first, in bands of a factor of two. In each round of a band gaps are
sorted into ranges of sizes, waiting classes go to the range of their successor,
the smallest gap that holds them, and all ranges are swept at once, each on an
executor: longest first, so that conflicts are resolved by rank, each class fills
sequences of its successor gap. What finds no gap left in its range goes to its
new successor, in a range above, in the next round; the gaps are updated; and so
on until no class finds a gap, when sequences are opened for what waits. A round
ends classes or gap intervals, or splits one of each: intervals are at most four
times the capacity in number, and runs at most eight times that for each band, so
the runs that are sent to the executors at the end stay under 12 MB. Ranks within
a class are given on the executors in two steps (rank within a slice of the pieces
of a length, plus the slices before), so a length that a third of all pieces share
is not one task's.

Defined cases: null text is an empty text, whose only id is the closing one;
repeated rows are packed each; equal lengths are ranked by slice, key and
piece; an empty table gives an empty table; further columns are left out.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .common import over_batches, saved, table

CAPACITY, END_ID, TOKENIZER = 4096, 1, "word_bpe_49k.json"
#: Words whose ids a worker remembers; when full, it starts anew.
CACHE_WORDS = 600_000
#: Parts that a round's sizes are sorted into, and the length from which on all lengths are one band.
RANGES, SMALLEST_BAND = 8, 64


#: ASCII punctuation but the apostrophe, which belongs to what stands behind it.
_TAIL = rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""


class WordTokenizer:
    """A tokenizer file that drops white space, applied word by word with remembered words.

    Tokens never cross white space, so a text's ids are its words' ids. Ids are
    little-endian unsigned 32-bit numbers. Texts with special-token marks, and
    tokenizers for which words can't be told apart, go whole to the library.
    """

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        vocabulary = self.whole.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, k in vocabulary.items():
            self.closes[k] = token.endswith("</w>")
        self.marks = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.known: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> bytes:
        return np.array(self.whole.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()

    def _learn(self, new: set[bytes]) -> None:
        known = self.known
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
        tails: dict[bytes, tuple[bytes, bytes]] = {}  # letters and a run of ASCII punctuation behind them are pieces of their own
        plain = []
        for w in new:
            core = w.rstrip(_TAIL)
            if len(core) != len(w) and core and core.decode().isalpha():
                tail = w[len(core) :]
                tails[w] = core, tail
                plain.append(core)
                plain.append(tail)
            else:
                plain.append(w)
        plain = list(set(plain) - known.keys())
        texts = b"\n".join(plain).decode().split("\n") if plain else []
        letters = [k for k, t in enumerate(texts) if t.isalpha()]
        for lo in range(0, len(letters), 2000):
            some = letters[lo : lo + 2000]
            ids = np.array(self.whole.encode_batch_fast([" ".join(texts[k] for k in some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) == len(some) and len(ids) and ends[-1] == len(ids):
                starts = np.concatenate([[0], ends[:-1]])
                body = ids.tobytes()
                for k, s, e in zip(some, (starts * 4).tolist(), (ends * 4).tolist(), strict=True):
                    known[plain[k]] = body[s:e]
        rest = [k for k, w in enumerate(plain) if w not in known]
        for k, e in zip(rest, self.whole.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False), strict=True):
            known[plain[k]] = np.array(e.ids, "<u4").tobytes()
        for w, (core, tail) in tails.items():
            known[w] = known[core] + known[tail]

    def batch(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text; ASCII letters are lowered first, as the tokenizer lowers all."""
        out: list[bytes] = []
        lowered = [t.lower() for t in texts]
        lists = [() if any(m in t for m in self.marks) or b"<|" in t else low.split() for t, low in zip(texts, lowered, strict=True)]
        new: set[bytes] = set()
        for ws in lists:
            new.update(ws)
        new -= self.known.keys()
        if new:
            before = len(self.known)
            self._learn(new)
            if len(self.known) < before + len(new):  # it started anew: what these texts need must all be there
                rest = set().union(*lists) - self.known.keys()
                if rest:
                    self._learn(rest)
        known = self.known
        for t, ws in zip(texts, lists, strict=True):
            if ws or not t.strip():
                try:
                    out.append(b"".join(map(known.__getitem__, ws)))
                    continue
                except KeyError:
                    pass
            out.append(self._ids(t.decode()))
        return out


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def vocabulary_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of each document's tokens, cut where they exceed the capacity."""
    kind = docs.schema[key].dataType.simpleString()
    closing = np.array([end_id], "<u4").tobytes()

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        b, offsets = W.buffers(batch.column(1))
        body, at = b.tobytes(), offsets.tolist()
        rows: list[tuple[int, int, int, int, int]] = []
        bodies = []
        coder = tokenizer(path or vocabulary_path())
        for i, j in W.pieces(offsets, 4 << 20):
            for k, got in enumerate(coder.batch([body[at[d] : at[d + 1]] for d in range(i, j)]), i):
                got += closing
                for p, lo in enumerate(range(0, len(got), 4 * capacity)):
                    part = got[lo : lo + 4 * capacity]
                    rows.append((k, p, lo // 4, len(part) // 4, zlib.crc32(part)))
                    if ids:
                        bodies.append(part)
        cols = np.array(rows, np.int64).reshape(-1, 5)
        out = {key: batch.column(0).take(pa.array(cols[:, 0])), "piece": pa.array(cols[:, 1].astype(np.int32)), "start": pa.array(cols[:, 2]), "length": pa.array(cols[:, 3]), "ids_crc32": pa.array(cols[:, 4])}
        if ids:
            out["ids"] = pa.array([np.frombuffer(x, "<u4").tolist() for x in bodies], pa.list_(pa.int64()))
        return pa.record_batch(out)

    return over_batches(docs.select(key, text), cut, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * ids)


def sweep(waiting: list[tuple[int, int, int]], free: list[tuple[int, int, int]], capacity: int) -> tuple[list, list, list]:
    """One range's sweep: (runs, what still waits, free gaps) for classes (length, first rank, count) and gaps (gap, first sequence, count).

    Longest first, each class takes its successor, the smallest gap that holds it, for as many sequences as it fills.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}
    for gap, first, count in free:
        gaps.setdefault(gap, []).append((first, count))
    order = sorted(gaps)
    runs, left = [], []

    def add(gap: int, first: int, count: int) -> None:
        if gap not in gaps:
            gaps[gap] = []
            insort(order, gap)
        gaps[gap].append((first, count))

    for length, rank, n in sorted(waiting, reverse=True):
        while n and (at := bisect_left(order, length)) < len(order):
            gap = order[at]
            first, count = gaps[gap].pop()
            if not gaps[gap]:
                del gaps[gap]
                order.pop(at)
            each = min(gap // length, n)
            used = min(count, n // each)
            runs.append((length, rank, used * each, first, used, capacity - gap))
            rank, n = rank + used * each, n - used * each
            add(gap - each * length, first, used)
            if used < count:
                add(gap, first + used, count - used)
        if n:
            left.append((length, rank, n))
    return runs, left, [(gap, first, count) for gap, some in gaps.items() if gap for first, count in some]


def plan(spark: SparkSession, lengths: dict[int, int], capacity: int = CAPACITY, ranges: int = RANGES) -> np.ndarray:
    """Runs (length, first rank, count, first sequence, sequences, offset) for the given number of pieces of each length.

    The pieces of a run go round its sequences: the i-th of them to the i-th sequence, and after the last one to the first again.
    """
    waiting = [(n, 0, c) for n, c in lengths.items() if c > 0]
    gaps: list[tuple[int, int, int]] = []
    runs: list[tuple[int, ...]] = []
    sequences, high = 0, capacity
    schema = "kind int, a long, b long, c long, d long, e long, f long"

    def swept(t: pa.Table) -> pa.Table:
        rows = list(zip(*(t.column(c).to_pylist() for c in ("gap", "size", "first", "n")), strict=True))
        got = sweep([r[1:] for r in rows if not r[0]], [r[1:] for r in rows if r[0]], capacity)
        out = np.array([(kind, *r, *[0] * (6 - len(r))) for kind, some in enumerate(got) for r in some], np.int64).reshape(-1, 7)
        return pa.table({c: pa.array(out[:, k].astype(np.int32) if not k else out[:, k]) for k, c in enumerate(("kind", *"abcdef"))})

    while waiting:
        low = high // 2 if high > SMALLEST_BAND else 0
        band, waiting = [w for w in waiting if w[0] > low], [w for w in waiting if w[0] <= low]
        while band:
            sizes = np.unique([g[0] for g in gaps])
            meets = [w for w in band if len(sizes) and w[0] <= sizes[-1]]
            if not meets:  # nothing holds any of them: sequences for all are opened, of which those that stay empty are gaps of the next bands
                for length, _, n in band:
                    count = -(-n // (capacity // length))
                    gaps.append((capacity, sequences, count))
                    sequences += count
                continue
            bounds = np.unique(sizes[:: -(-len(sizes) // ranges)])
            put = [(False, *w) for w in meets] + [(True, *g) for g in gaps]
            successor = [sizes[np.searchsorted(sizes, r[1])] for r in put]
            part = np.searchsorted(bounds, successor, side="right") - 1
            both = set(part[: len(meets)].tolist())
            rest = [g for g, x in zip(gaps, part[len(meets) :].tolist(), strict=True) if x not in both]
            rows = [(x, *r) for x, r in zip(part.tolist(), put, strict=True) if x in both]
            table_ = pa.table({c: pa.array(v) for c, v in zip(("part", "gap", "size", "first", "n"), zip(*rows, strict=True), strict=True)})
            out = np.stack([c.to_numpy() for c in spark.createDataFrame(table_).groupBy("part").applyInArrow(swept, schema).toArrow().columns], 1)
            runs += map(tuple, out[out[:, 0] == 0, 1:].tolist())
            left = [tuple(r[:3]) for r in out[out[:, 0] == 1, 1:].tolist()]
            gaps = rest + [tuple(r[:3]) for r in out[out[:, 0] == 2, 1:].tolist()]
            band = [w for w in band if w not in set(meets)] + left
        high = low
    out = np.array(runs, np.int64).reshape(-1, 6)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def packed(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, ids: bool = False) -> DataFrame:
    """Each piece with its sequence_id and offset."""
    spark = docs.sparkSession
    cut = saved(pieces(docs, key, text, capacity, end_id, path, ids), "pieces")
    slices = int(spark.conf.get("spark.sql.shuffle.partitions")) * 4
    cut = cut.withColumn("slice", F.pmod(F.xxhash64(key, "piece"), F.lit(slices)).cast("int"))
    counts = saved(cut.groupBy("length", "slice").agg(F.count("*").alias("n")), "lengths")
    total = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    runs = plan(spark, total, capacity)
    shared = spark.sparkContext.broadcast((runs[:, 0] << 40 | runs[:, 1], runs))
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("slice")) - F.col("n")).drop("n")
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("length", "slice").orderBy(key, "piece")) - 1).join(before, ["length", "slice"])
    columns = [c for c in cut.columns if c != "slice"]
    ranked = ranked.select(*columns, (F.col("rank") + F.col("before")).alias("rank"))
    n = len(columns)
    at = columns.index("length")

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys, runs = shared.value
        rank = batch.column(n).to_numpy()
        length = batch.column(at).to_numpy()
        run = runs[np.searchsorted(keys, length << 40 | rank, side="right") - 1]
        turn, place_ = np.divmod(rank - run[:, 1], np.maximum(run[:, 4], 1))
        return pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(run[:, 3] + place_), pa.array(run[:, 5] + turn * length)], names=[*columns, "sequence_id", "offset"])

    types = dict(cut.dtypes)
    return over_batches(ranked, place, ", ".join(f"`{c}` {types[c]}" for c in columns) + ", sequence_id long, offset long")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece's place in the packed sequences."""
    return packed(table(spark, sf_dir, "documents"))
