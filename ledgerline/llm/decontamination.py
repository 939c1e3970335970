"""Benchmark decontamination by canonical templates.

Text becomes canonical tokens: A-Z lowered, punctuation dropped, numbers, names
(capitalised words inside a sentence) and units behind numbers replaced by typed
slots. Hashes of five-token windows are joined between documents and benchmark
items. A document leaks an item if the aligned windows cover at least half of
the item's (a question copied whole, or with few words altered) and the slots
fill consistently: one value of the item always meets one value of the document.
So a question that was given new numbers, names or units is caught, and one
where the fillings contradict each other is not.

A window may recur within an item (runs of numbers or capitalised words, answer
options, repeated phrases) and then also meets its own neighbours. So alignments
are tested one by one, and a consistent one that covers enough is a leak: all
windows within a few words of a shift, those of each exact shift, and the longest
chain of windows in the order of both texts. In the last two, a window without
any word outside its slots counts only if two of its values are the same in the
document, as other numbers or names in a row are nothing of the item.

Benchmark windows are broadcast as hashes only while there are fewer than
BROADCAST_WINDOWS; beyond, all document windows take part in a shuffled join.

Windows of nothing but slots would join every table of numbers with every other.
So they are compared only between a document and an item that also share a window
with a word, or five such values in a row.

Defined cases: null text is an empty text; items of three or four tokens are
found verbatim anywhere, of one or two only as a whole text, as so few words are
no template; items without tokens are in no document; rows with a null key or
item are in no pair, and stay in cleaned(); repeated rows count once for each
(document, item); ties keep every item; empty tables give no pairs; further
columns pass through cleaned().
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .common import over_batches, saved, table

WINDOW, COVERAGE_PERCENT = 5, 50
#: Items of at least so many tokens, but fewer than a window's, are found as verbatim parts of texts; shorter ones as whole texts.
SHORTEST = 3
#: 8 bytes each: 16 MB at most are sent to the executors.
BROADCAST_WINDOWS = 2_000_000
#: Units that become slots behind a number.
UNITS = "mm cm m km in ft yd mi mg g kg t lb oz ml l gal s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month months year years percent dollar dollars euro euros usd eur km/h mph meter meters metre metres mile miles gram grams kilogram kilograms liter liters litre litres inch inches foot feet degree degrees".split()
U = W.U64
_NUMBER, _NAME, _UNIT = U(0x1F0A_1111_2222_3333), U(0x2F0B_4444_5555_6666), U(0x3F0C_7777_8888_9999)
_WORD = np.ones(256, bool)  # bytes that are part of a token
_WORD[:128] = [chr(c).isalnum() for c in range(128)]
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True
_INNER = np.zeros(256, bool)
_INNER[list(b".,")] = True


def _unit_hashes() -> np.ndarray:
    text = " ".join(UNITS).encode()
    b = np.frombuffer(text, np.uint8)
    w = W.words(b, np.array([0, len(b)]))
    return np.sort(w.hash)


class Tokens:
    """Canonical tokens of documents: `hash` with slots replaced, `plain` without, `slot` (0 none, 1 number, 2 name, 3 unit)."""

    def __init__(self, column: pa.Array):
        b, offsets = W.buffers(column)
        parts: list[tuple[np.ndarray, ...]] = []
        for i, j in W.pieces(offsets):
            lo, hi = int(offsets[i]), int(offsets[j])
            cuts = [(lo, hi)] if hi - lo <= 2 * W.CHUNK else W._cuts(b, lo, hi, W.SPACE)
            for s, e in cuts:
                if e > s:
                    parts.append(self._part(b[s:e], offsets[i:j] - s, s))
        empty = (np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int8), np.zeros(0, bool), np.zeros(0, np.int64))
        self.hash, self.plain, self.slot, self.capital, start = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else empty
        self.first = np.searchsorted(start, offsets)
        self.start, self.offsets = start, offsets

    @staticmethod
    def _part(b: np.ndarray, firsts: np.ndarray, at: int) -> tuple[np.ndarray, ...]:
        word = _WORD[b]
        digit = _DIGIT[b]
        inner = _INNER[b]
        inner[1:-1] &= digit[:-2] & digit[2:]
        inner[[0, -1]] = False
        firsts = firsts[(firsts >= 0) & (firsts < len(b))]
        inner[firsts] = False
        s, e = W._spans(word | inner, firsts)
        if not len(s):
            return np.zeros(0, U), np.zeros(0, U), np.zeros(0, np.int8), np.zeros(0, bool), s
        plain = W.span_hash(W.prefix_hash(b, True), s, e)
        h = plain.copy()
        slot = np.zeros(len(s), np.int8)
        digits = np.zeros(len(b) + 1, np.int64)
        np.cumsum(digit | inner, out=digits[1:])
        number = digits[e] - digits[s] == e - s
        stops = np.zeros(len(b) + 1, np.int64)
        np.cumsum(_STOP[b], out=stops[1:])
        before = np.concatenate([[0], e[:-1]])  # a name doesn't open a text or follow the end of a sentence
        opening = stops[s] > stops[before]
        opening[0] = True
        opening[np.searchsorted(s, firsts[firsts <= s[-1]])] = True
        name = _UPPER[b[s]] & ~opening
        behind = np.zeros(len(s), bool)
        behind[1:] = number[:-1]
        unit = behind & ~number
        if unit.any():
            units = _unit_hashes()
            k = np.minimum(np.searchsorted(units, plain), len(units) - 1)
            unit &= units[k] == plain
        for kind, where, value in ((1, number, _NUMBER), (2, name & ~unit, _NAME), (3, unit, _UNIT)):
            h[where], slot[where] = value, kind
        return h, plain, slot, _UPPER[b[s]], s + at

    def windows(self, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """Template hashes of the windows of `size` tokens, and each one's first token."""
        return W.windows(W.Words(self.hash, self.start, self.start, self.first), size)

    def verbatim(self, size: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The same without slots. whole: only of texts that have no other tokens."""
        w = W.Words(self.plain, self.start, self.start, self.first)
        h, at = W.windows(w, size)
        if whole:
            alone = np.repeat(w.counts == size, w.counts)[at]
            h, at = h[alone], at[alone]
        return W.mix(h ^ U(size)), at

    def opened_by_names(self) -> Tokens:
        """The same texts, with a capitalised first token as a name, as which it counts where the text stands inside a sentence."""
        other = object.__new__(Tokens)
        other.plain, other.capital, other.start, other.first, other.offsets = self.plain, self.capital, self.start, self.first, self.offsets
        other.hash, other.slot = self.hash.copy(), self.slot.copy()
        begin = self.first[:-1][np.diff(self.first) > 0]
        begin = begin[self.capital[begin] & (self.slot[begin] == 0)]
        other.hash[begin], other.slot[begin] = _NAME, 2
        return other


def _windowed(df: DataFrame, key: str, text: str, keep: object, short: tuple[int, ...] | None) -> DataFrame:
    """(id, size, h, v, place, slots): windows of each text, all or those whose h is among `keep`.

    Windows of five tokens have their template's hash as h; v is the verbatim
    hash of one that has no word outside slots, and null else. slots: the five
    values, 0 where a token is no slot. Items (short is None) of fewer tokens
    have their verbatim hash as h; documents have those of `short` sizes, of
    SHORTEST tokens anywhere, of fewer as a whole text.
    """
    kind = df.schema[key].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = Tokens(batch.column(1))
        five = [(t, *t.windows())]
        if short is None:
            other = t.opened_by_names()
            h, at = other.windows()
            changed = (other.slot != t.slot)[at]
            five.append((other, h[changed], at[changed]))
        parts = []
        for tokens, h, at in five:
            if keep is not None:
                hit = _known(keep.value, h)
                h, at = h[hit], at[hit]
            slot = tokens.slot[at[:, None] + np.arange(WINDOW)] > 0
            plain = t.plain[at[:, None] + np.arange(WINDOW)]
            v = np.zeros(len(h), U)
            for i in range(WINDOW):
                v = W.mix(v * U(0xC2B2AE3D27D4EB4F) + plain[:, i])
            parts.append((np.full(len(h), WINDOW), h, v, slot.all(1), at, np.where(slot, plain.view(np.int64), 0)))
        for size in range(1, WINDOW) if short is None else short:
            h, at = t.verbatim(size, whole=short is None or size < SHORTEST)
            if keep is not None:
                hit = _known(keep.value, h)
                h, at = h[hit], at[hit]
            parts.append((np.full(len(h), size), h, h, np.zeros(len(h), bool), at, np.zeros((len(h), WINDOW), np.int64)))
        size, h, v, only, at, slots = (np.concatenate(x) for x in zip(*parts, strict=True))
        doc = np.searchsorted(t.first, at, side="right") - 1
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, len(h) * WINDOW + 1, WINDOW, dtype=np.int32)), pa.array(slots.reshape(-1)))
        return pa.record_batch(
            {
                "id": batch.column(0).take(pa.array(doc)),
                "size": pa.array(size.astype(np.int32)),
                "h": pa.array(h.view(np.int64)),
                "v": pa.array(v.view(np.int64), mask=~only),
                "place": pa.array(at - t.first[doc]),
                "slots": flat,
            }
        )

    return over_batches(df.select(F.col(key).alias("id"), F.col(text).alias("text")), make, f"id {kind}, size int, h long, v long, place long, slots array<long>")


def _known(known: np.ndarray, h: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def _slots_met(item_slots: np.ndarray, doc_slots: np.ndarray) -> int:
    """How many values of the item the windows hold, or -1 if one of them met two values."""
    some = item_slots != 0
    pairs = np.unique(np.stack([item_slots[some], doc_slots[some]]), axis=1)
    return pairs.shape[1] if len(np.unique(pairs[0])) == pairs.shape[1] else -1


def _longest_chain(place: np.ndarray, shift: np.ndarray) -> np.ndarray:
    """The most windows whose places rise in both texts; among those, the chain whose shift changes least."""
    shifts, s = np.unique(shift, return_inverse=True)
    back = np.maximum(0, shifts[:, None] - shifts[None, :])  # by shift before and after: a smaller shift needs so many places more
    turn = np.abs(shifts[:, None] - shifts[None, :])
    places, q = np.unique(place, return_inverse=True)
    most = (turn.max() + 1) * (len(places) + 1)
    best = np.zeros((len(places) + 1, len(shifts)), np.int64)  # the best chain that ends at a shift, among the first n places
    last = np.full((len(places) + 1, len(shifts)), -1)
    came = np.full(len(place), -1)
    order = np.argsort(q, kind="stable")
    ends = np.searchsorted(q[order], np.arange(len(places) + 1))
    every = np.arange(len(shifts))
    for n in range(len(places)):
        best[n + 1], last[n + 1] = best[n], last[n]
        for i in order[ends[n] : ends[n + 1]]:
            upto = np.searchsorted(places, places[n] - back[:, s[i]])
            found = last[upto, every]
            score = np.where(found >= 0, best[upto, every] - turn[:, s[i]], 0)
            k = int(score.argmax())
            came[i] = found[k] if score[k] > 0 else -1
            if score[k] + most > best[n + 1, s[i]]:
                best[n + 1, s[i]], last[n + 1, s[i]] = score[k] + most, i
    chain, i = [], last[-1, best[-1].argmax()]
    while i >= 0:
        chain.append(i)
        i = came[i]
    return np.array(chain, np.int64)


def _consistent(batch: pa.RecordBatch, coverage: int) -> pa.RecordBatch:
    """The rows (key, item, item_windows, hits) with an alignment that covers enough and is consistent, and that one's windows and values."""
    hits = batch.column(3)
    flat = hits.flatten()
    place, doc_place = (flat.field(k).to_numpy() for k in (0, 1))
    item_slots, doc_slots = (flat.field(k).flatten().to_numpy().reshape(-1, WINDOW) for k in (2, 3))
    counts = hits.value_lengths().to_numpy()
    ends = np.cumsum(counts)
    need = batch.column(2).to_numpy() * coverage
    counting = (item_slots == 0).any(1) | ((item_slots == doc_slots).sum(1) >= 2)
    rows, windows, values = [], [], []
    for r in range(batch.num_rows):
        of = np.arange(ends[r] - counts[r], ends[r])
        shift = doc_place[of] - place[of]
        found = []

        def test(some: np.ndarray, n: int) -> None:
            if 100 * n >= need[r] and (met := _slots_met(item_slots[some], doc_slots[some])) >= 0:
                found.append((n, met))

        test(of, len(np.unique(place[of])))
        for x in np.unique(shift):
            some = of[shift == x]
            test(some, len(np.unique(place[some[counting[some]]])))
        if not found and counting[of].any():
            some = of[counting[of]]
            chain = some[_longest_chain(place[some], doc_place[some] - place[some])]
            test(chain, len(chain))
        if found:
            rows.append(r)
            windows.append(max(n for n, _ in found))
            values.append(max(v for _, v in found))
    kept = batch.select([0, 1, 2]).take(pa.array(rows, pa.int64()))
    return pa.record_batch([*kept.columns, pa.array(windows, pa.int64()), pa.array(values, pa.int64())], [*kept.schema.names, "n_windows", "n_slots"])


def leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", item: str = "item_id", text: str = "text", coverage: int = COVERAGE_PERCENT) -> DataFrame:
    """(key, item, n_windows, item_windows, n_slots): the documents' leaked items."""
    spark = docs.sparkSession
    items = saved(_windowed(benchmark.where(F.col(item).isNotNull()), item, text, None, None).withColumnRenamed("id", "item"), "items")
    sizes = items.groupBy("item").agg(F.countDistinct("place").alias("item_windows"))
    keep = None
    if items.count() < BROADCAST_WINDOWS:
        hashes = np.unique(np.array([r[0] for r in items.select("h").distinct().collect()], np.int64).view(U))
        keep = spark.sparkContext.broadcast(hashes)
    short = tuple(sorted(r[0] for r in items.where(F.col("size") < WINDOW).select("size").distinct().collect()))  # at most four
    mine = saved(_windowed(docs.where(F.col(key).isNotNull()), key, text, keep, short), "windows").withColumnsRenamed({"id": "doc", "place": "doc_place", "slots": "doc_slots"})
    theirs = items.select("item", "h", "v", "place", F.col("slots").alias("item_slots"))
    words = mine.where("v is null").drop("size", "v").join(theirs.where("v is null").drop("v"), "h").drop("h")
    # windows of nothing but slots are alike in all tables of numbers: they are compared where words or the same values met
    slots_only, their_slots = mine.where("v is not null"), theirs.where("v is not null")
    same = slots_only.select("doc", "v").distinct().join(their_slots.select("item", "v").distinct(), "v").select("doc", "item")
    pairs = words.select("doc", "item").union(same).distinct()
    slots_met = slots_only.drop("size", "v").join(pairs, "doc").join(their_slots.drop("v"), ["item", "h"]).select(*words.columns)
    met = words.unionByName(slots_met)
    # aligned: the copy's shift between item and document; a few inserted words move it, so shifts are pooled by 8.
    # A pool holds at most 16 windows of a document for each of the item.
    met = met.withColumn("shift", F.floor((F.col("doc_place") - F.col("place")) / 8))
    per = met.groupBy("doc", "item", "shift").agg(F.collect_set(F.struct("place", "doc_place", "item_slots", "doc_slots")).alias("hits"))
    both = per.select("doc", "item", F.explode(F.array("shift", F.col("shift") + 1)).alias("shift"), "hits")
    pooled = both.groupBy("doc", "item", "shift").agg(F.flatten(F.collect_list("hits")).alias("hits")).join(sizes, "item")
    enough = pooled.where(100 * F.size(F.array_distinct("hits.place")) >= coverage * F.col("item_windows"))
    kinds = ", ".join(f"{c} {enough.schema[c].dataType.simpleString()}" for c in ("doc", "item"))
    good = over_batches(enough.select("doc", "item", "item_windows", "hits"), lambda batch: _consistent(batch, coverage), f"{kinds}, item_windows long, n_windows long, n_slots long")
    best = good.groupBy("doc", "item").agg(F.max("n_windows").alias("n_windows"), F.max("item_windows").alias("item_windows"), F.max("n_slots").alias("n_slots"))
    return best.select(F.col("doc").alias(key), F.col("item").alias(item), "n_windows", "item_windows", "n_slots")


def cleaned(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that leak no item."""
    return docs.join(leaks(docs, benchmark, key=key, text=text).select(key).distinct(), key, "left_anti").select(docs.columns)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and the benchmark items that they leak."""
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
