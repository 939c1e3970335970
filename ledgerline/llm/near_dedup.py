"""Near-duplicates by weighted Jaccard similarity of word-shingle multisets (BagMinHash).

A document is the multiset of its five-word windows. Signatures are BagMinHash:
each shingle owns Poisson processes over its discretised weight, split into the
dyadic intervals (0,1], (1,2], (2,4], (4,8], ... so that a weight w sees all
points of the intervals below it and, of the last, the points whose level is at
most w. A register keeps the earliest point that falls on it, so two registers
agree with the probability of the weighted Jaccard similarity. Points later
than a bound that fills all registers are never made; a signature that the
bound left unfilled is made again with twice the bound.

Steps: (1) equal multisets are one class by fingerprint, and only one document
of each goes on; (2) bands of registers give buckets, of which one of each set of
members is kept; (3) each bucket's members are linked to its first member if the
exact multiset overlap of their texts is enough. Buckets of two are then decided.
In larger ones pairs whose registers agree little are left to step 4; (4) buckets
that still hold several classes are split by weight, as a similarity of 0.8 bounds
the ratio of two weights: a group holds the members of one step of 1.25 and of the
next. Groups are dealt to cells of at most two blocks of members. A cell computes
the exact overlaps of its members outside its largest class with all others, as
products of incidence matrices, and returns a forest of links between classes; (5)
components of the links are the classes.

So each pair that shares a bucket is either joined by other links or decided by its
exact overlap; estimates decide nothing. A pair at similarity 0.8 shares no bucket
with a probability of 5e-5. No pairs within a group are written out: step 3 writes
one per member, step 4 at most one per class of a cell.

Defined cases: null text is an empty text; texts without words are copies of each
other; a text of one to four words has its whole word sequence as its only shingle;
repeated rows of one key get the same class; of rows of one key with different
texts, the text with the smallest hash stands for all, in classes and in what is
kept; rows with a null key are in no class and all kept; an empty table gives an
empty table; the kept document of a class is the one with the smallest key, the
row with the smallest hash if that key's rows differ; further columns pass through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words as W
from .common import dropped, over_batches, release, saved, table
from .components import components

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: Step 3 leaves pairs of buckets of more than two to step 4 if fewer of their registers agree.
AGREEMENT = 0.6
#: Members of a block of step 4, and the shingles that all of them hold together, about.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Shingles that more members of a cell hold are counted by matrix products, the others by pairs.
RARE = 24
U = W.U64


def multisets(b: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count), sorted by document and shingle."""
    w = W.words(b, offsets)
    h, at = W.windows(w, size)
    doc = w.doc[at]
    for k in range(1, size):  # texts of fewer words than a shingle
        few = np.flatnonzero(w.counts == k)
        if len(few):
            x = np.full(len(few), k, U)
            for i in range(k):
                x = x * U(0xC2B2AE3D27D4EB4F) + w.hash[w.first[few] + i]
            h, doc = np.concatenate([h, W.mix(x)]), np.concatenate([doc, few])
    if not len(h):
        return doc, h, np.zeros(0, np.int64)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    return doc[first], h[first], np.diff(np.append(first, len(h)))


def _uniform(x: np.ndarray) -> np.ndarray:
    """(0, 1] from 64 random bits."""
    return ((x >> U(11)).astype(np.float64) + 1.0) * 2.0**-53


def signatures(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """BagMinHash registers (n x m, 64 bits) of documents 0..n-1; zeros for empty multisets."""
    out = np.zeros((n, m), U)
    total = np.bincount(doc, weights=count, minlength=n)
    todo = np.flatnonzero(total > 0)
    factor = np.log(m) + 3.0
    while len(todo):
        bound = np.zeros(n)
        bound[todo] = m * factor / total[todo]
        mine = bound[doc] > 0
        filled = _registers(doc[mine], shingle[mine], count[mine], bound, out, m)
        out[todo[~filled[todo]]] = 0
        todo, factor = todo[~filled[todo]], factor * 2
    return out


def _registers(doc: np.ndarray, shingle: np.ndarray, count: np.ndarray, bound: np.ndarray, out: np.ndarray, m: int) -> np.ndarray:
    docs, seeds, rates, lows, weights = [], [], [], [], []
    level = 0
    left = np.arange(len(doc))
    while len(left):  # the dyadic intervals that a weight reaches into
        low = 0 if level == 0 else 2 ** (level - 1)
        docs.append(doc[left])
        seeds.append(W.mix(shingle[left] + U(level * 0x9E3779B97F4A7C15 & (2**64 - 1))))
        rates.append(np.full(len(left), 1.0 if level == 0 else float(low)))
        lows.append(np.full(len(left), low))
        weights.append(count[left])
        left = left[count[left] > max(1, 2 * low) if level else count[left] > 1]
        level += 1
    d, seed, rate, low, weight = map(np.concatenate, (docs, seeds, rates, lows, weights))
    best = np.full(len(bound) * m, np.inf)
    owner = np.zeros(len(bound) * m, U)
    t = np.zeros(len(d))
    step = 0
    while len(d):
        x = W.mix(seed + U((step * 0xD1B54A32D192ED03 + 1) & (2**64 - 1)))
        t = t - np.log(_uniform(x)) / rate
        live = t <= bound[d]
        d, seed, rate, low, weight, t, x = (v[live] for v in (d, seed, rate, low, weight, t, x))
        y = W.mix(x + U(0xA0761D6478BD642F))
        at = d * m + (y % U(m)).astype(np.int64)
        taken = low + 1 + np.floor((y >> U(33)).astype(np.float64) * 2.0**-31 * rate) <= weight
        at, when, who = at[taken], t[taken], y[taken]
        np.minimum.at(best, at, when)
        won = best[at] == when
        owner[at[won]] = who[won]
        step += 1
    full = np.isfinite(best).reshape(-1, m).all(1)
    rows = np.flatnonzero(full & (bound > 0))
    out[rows] = owner.reshape(-1, m)[rows]
    return full | (bound == 0)


def _hash(text: str) -> F.Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def signed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, th, weight, fp1, fp2, bands, signature): the text's hash, the multiset's size and fingerprint, its buckets, a byte per register."""
    kind = docs.schema[key].dataType.simpleString()

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        b, offsets = W.buffers(batch.column(1))
        n = batch.num_rows
        doc, shingle, count = multisets(b, offsets)
        first = np.searchsorted(doc, np.arange(n + 1))
        prints = []
        for salt in (1, 2):
            total = np.zeros(len(doc) + 1, U)
            np.cumsum(W.mix(shingle + U(salt)) * count.astype(U), out=total[1:])
            prints.append((total[first[1:]] - total[first[:-1]]).view(np.int64))
        weight = np.bincount(doc, weights=count, minlength=n).astype(np.int64)
        regs = signatures(doc, shingle, count, n)
        bands = np.zeros((n, BANDS), U)
        for k in range(ROWS):
            bands = bands * U(0x9FB21C651E98DF25) + regs[:, k : BANDS * ROWS : ROWS]
        bands = W.mix(bands + np.arange(BANDS, dtype=U) * U(0xE7037ED1A0B428DB)).view(np.int64)
        few = np.ascontiguousarray((regs & U(255)).astype(np.uint8))
        return pa.record_batch(
            {
                key: batch.column(0),
                "th": batch.column(2),
                "weight": pa.array(weight),
                "fp1": pa.array(prints[0]),
                "fp2": pa.array(prints[1]),
                "bands": pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)), pa.array(bands.reshape(-1))),
                "signature": pa.FixedSizeBinaryArray.from_buffers(pa.binary(REGISTERS), n, [None, pa.py_buffer(few.tobytes())]).cast(pa.binary()),
            }
        )

    return over_batches(docs.select(key, text, _hash(text).alias("th")), sign, f"`{key}` {kind}, th long, weight long, fp1 long, fp2 long, bands array<long>, signature binary")


def overlaps(left: pa.Array, right: pa.Array) -> np.ndarray:
    """The exact weighted Jaccard similarity of each pair of texts."""
    sides = []
    for column in (left, right):
        b, offsets = W.buffers(column)
        sides.append(multisets(b, offsets))
    n = len(left)
    doc = np.concatenate([s[0] for s in sides])
    h = np.concatenate([s[1] for s in sides])
    c = np.concatenate([s[2] for s in sides])
    order = np.lexsort((h, doc))
    doc, h, c = doc[order], h[order], c[order]
    both = np.flatnonzero((h[1:] == h[:-1]) & (doc[1:] == doc[:-1])) if len(h) else np.zeros(0, np.int64)
    common = np.bincount(doc[both], weights=np.minimum(c[both], c[both + 1]), minlength=n)
    total = np.bincount(doc, weights=c, minlength=n) - common
    return np.where(total > 0, common / np.maximum(total, 1), 1.0)


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose texts (id, text) overlap enough."""
    joined = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b")

    def test(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = overlaps(batch.column(2), batch.column(3))
        good = pa.array(s >= similarity - 1e-12)
        return pa.record_batch({"a": batch.column(0), "b": batch.column(1)}).filter(good)

    kind = pairs.schema["a"].dataType.simpleString()
    return over_batches(joined.select("a", "b", "left", "right"), test, f"a {kind}, b {kind}")


def bags(texts: DataFrame) -> DataFrame:
    """(id, bag): the multiset of each text (id, text) as distinct 64-bit elements, one for each occurrence of a shingle."""
    kind = texts.schema["id"].dataType.simpleString()

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        b, offsets = W.buffers(batch.column(1))
        doc, shingle, count = multisets(b, offsets)
        ends = np.cumsum(count)
        which = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
        elements = W.mix(np.repeat(shingle, count) + which.astype(U) * U(0xD6E8FEB86659FD93))
        at = np.concatenate([[0], np.cumsum(np.bincount(doc, weights=count, minlength=batch.num_rows))]).astype(np.int64) * 8
        body = elements.tobytes()
        return pa.record_batch({"id": batch.column(0), "bag": pa.array([body[i:j] for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())})

    return over_batches(texts, make, f"id {kind}, bag binary")


def common(elements: np.ndarray, owner: np.ndarray, n: int, rows: np.ndarray) -> np.ndarray:
    """How many elements each of the members `rows` has in common with each of the n members."""
    row = np.full(n, -1)
    row[rows] = np.arange(len(rows))
    out = np.zeros((len(rows), n), np.float32)
    order = np.argsort(elements, kind="stable")
    e, owner = elements[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]])) if len(e) else np.zeros(0, np.int64)
    held = np.diff(np.append(first, len(e)))
    size = np.repeat(held, held)
    few = np.flatnonzero((size > 1) & (size <= RARE))
    group = np.repeat(np.arange(len(first)), held)
    for lo in range(0, len(few), 1 << 16):
        some = few[lo : lo + (1 << 16)]
        codes = []
        for step in range(1, RARE):
            a, b = some[some + step < len(e)], some[some + step < len(e)] + step
            same = group[a] == group[b]
            if not same.any():
                break
            i, j = owner[a[same]], owner[b[same]]
            for p, q in ((i, j), (j, i)):
                mine = row[p] >= 0
                codes.append(row[p[mine]] * n + q[mine])
        if codes:
            at, n_ = np.unique(np.concatenate(codes), return_counts=True)
            out.reshape(-1)[at] += n_
    many = np.flatnonzero(held > RARE)
    for lo in range(0, len(many), 1024):
        some = many[lo : lo + 1024]
        at = np.concatenate([np.arange(first[g], first[g] + held[g]) for g in some])
        has = np.zeros((n, len(some)), np.float32)
        has[owner[at], np.repeat(np.arange(len(some)), held[some])] = 1
        out += has[rows] @ has.T
    return out


def linked_classes(members: pa.Table, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """(class, class it is linked to) of a cell's members (id, side, class, bag), by exact overlaps."""
    found, cls = np.unique(members.column("class").to_numpy(zero_copy_only=False), return_inverse=True)
    if len(found) < 2:
        return found[:0], found[:0]
    side = members.column("side").to_numpy()
    parts = [np.frombuffer(x, U) for x in members.column("bag").to_pylist()]
    weight = np.array([len(x) for x in parts])
    rows = np.flatnonzero(cls != np.bincount(cls).argmax())
    elements = np.concatenate(parts)
    del parts
    both = common(elements, np.repeat(np.arange(len(weight)), weight), len(weight), rows)
    del elements
    two = side.min() != side.max()
    found_pairs = []
    for lo in range(0, len(rows), 128):  # some rows at a time, for the tables of a whole cell are large
        some = rows[lo : lo + 128]
        part = both[lo : lo + 128]
        near = part >= (similarity - 1e-12) * (weight[some][:, None] + weight[None, :] - part)
        near &= cls[some][:, None] != cls[None, :]
        if two:  # each side's own pairs are another cell's
            near &= side[some][:, None] != side[None, :]
        x, y = np.nonzero(near)
        p, q = cls[some[x]], cls[y]
        found_pairs.append(np.unique(np.minimum(p, q) * len(found) + np.maximum(p, q)))
    codes = np.unique(np.concatenate(found_pairs))
    p, q = np.divmod(codes, len(found))
    root = np.arange(len(found))
    while True:
        low = np.minimum(root[p], root[q])
        new = root.copy()
        for end in (root[p], root[q], p, q):
            np.minimum.at(new, end, low)
        while (jump := new[new] != new).any():
            new[jump] = new[new[jump]]
        if (new == root).all():
            break
        root = new
    changed = root != np.arange(len(found))
    return found[changed], found[root[changed]]


def _searched(of: DataFrame, docs: DataFrame, key: str, text: str, similarity: float) -> DataFrame:
    """Step 4: links (a, b) between classes; of: the members (bucket, id, class, weight) of buckets of more than two."""
    kind = of.schema["id"].dataType.simpleString()
    mixed = of.groupBy("bucket").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("bucket")
    step = F.floor(F.log("weight") / F.log(F.lit(1 / similarity)) + 1e-9).cast("int")
    dealt = of.join(mixed, "bucket", "left_semi").withColumn("own", step).withColumn("step", F.explode(F.array("own", F.col("own") - 1)))
    group = ["bucket", "step"]
    # two weights whose ratio is at least the similarity are in one step or in neighbours; a group without a member of its own step has no pair of its own
    prints = [F.sum(F.xxhash64("id", F.lit(k)).cast("decimal(38,0)")).alias(f"ids{k}") for k in (1, 2)]
    stats = dealt.groupBy(*group).agg(F.count("*").alias("n"), F.min("class").alias("lo"), F.max("class").alias("hi"), F.max(F.col("own") == F.col("step")).alias("owns"), F.sum("weight").alias("shingles"), *prints)
    stats = stats.where("lo <> hi and owns").groupBy("n", "ids1", "ids2").agg(F.min(F.struct(*group, "shingles")).alias("x")).select("x.*", "n")
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    cells = dealt.join(stats.select(*group, blocks.alias("blocks")), group).withColumn("side", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cells = saved(cells.select(*group, "id", "class", "blocks", "side"), "cells")
    bag = saved(bags(_texts(docs, key, text, cells.select("id").distinct())), "bags")
    cells = cells.join(bag, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(*group, F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y"), "side", "id", "class", "bag")

    def search(members: pa.Table) -> pa.Table:
        a, b = linked_classes(members, similarity)
        release()
        return pa.table({"a": pa.array(a), "b": pa.array(b)}).cast(pa.schema([("a", members.schema.field("class").type), ("b", members.schema.field("class").type)]))

    return cells.groupBy(*group, "x", "y").applyInArrow(search, f"a {kind}, b {kind}")


def _texts(docs: DataFrame, key: str, text: str, asked: DataFrame) -> DataFrame:
    """(id, text) of the asked ids.

    A table of 2**20 hash values at most, so of a proven size, is broadcast
    first; it keeps most other texts out of the shuffle while ids are few.
    """
    bit = F.pmod(F.xxhash64("id"), F.lit(1 << 20)).cast("int")
    bits = F.broadcast(asked.select(bit.alias("bit")).distinct())
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn("bit", bit).join(bits, "bit", "left_semi").drop("bit")
    return saved(texts.join(asked, "id", "left_semi").groupBy("id").agg(F.min_by("text", _hash("text")).alias("text")), "texts")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """(key, class_id): documents whose texts a chain of similar texts connects share the smallest key among them."""
    kind = docs.schema[key].dataType.simpleString()
    sig = saved(signed(docs.where(F.col(key).isNotNull()), key, text), "signatures")
    several = saved(sig.groupBy(key).agg(F.min("th").alias("th"), F.max("th").alias("other")).where("th <> other"), "clashes")
    clashing = several.limit(1).count() > 0
    mine = sig.join(several.select(key), key, "left_anti").unionByName(sig.join(several.select(key, "th"), [key, "th"], "left_semi")) if clashing else sig
    same = ["weight", "fp1", "fp2"]
    reps = mine.groupBy(*same).agg(F.min(key).alias("id"), F.min_by("bands", key).alias("bands"), F.min_by("signature", key).alias("signature"))
    reps = saved(reps, "representatives")
    member = reps.where("weight > 0").select("id", "weight", F.explode("bands").alias("bucket"))
    prints = [F.sum(F.xxhash64("id", F.lit(k)).cast("decimal(38,0)")).alias(f"ids{k}") for k in (1, 2)]
    first = member.groupBy("bucket").agg(F.min("id").alias("first"), F.count("*").alias("n"), *prints).where("n > 1")
    first = first.groupBy("n", "first", "ids1", "ids2").agg(F.min("bucket").alias("bucket"))  # one bucket of each set of members
    held = saved(member.join(first.select("bucket", "first", "n"), "bucket"), "buckets")
    star = held.where("id <> first").groupBy(F.col("first").alias("a"), F.col("id").alias("b")).agg((F.min("n") == 2).alias("alone"))
    signs = reps.select("id", "weight", "signature")
    sides = [signs.select(F.col("id").alias(c), F.col("weight").alias(f"w{c}"), F.col("signature").alias(f"s{c}")) for c in ("a", "b")]
    likely = star.join(sides[1], "b").join(sides[0], "a").where(F.least("wa", "wb") >= similarity * F.greatest("wa", "wb") - 1e-6)

    def agreeing(batch: pa.RecordBatch) -> pa.RecordBatch:
        p, q = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for k in (3, 4))
        good = ((p == q).mean(1) >= AGREEMENT) | batch.column(2).to_numpy(zero_copy_only=False)
        return pa.record_batch({"a": batch.column(0), "b": batch.column(1)}).filter(pa.array(good))

    pairs = saved(over_batches(likely.select("a", "b", "alone", "sa", "sb"), agreeing, f"a {kind}, b {kind}"), "pairs")
    asked = saved(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct(), "asked")
    texts = _texts(docs, key, text, asked)
    links = saved(_verified(pairs, texts, similarity), "verified")
    dropped(texts, asked, pairs)
    roots = components(links)
    of = held.where("n > 2").join(roots.withColumnRenamed("node", "id"), "id", "left").select("bucket", "id", "weight", F.coalesce("root", "id").alias("class"))
    more = saved(_searched(saved(of, "members"), docs, key, text, similarity), "more")
    roots = components(links.union(more)) if more.limit(1).count() else roots
    rooted = reps.select("id", *same).join(roots.withColumnRenamed("node", "id"), "id", "left").select(*same, F.coalesce("root", "id").alias("class_id"))
    out = mine.select(key, *same).join(rooted, same).select(key, "class_id")
    return sig.select(key).join(out.distinct(), key) if clashing else out


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with all its columns; documents without a key stay."""
    kept = classes(docs, key, text).where(F.col(key) == F.col("class_id")).select(key).distinct()
    row = F.struct(*(F.col(c) for c in docs.columns))
    one = docs.join(kept, key, "left_semi").groupBy(F.col(key).alias("__key")).agg(F.min_by(row, F.struct(_hash(text), F.xxhash64(*docs.columns))).alias("__row")).select("__row.*")
    return one.unionByName(docs.where(F.col(key).isNull())).select(docs.columns)


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's class of near-duplicates."""
    return classes(table(spark, sf_dir, "documents"))
