"""Toxicity by subword-bag embeddings and a linear softmax, trained jointly in numpy.

A word is its character 3-, 4- and 5-grams (with word ends) and itself, hashed
to buckets, so an unseen misspelling shares most vectors with the word it hides.
A window of words is the average of its buckets' vectors; a linear softmax gives
its logit. A text's logit is its highest window's, so a few insults in a long
text weigh as much as in a short one. Training is by documents: windows of toxic
documents count by how toxic they already look (all alike at first), those of
clean ones by how wrong they look. A last step fits a slope and an intercept on
labelled documents that weren't trained on.

The model is fitted on a bounded sample of the labelled rows: TRAIN_DOCS of each
label of TRAIN_BYTES together, those of at most SHORT_BYTES first, then longer ones;
CALIBRATE_DOCS further ones of any length set slope and intercept. Texts are taken
whole; the first one may be of any size. Every document is scored whole.

Defined cases: null text is an empty text; a text without words has a logit of -30,
which is a score of 0; repeated and conflicting labels of one
document count as toxic if any says so; null labels are ignored; without labels
of both kinds all scores are 0; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words as W
from .common import crc32_mod, dropped, over_batches, saved, table

BUCKETS, DIMENSIONS, WINDOW = 1 << 17, 8, 12
TRAIN_DOCS, TRAIN_BYTES, SHORT_BYTES, CALIBRATE_DOCS = 2000, 2 << 20, 2000, 800
EPOCHS, RATE, BATCH = 8, 0.5, 64
THRESHOLD = 0.3
_LETTER = np.ones(256, bool)
_LETTER[:128] = [chr(c).isalnum() for c in range(128)]
U = W.U64


def features(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each subword, its word, each document's first word) of documents in b."""
    s, e = W._spans(_LETTER[b], offsets[:-1])
    first = np.searchsorted(s, offsets)
    if not len(s):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), first
    size = e - s + 2
    begin = np.concatenate([[0], np.cumsum(size)])
    body = np.full(begin[-1], 60, np.uint8)  # <word>
    body[begin[1:] - 1] = 62
    inner = np.ones(len(body), bool)
    inner[begin[:-1]] = inner[begin[1:] - 1] = False
    body[inner] = W.FOLD[b[np.repeat(s - np.concatenate([[0], np.cumsum(e - s)[:-1]]), e - s) + np.arange((e - s).sum())]]
    prefix = W.prefix_hash(body)
    at = np.flatnonzero(W.code_points(body))
    ends = np.append(at, len(body))
    word = np.searchsorted(begin, at, side="right") - 1
    hashes, owners = [W.span_hash(prefix, begin[:-1], begin[1:])], [np.arange(len(s))]
    for n in (3, 4, 5):
        if len(at) < n:
            continue
        ok = np.flatnonzero(word[: len(at) - n + 1] == word[n - 1 :])
        hashes.append(W.span_hash(prefix, at[ok], ends[ok + n]))
        owners.append(word[ok])
    return (np.concatenate(hashes) % U(BUCKETS)).astype(np.int64), np.concatenate(owners), first


class Model:
    """Bucket vectors and the softmax, folded for scoring into one weight per bucket."""

    def __init__(self, weights: np.ndarray, slope: float = 1.0, intercept: float = 0.0):
        self.weights, self.slope, self.intercept = weights, slope, intercept

    def logits(self, column: pa.Array) -> np.ndarray:
        raw = self.highest(column)
        return np.where(np.isnan(raw), -30.0, self.slope * raw + self.intercept)

    def highest(self, column: pa.Array) -> np.ndarray:
        """Each text's highest window before calibration; NaN without words."""
        b, offsets = W.buffers(column)
        out = np.zeros(len(offsets) - 1)
        for i, j in W.pieces(offsets, 1 << 20):
            lo, hi = int(offsets[i]), int(offsets[j])
            if hi - lo <= 4 << 20:
                out[i:j] = self._best(*self._words(b[lo:hi], offsets[i : j + 1] - lo))
            else:  # one very long text: in parts cut at white space
                parts = [self._words(b[s:e], np.array([0, e - s])) for s, e in W._cuts(b, lo, hi, W.SPACE)]
                total, count = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
                out[i:j] = self._best(total, count, np.array([0, len(total)]))
        return out

    def _words(self, b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bucket, word, first = features(b, offsets)
        n = first[-1]
        return np.bincount(word, weights=self.weights[bucket], minlength=n), np.bincount(word, minlength=n), first

    @staticmethod
    def _best(total: np.ndarray, count: np.ndarray, first: np.ndarray) -> np.ndarray:
        n = len(total)
        sums, sizes = np.concatenate([[0], np.cumsum(total)]), np.concatenate([[0], np.cumsum(count)])
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        begin = np.arange(n)
        end = np.minimum(begin + WINDOW, first[doc + 1]) if n else begin
        begin = np.maximum(first[doc], np.minimum(begin, end - WINDOW)) if n else begin
        value = (sums[end] - sums[begin]) / np.maximum(sizes[end] - sizes[begin], 1)
        out = np.full(len(first) - 1, np.nan)
        some = np.flatnonzero(np.diff(first) > 0)
        if len(some):
            out[some] = np.maximum.reduceat(value, first[some])
        return out


def _segments(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Half-overlapping windows for training: (buckets, where each window's begin, document of each window)."""
    b, offsets = W.buffers(column)
    buckets, sizes, docs = [], [], []
    for i, j in W.pieces(offsets, 1 << 18):
        lo = int(offsets[i])
        bucket, word, first = features(b[lo : int(offsets[j])], offsets[i : j + 1] - lo)
        doc = np.repeat(np.arange(j - i), np.diff(first))
        half = WINDOW // 2
        place = (np.arange(first[-1]) - first[doc]) // half if len(doc) else np.zeros(0, np.int64)
        n = np.maximum((np.diff(first) + half - 1) // half - 1, 1)
        base = np.concatenate([[0], np.cumsum(n)])
        one, two = base[doc] + np.maximum(place - 1, 0), base[doc] + np.minimum(place, n[doc] - 1)
        one, two = one[word], two[word]
        window = np.concatenate([one, two[one != two]])
        order = np.argsort(window, kind="stable")
        buckets.append(np.concatenate([bucket, bucket[one != two]])[order].astype(np.int32))
        sizes.append(np.bincount(window, minlength=base[-1]))
        docs.append(np.repeat(np.arange(i, j), n))
    return np.concatenate(buckets), np.concatenate([[0], np.cumsum(np.concatenate(sizes))]), np.concatenate(docs)


def train(texts: pa.Array, toxic: np.ndarray, seed: int = 7) -> Model:
    """Vectors and softmax, by Adagrad steps over batches of documents."""
    rng = np.random.default_rng(seed)
    bucket, at, doc = _segments(texts)
    of = np.searchsorted(doc, np.arange(len(toxic) + 1))
    size = np.maximum(np.diff(at), 1)
    e = rng.normal(0, 0.05, (BUCKETS, DIMENSIONS)).astype(np.float32)
    u = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    e_sum, u_sum = np.full(BUCKETS, 1e-6, np.float32), np.full((DIMENSIONS, 2), 1e-6, np.float32)
    for epoch in range(EPOCHS):
        for lot in np.array_split(rng.permutation(len(toxic)), max(1, len(toxic) // BATCH)):
            lot = np.sort(lot)
            ws = np.concatenate([np.arange(of[d], of[d + 1]) for d in lot])
            owner = np.repeat(np.arange(len(lot)), of[lot + 1] - of[lot])
            take = np.concatenate([np.arange(at[w], at[w + 1]) for w in ws])
            row = np.repeat(np.arange(len(ws)), at[ws + 1] - at[ws])
            ids = bucket[take]
            hidden = np.stack([np.bincount(row, weights=e[ids, k], minlength=len(ws)) for k in range(DIMENSIONS)], 1) / size[ws][:, None]
            z = hidden @ u
            margin = z[:, 1] - z[:, 0]
            p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            y = toxic[lot][owner].astype(float)
            sharp = 0.0 if epoch == 0 else 1.0  # toxic documents: which window is to blame
            weight = np.exp(sharp * np.clip(margin, -20, 20))
            weight /= np.bincount(owner, weights=weight, minlength=len(lot))[owner]
            g = (p - y) * np.where(y > 0, weight, 0.3)
            gz = np.stack([-g, g], 1)
            gu = hidden.T @ gz
            gh = (gz @ u.T) / size[ws][:, None]
            flat = gh[row]
            touched, inverse = np.unique(ids, return_inverse=True)
            ge = np.stack([np.bincount(inverse, weights=flat[:, k], minlength=len(touched)) for k in range(DIMENSIONS)], 1)
            e_sum[touched] += (ge**2).mean(1)
            e[touched] -= (RATE * ge / np.sqrt(e_sum[touched])[:, None]).astype(np.float32)
            u_sum += gu**2
            u -= (0.1 * gu / np.sqrt(u_sum)).astype(np.float32)
    return Model((e @ (u[:, 1] - u[:, 0])).astype(np.float32))


def calibrate(model: Model, texts: pa.Array, toxic: np.ndarray, weight: np.ndarray) -> Model:
    """Slope and intercept of the documents' logits by Newton steps, lightly held to a slope of zero."""
    x = np.nan_to_num(model.highest(texts))
    scale = max(float(np.abs(x).max()), 1e-9) if len(x) else 1.0
    a = np.stack([x / scale, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - toxic)) + np.array([1e-3, 1e-3]) * w
        hess = (a * (weight * p * (1 - p))[:, None]).T @ a + np.eye(2) * 1e-3
        w -= np.clip(np.linalg.solve(hess, grad), -5, 5)
    return Model(model.weights, float(w[0] / scale), float(w[1]))


def fitted(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    """The model, from the sample of labels (key, toxic) and their documents; None without both labels."""
    marks = saved(labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg((F.max("toxic") > 0).cast("int").alias("toxic")), "marks")
    number = {r["toxic"]: r["n"] for r in marks.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    h = F.xxhash64("k")
    apart = F.pmod(h, F.lit(5)) == 0  # a fifth is for calibration
    some = [marks.where((F.col("toxic") == label) & part).orderBy(h, "k").limit(n) for label in (0, 1) for part, n in ((~apart, 2 * TRAIN_DOCS), (apart, CALIBRATE_DOCS))]
    chosen = saved(some[0].union(some[1]).union(some[2]).union(some[3]), "chosen")  # of proven size
    got = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(chosen), "k")
    got = saved(got.select("k", "t", "toxic", h.alias("h"), apart.alias("apart"), F.coalesce(F.octet_length("t"), F.lit(0)).cast("long").alias("size")), "sample")
    first = {False: (F.col("size") > SHORT_BYTES, "h", "k"), True: ("h", "k")}  # short texts come first to train on

    def bounded(label: int, rest: bool, docs_: int, bytes_: int) -> pa.Table:
        mine = got.where((F.col("toxic") == label) & (F.col("apart") == rest))
        ranked = mine.drop("t").withColumn("at", F.row_number().over(Window.partitionBy("toxic").orderBy(*first[rest])))
        before = F.sum("size").over(Window.partitionBy("toxic").orderBy("at")) - F.col("size")
        taken = ranked.withColumn("before", before).where((F.col("at") <= docs_) & ((F.col("before") + F.col("size") <= bytes_) | (F.col("at") == 1)))
        return mine.join(F.broadcast(taken.select("k").distinct()), "k", "left_semi").select("t", "toxic").toArrow()

    fit = [bounded(label, False, TRAIN_DOCS, TRAIN_BYTES) for label in (0, 1)]
    if not fit[0].num_rows or not fit[1].num_rows:
        return None
    both = pa.concat_tables(fit).combine_chunks()
    model = train(both.column("t"), both.column("toxic").to_numpy())
    held = pa.concat_tables([bounded(label, True, CALIBRATE_DOCS, 4 * TRAIN_BYTES) for label in (0, 1)]).combine_chunks()
    y = held.column("toxic").to_numpy()
    if len(np.unique(y)) < 2:
        held, y = both, both.column("toxic").to_numpy()
    dropped(marks, chosen, got)
    share = np.array([number[k] / sum(number.values()) / (y == k).sum() for k in (0, 1)]) * len(y)  # as frequent as the labels say
    return calibrate(model, held.column("t"), y, share[y])


def scored(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of each document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema[key].dataType.simpleString()

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        value = np.zeros(batch.num_rows) if m is None else 1 / (1 + np.exp(-np.clip(m.logits(batch.column(1)), -30, 30)))
        return pa.record_batch({key: batch.column(0), "score": pa.array(value)})

    return over_batches(docs.select(key, text), score, f"`{key}` {kind}, score double")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's toxicity, learnt from labels outside the held-out quarter."""
    docs, held = table(spark, sf_dir, "documents"), crc32_mod("doc_id", 4) == 2
    model = fitted(docs, table(spark, sf_dir, "labels").where(~held))
    return scored(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
