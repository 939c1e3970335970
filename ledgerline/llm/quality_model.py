"""Quality by perplexity under an interpolated modified Kneser-Ney trigram model.

The model is trained on trusted text: every whole document that labels call good and
whose key's hash is even; those with odd hashes set the thresholds. So each trusted
document serves once, whatever their number, and none sets a threshold for itself.

Counting is sharded. Workers send the distinct trigrams of some text, as places in
a list of its words, to shards by the trigrams' last two words. There their counts
meet, and a pair is counted once for each distinct word before it. Trigrams go on
to shards by their first two words, where each pair's followers meet; words are
summed over pairs in the same way. The model is a table of packed frames by shards
of the hash range, which hold whole numbers only: an n-gram's count, and of its
followers the sum of counts and how many were counted once, twice and more often.

Documents meet it by sharded count joins (ngrams.py): blocks of texts send their
distinct n-grams to shards of the hash range, which look them up in their part
of the model and reply. Discounts come from each order's counts of counts, and
blocks interpolate. N-grams that a filter of fixed size (FILTER_BITS, broadcast)
doesn't hold are in no model and stay at home; a filter that a large model fills
lets more pass, and changes no result. Large inputs are scored in ROUNDS parts, so
that blocks and frames of one part only are on disk. Every document is scored
whole. It is kept if its perplexity is at most the QUANTILE of its language's
trusted documents, those that the model was trained on left out (of all languages'
where a language has none).

Defined cases: null text is an empty text, whose only token is the end; null
languages are one language; null keys are scored like others and never trusted;
repeated rows are scored each; without trusted text all documents are kept and
their perplexity is null; an empty table gives an empty table; further columns
are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import ngrams as G
from . import words as W
from .common import arrow_limits, cleaned_up, dropped, over_batches, release, saved, table

ORDER = 3
QUANTILE = 0.99
#: Of the sketches that bound quantiles.
ACCURACY = 10_000
#: Tokens of training text that a worker counts before it sends.
SENT_TOKENS = 1_000_000
#: Distinct n-grams that are asked for, in a byte of text.
KEYS_PER_BYTE = 0.08
#: 16 MB, whatever the model's size.
FILTER_BITS, FILTER_TASKS = 27, 12
#: Parts in which documents are scored, of ROUND_BYTES of text at least.
ROUNDS, ROUND_BYTES = 4, 32 << 20
U = G.U
#: The model's fields, by their first reply: the order's index and how many replies. Words and pairs have a count and, as contexts, four sums.
FIELDS = {0: (0, 5), 5: (1, 1), 6: (1, 4), 10: (2, 1)}
PAIRS, CONTEXTS, TRIPLES = 5, 6, 10
MODEL = "field int, shard long, keys binary, columns array<binary>, of array<long>"
#: Rows that aren't in the model yet: words of pairs, trigrams by their contexts.
_WORDS, _FOLLOWED = -1, -2


def _before(values: np.ndarray, first: np.ndarray, start: object) -> np.ndarray:
    """For each token the value of the token before it; `start` for the first of a text."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[first[:-1]] = start
    return out


def _starts(width: int) -> list[np.ndarray]:
    """The n-grams of nothing but starts, for n = 1..ORDER - 1, in which a text's first token finds its contexts."""
    return [g[:1] for g in G.grams(np.full(1, G.START), np.array([0, 1]), ORDER - 1, width)]


def _pair(b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Hashes of the tokens (b, c) as ngrams.grams() makes them, in 64 bits."""
    return W.mix(W.mix(c + U(1)) * G._STEP + b + U(2))


def _rows(rows: list[tuple[int, int, bytes | None, list[bytes], list[int]]]) -> pa.Table:
    k = list(zip(*rows, strict=True)) or [()] * 5
    kinds = pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int64())
    return pa.table({name: pa.array(x, kind) for name, x, kind in zip(("field", "shard", "keys", "columns", "of"), k, kinds, strict=True)})


def _parted(field: int, keys: np.ndarray, columns: list[np.ndarray], width: int, bits: int) -> Iterator[tuple[int, int, bytes, list[bytes], list[int]]]:
    """Rows for the 2**bits shards of sorted keys."""
    bounds = np.searchsorted(keys >> U(width - bits), np.arange((1 << bits) + 1, dtype=U)) if bits else np.array([0, len(keys)])
    for s in np.flatnonzero(np.diff(bounds)).tolist():
        at = slice(bounds[s], bounds[s + 1])
        yield field, s, G.pack(np.diff(keys[at], prepend=U(0))), [G.pack(c[at]) for c in columns], []


def _opened(t: pa.Table, kinds: list[type]) -> list[np.ndarray]:
    """The keys and columns of all rows."""
    parts = [[np.cumsum(G.unpack(k, U), dtype=U), *(G.unpack(x, kind) for x, kind in zip(c, kinds, strict=True))] for k, c in zip(t.column("keys").to_pylist(), t.column("columns").to_pylist(), strict=True)]
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _new(values: np.ndarray) -> np.ndarray:
    """Where sorted values change, the first place included."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(values)), bool), values[1:] != values[:-1]]))


def _summed(counts: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Of the counts from each place on: their sum, and how many are one, two, and three or more."""
    return [np.add.reduceat(x.astype(np.int64), at) for x in (counts, counts == 1, counts == 2, counts >= 3)]


def _sent(width: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Distinct trigrams of texts for shards by their last two words: (shard, words, triples)."""
    spread = 1 << bits

    def out(held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        tokens = np.concatenate([t for t, _ in held])
        ends = np.cumsum([0] + [len(t) for t, _ in held])
        first = np.concatenate([f[:-1] + e for (_, f), e in zip(held, ends, strict=False)] + [ends[-1:]])
        words, c = np.unique(np.append(tokens, G.START), return_inverse=True)
        start, c = c[-1], c[:-1].astype(U)
        b = _before(c, first, start)
        a = _before(b, first, start)
        n = U(len(words))  # at most SENT_TOKENS and a batch, so that three fit
        codes, counts = np.unique((b * n + c) * n + a, return_counts=True)
        pairs, a = codes // n, codes % n
        at = _new(pairs)
        b, c, runs = pairs[at] // n, pairs[at] % n, np.diff(at, append=len(pairs))
        shard = (_pair(words[b], words[c]) >> U(64 - bits)).astype(np.int64) if bits else np.zeros(len(at), np.int64)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(spread + 1))
        rows = []
        for s in np.flatnonzero(np.diff(bounds)).tolist():
            mine = order[bounds[s] : bounds[s + 1]]
            run = runs[mine]
            places = np.repeat(at[mine] - np.cumsum(run) + run, run) + np.arange(run.sum())
            own, where = np.unique(np.concatenate([b[mine], c[mine], a[places]]), return_inverse=True)
            where = where.astype(np.uint32)
            k = len(mine)
            parts = [where[:k], where[k : 2 * k], run.astype(np.uint32), where[2 * k :], counts[places].astype(np.uint32)]
            rows.append((s, G.pack(np.diff(words[own], prepend=U(0))), [G.pack(x) for x in parts]))
        k = list(zip(*rows, strict=True))
        return pa.record_batch({"shard": pa.array(k[0], pa.int64()), "words": pa.array(k[1], pa.binary()), "triples": pa.array(k[2], pa.list_(pa.binary()))})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            if batch.num_rows:
                held.append(G.token_stream(batch.column(0)))
            if sum(len(t) for t, _ in held) > SENT_TOKENS:
                yield out(held)
                held.clear()
        if held:
            yield out(held)
        release()

    return send


def _spectrum(counts: np.ndarray) -> list[int]:
    """How many counts are one, two, three and four, their number, how many are three or more, and their sum."""
    return [*(int((counts == k).sum()) for k in (1, 2, 3, 4)), len(counts), int((counts >= 3).sum()), int(counts.sum())]


def trained(texts: DataFrame, layout: G.Layout, text: str = "text") -> tuple[DataFrame, np.ndarray] | None:
    """The model as rows of MODEL for the layout's shards, and for each order the numbers of n-grams that were counted once to four
    times, of all, of those counted three times or more, and their counts' sum. None without texts."""
    width, bits = layout.width, max(0, layout.bits - 1)
    arrow_limits(texts.sparkSession)

    def pairs(t: pa.Table) -> pa.Table:
        got: list[tuple[np.ndarray, ...]] = []
        for blob, parts in zip(t.column("words").to_pylist(), t.column("triples").to_pylist(), strict=True):
            words = np.cumsum(G.unpack(blob, U), dtype=U)
            b, c, run, a, count = (G.unpack(x, np.uint32) for x in parts)
            b, c = np.repeat(words[b], run), np.repeat(words[c], run)
            a, cut, pair = words[a], U(64 - width), _pair(b, c)
            triple = W.mix(pair * G._STEP + a + U(3)) >> cut
            got.append((triple, pair >> cut, _pair(a, b) >> cut, W.mix(b + U(1)), W.mix(c + U(1)), count))
        triple, pair, context, b, c, count = (np.concatenate(x) for x in zip(*got, strict=True))
        got.clear()
        order = np.lexsort((triple, pair))
        triple, pair, context, b, c, count = (x[order] for x in (triple, pair, context, b, c, count))
        at = _new(triple)
        count = np.add.reduceat(count.astype(np.int64), at)
        triple, pair, context, b, c = (x[at] for x in (triple, pair, context, b, c))
        at = _new(pair)
        company = np.diff(at, append=len(pair))
        words, where = np.unique(np.concatenate([c[at], b[at]]), return_inverse=True)
        k = len(at)
        sums = [np.bincount(where[:k], minlength=len(words))]
        sums += [np.bincount(where[k:], weights=x, minlength=len(words)).astype(np.int64) for x in (company, company == 1, company == 2, company >= 3)]
        order = np.argsort(context)
        rows = [*_parted(PAIRS, pair[at], [company], width, layout.bits), *_parted(_WORDS, words, sums, 64, bits)]
        rows += _parted(_FOLLOWED, context[order], [triple[order], count[order]], width, bits)
        return _rows([*rows, (1, -1, None, [], _spectrum(company)), (2, -1, None, [], _spectrum(count))])

    def contexts(t: pa.Table) -> pa.Table:
        if t.column("field")[0].as_py() == _WORDS:
            words, *sums = _opened(t, [np.int64] * 5)
            order = np.argsort(words)
            at = _new(words[order])
            sums = [np.add.reduceat(x[order], at) for x in sums]
            seen = sums[0][sums[0] > 0]  # all but starts
            return _rows([*_parted(0, words[order][at], sums, 64, layout.bits), (0, -1, None, [], _spectrum(seen))])
        context, triple, count = _opened(t, [U, np.int64])
        order = np.argsort(context)
        at = _new(context[order])
        rows = [*_parted(CONTEXTS, context[order][at], _summed(count[order], at), width, layout.bits)]
        order = np.argsort(triple)
        return _rows([*rows, *_parted(TRIPLES, triple[order], [count[order]], width, layout.bits)])

    sent = texts.select(text).mapInArrow(_sent(width, bits), "shard long, words binary, triples array<binary>")
    with cleaned_up(texts.sparkSession):
        grams = saved(sent.groupBy("shard").applyInArrow(pairs, MODEL), "grams")
        model = saved(grams.where("field < 0").groupBy("field", "shard").applyInArrow(contexts, MODEL).unionByName(grams.where("field >= 0")), "model")
    dropped(grams)
    of = np.zeros((ORDER, 7), np.int64)
    for r in model.where("shard < 0").groupBy("field").agg(*(F.sum(F.col("of")[k]).alias(f"k{k}") for k in range(7))).collect():
        of[r["field"]] = r[1:]
    if not of[0, 4]:
        dropped(model)
        return None
    return model.where("shard >= 0").drop("of"), of


def discounts(n: list[int]) -> tuple[float, float, float]:
    """What counts of one, two, and three or more lose, from the numbers of n-grams that were counted once to four times."""
    n1, n2, n3, n4 = (max(k, 1) for k in n)
    y = n1 / (n1 + 2 * n2)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3)))


def _bits(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the filter that each key sets."""
    x = W.mix(keys ^ U(0xA5A5_1234_5A5A_4321))
    return x >> U(64 - FILTER_BITS), (x >> U(4)) & U((1 << FILTER_BITS) - 1)


def membership(rows: DataFrame, keys: Callable[[pa.RecordBatch], Iterable[np.ndarray]]) -> np.ndarray:
    """A filter of the keys of rows, as words of 64 bits. FILTER_TASKS at most make one each, so that what is exchanged is bounded, too."""
    size = 1 << FILTER_BITS - 6
    step = max(1, size // 64)
    arrow_limits(rows.sparkSession)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size, U)
        for batch in batches:
            for k in keys(batch):
                for at in _bits(k):
                    np.bitwise_or.at(out, at >> U(6), U(1) << (at & U(63)))
        for k in range(0, size, step):
            part = out[k : k + step]
            if part.any():
                yield pa.record_batch({"place": pa.array([k], pa.int64()), "words": pa.array([G.pack(part)])})
        release()

    def merged(t: pa.Table) -> pa.Table:
        words = np.bitwise_or.reduce([G.unpack(x, U) for x in t.column("words").to_pylist()])
        return pa.table({"place": t.column("place").slice(0, 1), "words": pa.array([G.pack(words)])})

    kinds = "place long, words binary"
    out = np.zeros(size, U)
    with cleaned_up(rows.sparkSession):
        got = rows.coalesce(FILTER_TASKS).mapInArrow(marks, kinds).groupBy("place").applyInArrow(merged, kinds).toArrow()
    for r in got.to_pylist():
        out[r["place"] : r["place"] + step] = G.unpack(r["words"], U)
    return out


def may_hold(filter_: np.ndarray, keys: np.ndarray) -> np.ndarray:
    one, two = _bits(keys)
    return ((filter_[one >> U(6)] >> (one & U(63))) & (filter_[two >> U(6)] >> (two & U(63))) & U(1)).astype(bool)


def discounted(counts: np.ndarray, cut: tuple[float, float, float]) -> np.ndarray:
    """Counts less their discounts; 0 stays."""
    return counts - np.array([0.0, *cut])[np.minimum(counts, 3)]


def scored(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", also: tuple[str, ...] = ()) -> DataFrame:
    """(key, also..., n_tokens, log10_prob, perplexity) of each document under the model of the trusted texts."""
    types = dict(docs.dtypes)
    rows = docs.select(F.col(key).alias("__key"), F.col(text).alias("__text"), *(F.col(a).alias(f"__{k}") for k, a in enumerate(also)))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("__text")), F.lit(0))).first()[0]
    layout = G.Layout(size, range(1, ORDER + 1), KEYS_PER_BYTE)
    width = layout.width
    model = trained(trusted, layout, text)
    named = {"__key": key, **{f"__{k}": a for k, a in enumerate(also)}}
    if model is None:
        tokens = F.size(F.filter(F.split(F.coalesce("__text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")) + 1
        nothing = (F.lit(None).cast("double").alias(c) for c in ("log10_prob", "perplexity"))
        return rows.select(*named, tokens.cast("long").alias("n_tokens"), *nothing).withColumnsRenamed(named)
    entries, of = model
    rounds = int(max(1, min(ROUNDS, size // ROUND_BYTES)))
    layout.blocks = -(-4 * layout.blocks // rounds)  # a quarter of the usual size, as n-grams get more replies here
    leaf = G.looked_up(entries, FIELDS)
    spec = leaf[1]
    starts = _starts(width)
    cut = [discounts(k[:4].tolist()) for k in of]
    vocabulary, total = int(of[0, 4]), float(of[0, 6])
    all_rest = float(np.dot(cut[0], of[0, [0, 1, 5]])) / total
    known = docs.sparkSession.sparkContext.broadcast(membership(entries.select("keys"), lambda batch: (np.cumsum(G.unpack(k, U), dtype=U) for k in batch.column(0).to_pylist())))

    def read(t: pa.Table) -> tuple[pa.Table, np.ndarray, list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        t = G.opened(t)
        tokens, first = G.token_stream(t.column("__text"))
        grams = G.grams(tokens, first, ORDER, width)
        some = [may_hold(known.value, g) for g in grams]
        asked = [np.unique(np.concatenate([g[m], *starts[n : n + 1]])) for n, (g, m) in enumerate(zip(grams, some, strict=True))]
        return t, first, grams, some, asked

    def ask(t: pa.Table) -> pa.Table:
        keys = read(t)[-1]
        release()
        return G.first_frames(t.column("block")[0].as_py(), keys, [np.zeros(len(k), np.int64) for k in keys], layout)

    def score(replies: pa.Table, t: pa.Table) -> pa.Table:
        t, first, grams, some, asked = read(t)
        got = G.gathered(replies, spec)
        p = np.full(len(grams[0]), 1.0 / (vocabulary + 1))
        sums, left = np.full(len(p), total), np.full(len(p), all_rest)
        for n, count in enumerate((got[0], got[5], got[10])):
            at = np.searchsorted(asked[n], grams[n][some[n]])
            grams[n] = None
            p *= left
            p[some[n]] += discounted(count, cut[n])[at] / sums[some[n]]
            if n < ORDER - 1:
                weight, one, two, more = got[5 * n + 1 : 5 * n + 5]
                rest = (cut[n + 1][0] * one + cut[n + 1][1] * two + cut[n + 1][2] * more) / np.maximum(weight, 1)
                rest[weight == 0] = 1.0  # no context: nothing is its share
                start = np.searchsorted(asked[n], starts[n][0])
                sums.fill(1.0), left.fill(1.0)
                sums[some[n]], left[some[n]] = np.maximum(weight, 1)[at], rest[at]
                sums, left = _before(sums, first, max(weight[start], 1)), _before(left, first, rest[start])
        total_log = np.add.reduceat(np.log10(p), first[:-1])
        count = np.diff(first)
        release()
        return pa.table({**{c: t.column(c) for c in named}, "n_tokens": pa.array(count), "log10_prob": pa.array(total_log), "perplexity": pa.array(10 ** (-total_log / count))})

    kinds = ", ".join(f"`{c}` {types[named[c]]}" for c in named)

    def part(k: int) -> DataFrame:
        mine = rows if rounds == 1 else rows.where(F.pmod(F.xxhash64("__key", "__text"), F.lit(rounds)) == k)
        dealt = G.dealt(mine, layout.blocks)
        asked = dealt.groupBy("block").applyInArrow(ask, f"block long, shard long, {G.FRAME}")
        return G.exchanged(asked, layout, leaf).groupBy("block").cogroup(dealt.groupBy("block")).applyInArrow(score, f"{kinds}, n_tokens long, log10_prob double, perplexity double")

    with cleaned_up(docs.sparkSession):
        parts = [saved(part(k), "perplexities") for k in range(rounds)]
    dropped(entries)
    known.unpersist()
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out.withColumnsRenamed(named)


def _among(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose __id is among ids. What a filter of fixed size holds out isn't shuffled."""
    keys = lambda batch: [batch.column(0).to_numpy().view(U)]
    known = rows.sparkSession.sparkContext.broadcast(membership(ids.select(F.xxhash64("__id")), keys))

    @F.arrow_udf("boolean")
    def may_be(key: pa.Array) -> pa.Array:
        return pa.array(may_hold(known.value, key.to_numpy(zero_copy_only=False).view(U)))

    return rows.where(may_be(F.xxhash64("__id"))).join(ids, "__id", "left_semi")


def quantiles(values: DataFrame, q: float) -> DataFrame:
    """(__of, __own): for each __of the smallest __value that at least a share q of its values don't exceed, exactly.

    Sketches bound where it lies; values below the bounds are counted, and only those within are ranked.
    """
    sketched = ((max(0.0, q - 4 / ACCURACY), "__low"), (min(1.0, q + 4 / ACCURACY), "__high"))
    bounds = values.groupBy(F.col("__of").alias("__group")).agg(*(F.percentile_approx("__value", p, ACCURACY).alias(c) for p, c in sketched), F.count("__value").alias("__n"))
    met = values.join(bounds, F.col("__of").eqNullSafe(F.col("__group"))).where("__value <= __high")
    counted = met.groupBy("__of", "__n", F.when(F.col("__value") >= F.col("__low"), F.col("__value")).alias("__value")).agg(F.count("*").alias("__k"))
    rank = F.sum("__k").over(Window.partitionBy("__of").orderBy(F.col("__value").asc_nulls_first()))
    return counted.withColumn("__rank", rank).where(F.col("__rank") >= F.lit(q) * F.col("__n")).groupBy("__of").agg(F.min("__value").alias("__own"))


def judged(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """scored() with each language's threshold and kept; trusted: keys of trusted documents."""
    ids = trusted.where(F.col(key).isNotNull()).select(F.col(key).alias("__id")).distinct()
    half = F.pmod(F.xxhash64("__id"), F.lit(2)) == 0  # the model is made of one half, so that thresholds have documents, too
    texts = _among(docs.select(F.col(key).alias("__id"), F.col(text).alias(text)), ids.where(half))
    out = scored(docs, texts, key, text, (lang,))
    mark = ids.where(~half)
    known = saved(out.join(mark, out[key] == mark["__id"], "left_semi").select(F.col(lang).alias("__of"), F.col("perplexity").alias("__value")), "known")
    mine = quantiles(known, QUANTILE).withColumnRenamed("__of", "__lang")
    every = quantiles(known.withColumn("__of", F.lit(0)), QUANTILE).first()
    threshold = F.coalesce(F.col("__own"), F.lit(every and every["__own"]).cast("double"))
    return out.join(mine, F.col(lang).eqNullSafe(F.col("__lang")), "left").select(*out.columns, threshold.alias("threshold"), F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("kept"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's perplexity and whether its language's threshold keeps it."""
    trusted = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    return judged(table(spark, sf_dir, "documents"), trusted)
