"""Language-model scores by a weighted backoff automaton of smoothed n-grams.

Tokens are lower-cased words and one end per text. States are the pairs of words
and the words that training text holds, and a root. The state (u, v) has an arc
to (v, w) for each w that training text holds behind the pair; it weighs log10
(c(u,v,w) + k p(w|v)) / (c(u,v) + k). For every other word its failure arc, of
weight log10 k / (c(u,v) + k), leads to the state (v), which has arcs and a
failure arc to the root in the same way; the root's arcs weigh the add-one log10
p(w), and a word that is no state leads back to the root. So each state's weights
sum to one. One pass from left to right carries the state, which is the longest
known end of what was read, and adds the weights of the arcs that it takes up.

Counts come from the whole training corpus by the exchange of ngrams.py: blocks
of texts send their n-grams to shards and traverse with the totals they get back.
Shards and blocks grow in number with the input, never in size.

Defined cases: null text is an empty text, of which only the end is scored; null
keys are rows like others, trained on unless `train` is false for them; repeated
rows count and score each; without training text each token weighs log10 1 / (N +
V + 1) = 0; an empty table gives an empty table; further columns are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ngrams as G
from .common import crc32_mod, table

ORDER = 3
#: The k of words' and of pairs' states, near the best of held-out text at scale factor 0.1 (perplexity 4630; 7120 with 64 and 4).
CONCENTRATION = (1000.0, 16.0)
#: Distinct n-grams of a block in a byte of text.
KEYS_PER_BYTE = 0.25


def traverse(first: np.ndarray, counts: Sequence[np.ndarray], texts: int, n: int, v: int, k: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """(root weight, automaton weight) of each token. counts: for each order, those of the n-gram that ends in the token; texts begin at `first`.

    The state before a token is what the n-gram before it leads to, so its
    visits are that n-gram's count. States that training text doesn't hold have
    no visits: their failing weighs nothing, as the state is then a shorter one.
    """
    root = np.log10((counts[0] + 1.0) / (n + v + 1.0))
    weight = root
    for below, arc, concentration in zip(counts, counts[1:], k, strict=False):
        visits = np.empty(len(arc))
        visits[1:] = below[:-1]
        visits[first[:-1]] = texts
        failing = np.log10(concentration / (visits + concentration))
        taken = np.log10((arc + concentration * 10**weight) / (visits + concentration))
        weight = np.where(arc > 0, taken, failing + weight)
    return root, weight


def scored(docs: DataFrame, train: F.Column, key: str = "doc_id", text: str = "text", concentration: Sequence[float] = CONCENTRATION) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of each text, learnt from the rows where `train` holds."""
    order = len(concentration) + 1
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(train, F.lit(True)).alias("train"))
    size, n_texts = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count_if("train")).first()
    layout = G.Layout(size, range(1, order + 1), KEYS_PER_BYTE)
    n, v = G.vocabulary(rows)
    dealt, leaf = G.dealt(rows, layout.blocks), G.summed(order)

    def keys_of(t: pa.Table) -> tuple[pa.Table, np.ndarray, list[np.ndarray], np.ndarray]:
        t = G.opened(t)
        tokens, first = G.token_stream(t.column("text"))
        return t, first, G.grams(tokens, first, order, layout.width), np.repeat(t.column("train").to_numpy(), np.diff(first))

    def ask(t: pa.Table) -> pa.Table:
        _, _, grams, weight = keys_of(t)
        keys, counts = zip(*(G.counted(g, weight) for g in grams), strict=True)
        return G.first_frames(t.column("block")[0].as_py(), list(keys), list(counts), layout)

    def score(replies: pa.Table, t: pa.Table) -> pa.Table:
        t, first, grams, _ = keys_of(t)
        counts = []
        for g, total in zip(grams, G.gathered(replies, leaf[1]), strict=True):
            counts.append(total[np.searchsorted(np.unique(g), g)])
        base, best = traverse(first, counts, n_texts, n, v, concentration)
        at = first[:-1]
        return pa.table(
            {
                "key": t.column("key"),
                "n_tokens": pa.array(np.diff(first)),
                "n_known": pa.array(np.add.reduceat((counts[0] > 0).astype(np.int64), at)),
                "train_tokens": pa.array(np.full(len(at), n)),
                "base_score": pa.array(np.add.reduceat(base, at)),
                "score": pa.array(np.add.reduceat(best, at)),
            }
        )

    asked = dealt.groupBy("block").applyInArrow(ask, f"block long, shard long, {G.FRAME}")
    replied = G.exchanged(asked, layout, leaf)
    out = replied.groupBy("block").cogroup(dealt.groupBy("block")).applyInArrow(score, f"key {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return out.withColumnRenamed("key", key)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and automaton scores of every document."""
    held = crc32_mod("doc_id", 7) == 2
    out = scored(table(spark, sf_dir, "documents"), ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
