"""Quality rules as a short-circuit cascade.

Every rule compares measures of a text. On a bounded sample the cost of each
measure (seconds a document) and each rule's rejections are noted; the next rule
is always the one with the most rejections, among the documents that the rules
before it kept, per cost of the measures that those didn't make. A rule sees only
the documents that all rules before it kept. The order changes the cost alone: a
document is kept if no rule rejects it, in whatever order.

Defined cases: null text is an empty text; a text without words has zero for
each measure and is rejected by the base check (fewer than 20 words); ties in
rejection per cost keep the rules' given order; repeated rows are judged row
by row; an empty table gives an empty table; further columns pass through keep();
judged() adds a `_` to a column of its own that is named like the key.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from . import words as W
from .common import arrow_limits, over_batches, table

#: Documents of the sample on which cost and selectivity are measured, and the partitions that they come from.
SAMPLE_DOCS, SAMPLE_PARTITIONS = 1000, 50
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30
SYMBOLS = b"#*$%&|<>"


class Batch:
    """Documents of a batch with measures that are made once, when first asked for."""

    def __init__(self, b: np.ndarray, offsets: np.ndarray):
        self.b, self.offsets, self._have = b, offsets, {}

    @classmethod
    def of(cls, column: pa.Array) -> Batch:
        return cls(*W.buffers(column))

    def take(self, keep: np.ndarray) -> Batch:
        lengths = np.diff(self.offsets)
        out = Batch(self.b[np.repeat(keep, lengths)], np.concatenate([[0], np.cumsum(lengths[keep])]))
        if "words" in self._have:
            w = self._have["words"]
            chosen = np.repeat(keep, w.counts)
            shift = (self.offsets[:-1][keep] - out.offsets[:-1]).repeat(w.counts[keep])
            out._have["words"] = W.Words(w.hash[chosen], w.start[chosen] - shift, w.end[chosen] - shift, np.concatenate([[0], np.cumsum(w.counts[keep])]))
        for k, v in self._have.items():
            if k != "words":
                out._have[k] = v[keep]
        return out

    def get(self, name: str) -> np.ndarray:
        if name not in self._have:
            self._have[name] = MEASURES[name](self)
        return self._have[name]

    @property
    def words(self) -> W.Words:
        if "words" not in self._have:
            self._have["words"] = W.words(self.b, self.offsets)
        return self._have["words"]

    def bytes_in(self, flags: np.ndarray) -> np.ndarray:
        return W.per_doc(flags, self.offsets)


def _flagged(values: bytes) -> np.ndarray:
    table_ = np.zeros(256, bool)
    table_[list(values)] = True
    return table_


_SYMBOL, _DIGIT = _flagged(SYMBOLS), _flagged(b"0123456789")
_LETTER = _flagged(bytes([*range(65, 91), *range(97, 123), *range(0xC2, 0xF5)]))


def _word_chars(x: Batch) -> np.ndarray:
    return x.bytes_in(W.code_points(x.b) & ~W.SPACE[x.b])


def _lines(x: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and word count of each \\n-split line that has a word."""
    hashes, docs, counts = [], [], []
    for i, j in W.pieces(x.offsets):
        lo, hi = int(x.offsets[i]), int(x.offsets[j])
        part = x.b[lo:hi]
        starts = np.unique(np.concatenate([x.offsets[i:j] - lo, np.flatnonzero(part == 10) + 1]))
        starts = starts[starts < hi - lo]
        if not len(starts):
            continue
        ends = np.append(starts[1:], hi - lo)
        ends = np.where((part[ends - 1] == 10) & (ends > starts), ends - 1, ends)
        first = np.searchsorted(x.words.start, starts + lo)
        n = np.searchsorted(x.words.start, ends + lo) - first
        some = n > 0
        starts, ends = starts[some], ends[some]
        if hi - lo > 4 * W.CHUNK:  # one very long text: no tables as long as it
            body = part.tobytes()
            hashes.append(np.fromiter((hash(body[s:e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)), np.int64, len(starts)).astype(W.U64))
        else:
            hashes.append(W.span_hash(W.prefix_hash(part), starts, ends))
        docs.append(np.searchsorted(x.offsets, starts + lo, side="right") - 1)
        counts.append(n[some])
    if not hashes:
        return np.zeros(0, W.U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(docs), np.concatenate(counts)


def _line_measures(x: Batch) -> None:
    n = len(x.offsets) - 1
    h, doc, count = _lines(x)
    order = np.lexsort((h, doc))
    h, doc, count = h[order], doc[order], count[order]
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (doc[1:] == doc[:-1])
    x._have["n_lines"] = np.bincount(doc, minlength=n)
    x._have["n_dup_lines"] = np.bincount(doc[again], minlength=n)
    x._have["dup_line_words"] = np.bincount(doc[again], weights=count[again], minlength=n).astype(np.int64)


def _from_lines(name: str) -> Callable[[Batch], np.ndarray]:
    def measure(x: Batch) -> np.ndarray:
        _line_measures(x)
        return x._have[name]

    return measure


def _repeat_words(x: Batch) -> np.ndarray:
    """Words in 8-word windows that are found twice or more in the text, the first included."""
    w = x.words
    h, at = W.windows(w, WINDOW)
    if not len(h):
        return np.zeros(len(x.offsets) - 1, np.int64)
    key = W.mix(h ^ (w.doc[at].astype(W.U64) * W.U64(0x9E3779B97F4A7C15)))
    order = np.argsort(key)
    k = key[order]
    same = k[1:] == k[:-1]
    twice = np.zeros(len(k), bool)
    twice[1:] |= same
    twice[:-1] |= same
    begin = at[order[twice]]
    step = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(step, begin, 1)
    np.add.at(step, begin + WINDOW, -1)
    return W.per_doc(np.cumsum(step[:-1]) > 0, w.first)


def _stutter(x: Batch) -> np.ndarray:
    """Words equal to the word before them."""
    w = x.words
    same = np.zeros(len(w.hash), bool)
    same[1:] = w.hash[1:] == w.hash[:-1]
    same[w.first[:-1][w.counts > 0]] = False
    return W.per_doc(same, w.first)


MEASURES: dict[str, Callable[[Batch], np.ndarray]] = {
    "n_words": lambda x: x.words.counts,
    "word_chars": _word_chars,
    "n_symbols": lambda x: x.bytes_in(_SYMBOL[x.b]),
    "n_letters": lambda x: x.bytes_in(_LETTER[x.b]),
    "n_digits": lambda x: x.bytes_in(_DIGIT[x.b]),
    "n_lines": _from_lines("n_lines"),
    "n_dup_lines": _from_lines("n_dup_lines"),
    "dup_line_words": _from_lines("dup_line_words"),
    "n_repeat_words": _repeat_words,
    "n_stutter": _stutter,
}


@dataclass(frozen=True)
class Rule:
    """Rejects the documents for which 100 * top > percent * bottom (of the batch's measures)."""

    name: str
    rejects: Callable[[Batch], np.ndarray] = field(compare=False)


def _over(top: str, percent: int, bottom: str) -> Callable[[Batch], np.ndarray]:
    return lambda x: 100 * x.get(top) > percent * x.get(bottom)


#: Base checks of the contract, as rules of the cascade.
BASE = (
    Rule("too_short", lambda x: x.get("n_words") < MIN_WORDS),
    Rule("repeated_windows", _over("n_repeat_words", MAX_REPEAT_PERCENT, "n_words")),
)
#: Rules beside them. All limits are whole numbers, so that any engine gives the same verdict.
RULES = (
    Rule("symbols", _over("n_symbols", 10, "n_words")),
    Rule("long_words", _over("word_chars", 1500, "n_words")),
    Rule("short_words", lambda x: 10 * x.get("word_chars") < 22 * x.get("n_words")),
    Rule("few_letters", lambda x: 100 * x.get("n_letters") < 45 * x.get("word_chars")),
    Rule("digits", _over("n_digits", 50, "word_chars")),
    Rule("stutter", _over("n_stutter", 20, "n_words")),
    Rule("duplicate_lines", lambda x: (x.get("n_dup_lines") >= 3) & (100 * x.get("dup_line_words") > 30 * x.get("n_words"))),
)


class Timed(Batch):
    """A batch that notes how long each measure took by itself, and which others it used."""

    def __init__(self, b: np.ndarray, offsets: np.ndarray):
        super().__init__(b, offsets)
        self.seconds: dict[str, float] = {}
        self.uses: dict[str, set[str]] = {}
        self._open: list[tuple[str, float]] = []

    def _note(self, name: str, make: Callable[[], object]) -> object:
        for above, _ in self._open[-1:]:
            self.uses.setdefault(above, set()).add(name)
        if name in self._have:
            return self._have[name]
        self._open.append((name, 0.0))
        began = time.perf_counter()
        out = make()
        took = time.perf_counter() - began
        _, inner = self._open.pop()
        self.seconds[name] = took - inner
        if self._open:
            above, before = self._open[-1]
            self._open[-1] = (above, before + took)
        return out

    def get(self, name: str) -> np.ndarray:
        return self._note(name, lambda: Batch.get(self, name))

    @property
    def words(self) -> W.Words:
        return self._note("words", lambda: Batch.words.fget(self))

    def asked_by(self, rule: Rule) -> set[str]:
        """All measures that a rule needs, those of its measures included."""
        self._open.append((rule.name, 0.0))
        rule.rejects(self)
        self._open.pop()
        out, todo = set(), [rule.name]
        while todo:
            new = self.uses.get(todo.pop(), set()) - out
            out |= new
            todo += new
        return out


@dataclass(frozen=True)
class Plan:
    order: tuple[str, ...]
    #: Seconds a document of each measure, and the share that each rule rejects of the documents that come to it in that order.
    cost: dict[str, float] = field(compare=False)
    rejected: dict[str, float] = field(compare=False)


class Cascade:
    """The rules in an order measured on a sample, applied to whole texts."""

    def __init__(self, rules: Sequence[Rule] = (*BASE, *RULES), sample_docs: int = SAMPLE_DOCS):
        self.rules, self.sample_docs = tuple(rules), sample_docs

    def plan(self, docs: DataFrame, text: str = "text", given: Sequence[Rule] = ()) -> Plan:
        """The order of the rules behind those `given`, from about sample_docs documents.

        SAMPLE_PARTITIONS partitions, spread evenly, draw documents at random from their
        first batch and judge them where they are; only verdicts and times leave them.
        """
        rules, known = self.rules, (*given, *self.rules)
        n = docs.rdd.getNumPartitions()
        step = max(1, n // SAMPLE_PARTITIONS)
        each = -(-self.sample_docs // max(1, -(-n // step)))

        def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            if part % step:
                return
            for batch in batches:
                if not batch.num_rows:
                    continue
                at = np.random.default_rng(part).permutation(batch.num_rows)[:each]
                column = batch.column(0).take(pa.array(np.sort(at)))
                Batch.of(column).words  # noqa: B018  warms up the tables of powers
                x = Timed(*W.buffers(column))
                bad = np.stack([r.rejects(x) for r in known], 1)
                names = sorted(x.seconds)
                yield pa.record_batch({"bad": pa.array(bad.tolist(), pa.list_(pa.bool_())), "names": pa.array([names] * len(bad), pa.list_(pa.string())), "s": pa.array([[x.seconds[k] / len(bad) for k in names]] * len(bad), pa.list_(pa.float64()))})
                return

        arrow_limits(docs.sparkSession)
        rows = docs.select(text).mapInArrow(measured, "bad array<boolean>, names array<string>, s array<double>").collect()  # about sample_docs rows
        cost: dict[str, float] = {}
        for r in rows:
            for name, s in zip(r["names"], r["s"], strict=True):
                cost[name] = cost.get(name, 0.0) + s / len(rows)
        bad = np.array([r["bad"] for r in rows], bool).reshape(-1, len(known))
        nothing = Timed(np.zeros(0, np.uint8), np.zeros(1, np.int64))
        needs = {r.name: nothing.asked_by(r) for r in known}
        have = set().union(*(needs[r.name] for r in given)) if given else set()
        left = ~bad[:, : len(given)].any(1)
        order, rejected, waiting = [], {}, list(range(len(given), len(known)))
        while waiting:  # the next rule is the one that rejects most of what is left, per second of the measures that aren't made yet
            share = {k: float(bad[left, k].mean()) if left.any() else 0.0 for k in waiting}
            seconds = {k: sum(cost.get(m, 0.0) for m in needs[known[k].name] - have) for k in waiting}
            best = max(waiting, key=lambda k: (share[k] / max(seconds[k], 1e-9), -k))
            waiting.remove(best)
            order.append(known[best].name)
            rejected[known[best].name] = share[best]
            have |= needs[known[best].name]
            left &= ~bad[:, best]
        return Plan(tuple(order), cost, rejected)

    def verdict(self, x: Batch, order: Sequence[str]) -> np.ndarray:
        """True for the documents that every rule keeps; each rule sees only what is left."""
        by_name = {r.name: r for r in self.rules}
        left = np.arange(len(x.offsets) - 1)
        for name in order:
            if not len(left):
                break
            good = ~by_name[name].rejects(x)
            if not good.all():
                left, x = left[good], x.take(good)
        return left

    def keep(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """The documents that pass, with all their columns."""
        order = self.plan(docs, text).order
        at = docs.columns.index(text)

        def kept(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.take(pa.array(self.verdict(Batch.of(batch.column(at)), order)))

        return over_batches(docs, kept, docs.schema)

    def judged(self, docs: DataFrame, key: str = "doc_id", text: str = "text", measures: Sequence[str] = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) -> DataFrame:
        """A row per document: the key, the named measures, base_failed and kept."""
        rest = Cascade([r for r in self.rules if r not in BASE], self.sample_docs)
        order = rest.plan(docs, text, BASE).order
        kind = docs.schema[key].dataType.simpleString()
        name = {m: f"{m}_" if m == key else m for m in (*measures, "base_failed", "kept")}

        def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = Batch.of(batch.column(1))
            values = {name[m]: pa.array(x.get(m).astype(np.int64)) for m in measures}
            failed = np.zeros(batch.num_rows, bool)
            for r in BASE:
                failed |= r.rejects(x)
            kept = np.zeros(batch.num_rows, bool)
            some = np.flatnonzero(~failed)
            kept[some[rest.verdict(x.take(~failed), order)]] = True
            return pa.record_batch({key: batch.column(0), **values, name["base_failed"]: pa.array(failed), name["kept"]: pa.array(kept)})

        return over_batches(docs.select(key, text), judge, f"`{key}` {kind}, {', '.join(f'{name[m]} long' for m in measures)}, {name['base_failed']} boolean, {name['kept']} boolean")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and the cascade's verdict for each document."""
    return Cascade().judged(table(spark, sf_dir, "documents"))


#: The same rows by DuckDB.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), word AS (
  SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS p FROM d
), eight AS (
  SELECT r, unnest(range(1, len(w) - 6)) AS p, w FROM d WHERE len(w) >= 8
), again AS (
  SELECT r, unnest(list(p)) AS p FROM (SELECT r, p, array_to_string(w[p : p + 7], ' ') AS x FROM eight) GROUP BY r, x HAVING count(*) > 1
), repeated AS (
  SELECT r, count(*) AS n_repeat_words FROM (SELECT DISTINCT r, p + unnest(range(0, 8)) AS p FROM again) GROUP BY r
), stutter AS (
  SELECT r, count(*) AS n_stutter FROM (SELECT r, w = lag(w) OVER (PARTITION BY r ORDER BY p) AS same FROM word) WHERE same GROUP BY r
), line AS (
  SELECT r, unnest(string_split(text, chr(10))) AS l FROM d
), lines AS (
  SELECT r, count(*) - 1 AS again, (count(*) - 1) * any_value(len(list_filter(regexp_split_to_array(l, '[\x20\x09-\x0D]+'), lambda x: x <> ''))) AS words
  FROM line WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r, l
), dup AS (
  SELECT r, sum(again) :: BIGINT AS n_dup_lines, sum(words) :: BIGINT AS dup_line_words FROM lines GROUP BY r
), m AS (
  SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_words, 0) AS dup_line_words, coalesce(n_stutter, 0) AS n_stutter,
    length(regexp_replace(text, '[^A-Za-z\x{80}-\x{10FFFF}]', '', 'g')) AS n_letters, length(regexp_replace(text, '[^0-9]', '', 'g')) AS n_digits
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN stutter USING (r) LEFT JOIN dup USING (r)
), f AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * word_chars > 1500 * n_words OR 10 * word_chars < 22 * n_words OR 100 * n_letters < 45 * word_chars
    OR 100 * n_digits > 50 * word_chars OR 100 * n_stutter > 20 * n_words OR (n_dup_lines >= 3 AND 100 * dup_line_words > 30 * n_words)) AS kept
FROM f
"""
