"""Operators against brute force over small tables, SQL, exact counts and held-out labels."""

import math
import re
from collections import Counter, defaultdict
from functools import lru_cache
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import chat_format, decontamination, license_scan, lm_scoring, near_dedup, ngrams, packing, quality_model, quality_rules, secret_scan, toxicity

SF = "/root/testdata/sf0.001"
rng = np.random.default_rng(5)
BANK = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(400)]


def prose(n):
    return " ".join(rng.choice(BANK, n))


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


# --- near duplicates -------------------------------------------------------------------------------------------------


def bag(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def similarity(a, b):
    common = sum((a & b).values())
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 1.0


def all_pairs_classes(texts):
    """The smallest key of each document's component, by all pairs."""
    bags = {k: bag(t) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(sorted(texts), 2):
        small, large = sorted((sum(bags[a].values()), sum(bags[b].values())))
        if small >= 0.8 * large and similarity(bags[a], bags[b]) >= 0.8 - 1e-12:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {k: find(k) for k in texts}


def edited(text, n):
    w = text.split()
    for at in rng.choice(len(w), n, replace=False):
        w[at] = "".join(rng.choice(list("klmnop"), 7))
    return " ".join(w)


def test_near_dedup_equals_all_pairs(spark, documents):
    texts = dict(documents)
    base = prose(300)
    for k in range(60):  # a large group of variants of one text, of which many pairs are just above or below the similarity
        texts[10_000 + k] = edited(base, 1 + k % 14)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r["doc_id"]: r["class_id"] for r in near_dedup.classes(docs).collect()} == all_pairs_classes(texts)


def test_recall_just_above_the_similarity(spark):
    """Pairs of similarity 0.80 to 0.85, alone and within groups that share most of their text."""
    rows, pairs, k = [], [], 0
    for group in range(40):
        common = prose(400)
        for _ in range(5):
            mine = edited(common, 40)  # members of one group are similar to each other, by less than 0.8
            for changes in range(6, 16):
                near = edited(mine, changes)
                s = similarity(bag(mine), bag(near))
                if 0.8 <= s <= 0.85:
                    rows += [(k, mine), (k + 1, near)]
                    pairs.append((k, k + 1))
                    k += 2
                    break
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(pairs) > 150 and sum(got[a] == got[b] for a, b in pairs) == len(pairs)


# --- decontamination -------------------------------------------------------------------------------------------------

NUMBER = re.compile(r"[0-9]+(?:[.,][0-9]+)*")


@lru_cache(None)
def canonical(text, opened_by_name=False):
    """(template word, value of a slot or None, plain word) of each token."""
    out, last = [], 0
    for m in re.finditer(r"(?:[^\W_]|(?<=[0-9])[.,](?=[0-9]))+", text or ""):
        word, plain = m[0], m[0].lower()
        opening = not out or re.search(r"[.!?\n]", text[last : m.start()])
        last = m.end()
        if NUMBER.fullmatch(word):
            slot = "<number>"
        elif out and out[-1][0] == "<number>" and plain in decontamination.UNITS:
            slot = "<unit>"
        else:
            slot = "<name>" if word[0].isupper() and (not opening or (opened_by_name and not out)) else None
        out.append((slot or plain, plain if slot else None, plain))
    return out


@lru_cache(None)
def places(text):
    out, doc = defaultdict(list), canonical(text)
    for q in range(len(doc) - 4):
        out[tuple(t[0] for t in doc[q : q + 5])].append(q)
    return out


def brute_leak(text, item):
    doc, mine = canonical(text), canonical(item)
    plain = [t[2] for t in doc]
    if len(mine) < 5:
        words = [t[2] for t in mine]
        return bool(words) and (plain == words or (len(words) >= 3 and any(plain[i : i + len(words)] == words for i in range(len(plain)))))
    need = len(mine) - 4
    hits = []
    for variant in (mine, canonical(item, True)):
        for p in range(need):
            if variant is not mine and (p or variant[0] == mine[0]):
                continue
            a = variant[p : p + 5]
            for q in places(text).get(tuple(t[0] for t in a), ()):
                b = doc[q : q + 5]
                values = [(x[1], y[1]) for x, y in zip(a, b) if x[1] is not None]
                hits.append((p, q, values, len(values) < 5 or sum(x == y for x, y in values) >= 2, len(values) < 5 or all(x == y for x, y in values)))
    if not any(h[4] for h in hits):
        return False

    def holds(some, n):
        met = {v for h in some for v in h[2]}
        return 100 * n >= 50 * need and len(met) == len({x for x, _ in met})

    for s in {(h[1] - h[0]) // 8 for h in hits}:
        for pool in (s, s + 1):
            some = [h for h in hits if (h[1] - h[0]) // 8 in (pool - 1, pool)]
            if 100 * len({h[0] for h in some}) < 50 * need:
                continue
            if holds(some, len({h[0] for h in some})):
                return True
            for x in {h[1] - h[0] for h in some}:
                along = [h for h in some if h[1] - h[0] == x]
                if holds(along, len({h[0] for h in along if h[3]})):
                    return True
            chain = sorted(h for h in some if h[3])
            best = []
            for h in chain:  # the longest chain whose places rise in both, its shift changing least
                before = [b for b in best if b[1][-1][0] < h[0] and b[1][-1][1] < h[1]]
                top = max(((n - 1e-6 * abs((h[1] - h[0]) - (c[-1][1] - c[-1][0])), c) for n, c in before), key=lambda x: x[0], default=(0, []))
                best.append((top[0] + 1, [*top[1], h]))
            if best:
                chain = max(best, key=lambda x: x[0])[1]
                if holds(chain, len(chain)):
                    return True
    return False


def test_decontamination_equals_brute_force(spark, documents):
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    own = {
        900: "Compute the median of 3, 5, 7, 9, 11, 13, 15, 17, 19 and 21 please",
        901: "what is photosynthesis exactly",
        902: "Name two",
        903: "Compute the median please now",
        904: "3 14 15 92 65 35 89 79 32 38 46 26",
        905: "A train leaves Boston at 9 km from Troy and meets Ann after 12 hours",
    }
    items |= own
    texts = dict(documents)
    planted = {}
    for n, (i, t) in enumerate(own.items()):
        texts[2000 + n], texts[2100 + n], texts[2200 + n] = t, f"{prose(30)} {t} {prose(30)}", f"{prose(9)}. {t}. {prose(9)}"
        planted[i] = {2000 + n} | ({2100 + n, 2200 + n} if i != 902 else set())
    texts[2300] = own[905].replace("Boston", "Lyon").replace("12", "31")
    texts[2301] = "numbers " + " ".join(map(str, range(100, 400)))
    texts[2302] = None
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in texts.items()], "doc_id long, text string, shift int, places string")
    bench = spark.createDataFrame([*items.items(), (None, "null item text that stands here"), (999, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.leaks(docs, bench).collect()}
    for i, ids in planted.items():
        assert {d for d, x in got if x == i and 2000 <= d < 2300} == ids
    assert got == {(d, i) for d, t in texts.items() for i, x in items.items() if brute_leak(t, x)}
    assert (2300, 905) in got and not any(d == 2301 for d, _ in got)


# --- licences --------------------------------------------------------------------------------------------------------


def test_licences_equal_brute_force():
    s = license_scan.Scanner()
    lines = dict(license_scan.TEMPLATES)
    texts = [prose(120), f"{prose(40)} {lines['MIT']} {prose(40)}", f"{lines['BSD-3-Clause']}", None, ""]
    for name, line in lines.items():  # altered copies, on both sides of the coverage
        w = line.split()
        for share in (0.1, 0.2, 0.3, 0.4):
            out = list(w)
            for at in rng.choice(len(w), max(1, int(share * len(w))), replace=False):
                out[at] = rng.choice(BANK)
            texts.append(f"{prose(25)} {' '.join(out)} {prose(25)}")
    column = pa.array(texts, pa.string())
    tokens = decontamination.Tokens(column)
    want = set()
    for d in range(len(texts)):
        mine = tokens.plain[tokens.first[d] : tokens.first[d + 1]].tolist()
        for name, words in zip(s.names, s.words, strict=True):
            span = len(words) + (len(words) + 1) // 2
            if any(len(license_scan.patience(words, mine[a : a + span])) >= s.coverage * len(words) for a in range(len(mine))):
                want.add((d, name))
    assert {(r[0], r[1]) for r in s.scan(column)} == want


def test_licences_of_short_neighbours_and_long_dense_texts():
    s = license_scan.Scanner()
    line = dict(license_scan.TEMPLATES)["MIT-line"]
    half = line.split()
    got = s.scan(pa.array([" ".join(half[:2]), " ".join(half[2:]), line, "", line]))
    assert [(r[0], r[1]) for r in got] == [(2, "MIT-line"), (4, "MIT-line")]
    words = dict(license_scan.TEMPLATES)["Apache-2.0"].split()
    dense = " ".join(rng.choice(words, 6000))
    assert all(r[0] == 0 for r in s.scan(pa.array([dense])))


# --- language models -------------------------------------------------------------------------------------------------


def tokens(x):
    return re.sub("[A-Z]", lambda m: m[0].lower(), x or "").encode().split() + [b"\0end"]


def brute_kneser_ney(train, order=3):
    """P(word, the words before it) by recursion over counts of tuples."""
    counts = [Counter() for _ in range(order + 1)]
    for t in train:
        w = [b"\0start"] * (order - 1) + tokens(t)
        for at in range(order - 1, len(w)):
            for n in range(1, order + 1):
                counts[n][tuple(w[at - n + 1 : at + 1])] += 1
    adjusted = {order: dict(counts[order])}
    for n in range(1, order):
        company = Counter(g[1:] for g in counts[n + 1])
        adjusted[n] = {g: company.get(g, c) for g, c in counts[n].items()}
    cut, total, less = {}, defaultdict(int), defaultdict(float)
    for n, of in adjusted.items():
        cut[n] = quality_model.discounts([sum(c == k for c in of.values()) for k in (1, 2, 3, 4)])
        for g, c in of.items():
            total[g[:-1]] += c
            less[g[:-1]] += cut[n][min(c, 3) - 1]

    def p(word, before):
        n = len(before) + 1
        lower = p(word, before[1:]) if before else 1 / (len(adjusted[1]) + 1)
        if not total.get(before):
            return lower
        c = adjusted[n].get((*before, word), 0)
        return (c - (cut[n][min(c, 3) - 1] if c else 0)) / total[before] + less[before] / total[before] * lower

    return p


@pytest.mark.parametrize("fan_bits, shard_keys", [(ngrams.FAN_BITS, ngrams.SHARD_KEYS), (1, 100)])
def test_perplexities_equal_brute_force(spark, documents, monkeypatch, fan_bits, shard_keys):
    monkeypatch.setattr(ngrams, "FAN_BITS", fan_bits), monkeypatch.setattr(ngrams, "SHARD_KEYS", shard_keys), monkeypatch.setattr(ngrams, "BLOCK_BYTES", 4000 if fan_bits == 1 else 12 << 20)
    texts = dict(sorted(documents.items())[:12]) | {500: None, 501: "", 502: "zzz yyy", 503: None}
    train = [texts[k] for k in sorted(texts)[:5]]
    docs = spark.createDataFrame([*[(k, t, "en") for k, t in texts.items()], (None, texts[0], None)], "doc_id long, text string, lang string")
    model = spark.createDataFrame([(t,) for t in train], "text string")
    p = brute_kneser_ney(train)
    rows = quality_model.scored(docs, model, also=("lang",)).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(map(str, [*texts, None]))
    for r in rows:
        w = [b"\0start"] * 2 + tokens(texts[r["doc_id"] or 0])
        want = sum(math.log10(p(w[i], tuple(w[i - 2 : i]))) for i in range(2, len(w)))
        assert r["n_tokens"] == len(w) - 2 and abs(r["log10_prob"] - want) < 1e-5 * max(1, len(w)), r["doc_id"]
        assert abs(r["perplexity"] / 10 ** (-want / (len(w) - 2)) - 1) < 1e-4


def test_thresholds_are_quantiles(spark):
    docs = spark.createDataFrame([(k, prose(60), ("en", "fr", None)[k % 3], 5) for k in range(90)], "doc_id long, text string, lang string, threshold int")
    trusted = docs.where("doc_id < 75 and (lang <> 'fr' or lang is null)").select("doc_id")
    rows = quality_model.judged(docs, trusted).collect()
    chosen = {r["doc_id"] for r in trusted.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).collect()}
    mark = {r["doc_id"] for r in trusted.collect()} - chosen
    for lang in ("en", None, "fr"):
        known = sorted(r["perplexity"] for r in rows if r["doc_id"] in mark and (lang == "fr" or r["lang"] == lang))
        want = known[min(len(known) - 1, math.ceil(quality_model.QUANTILE * len(known)) - 1)]
        for r in rows:
            if r["lang"] == lang:
                assert r["threshold"] == want and r["kept"] == (r["perplexity"] <= want)


def test_all_trusted_texts_train(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "ROUND_BYTES", 1 << 10), monkeypatch.setattr(quality_model, "SENT_TOKENS", 5000), monkeypatch.setattr(ngrams, "SHARD_KEYS", 4000)
    texts = {k: prose(5) for k in range(4600)} | {4600: None, 4601: f"{prose(3000)} zzz"}
    docs = spark.createDataFrame([(k, t, "en") for k, t in texts.items()], "doc_id long, text string, lang string").repartition(3)
    keys = docs.select("doc_id")
    train = [r["doc_id"] for r in keys.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).collect()]
    assert len(train) > 2200
    p = brute_kneser_ney([texts[k] for k in train])
    rows = quality_model.judged(docs, keys).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        w = [b"\0start"] * 2 + tokens(texts[r["doc_id"]])
        want = sum(math.log10(p(w[i], tuple(w[i - 2 : i]))) for i in range(2, len(w)))
        assert abs(r["log10_prob"] - want) < 1e-9 * len(w), r["doc_id"]
    known = sorted(r["perplexity"] for r in rows if r["doc_id"] not in set(train))
    assert {r["threshold"] for r in rows} == {known[math.ceil(quality_model.QUANTILE * len(known)) - 1]}


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_are_exact(spark, monkeypatch, accuracy):
    monkeypatch.setattr(quality_model, "ACCURACY", accuracy)
    values = {"a": rng.normal(size=30_000), None: rng.integers(0, 40, 20_000) / 7, "b": np.array([3.0]), "c": rng.normal(size=100)}
    df = spark.createDataFrame([(k, float(x)) for k, v in values.items() for x in v], "__of string, __value double")
    for q in (0.99, 0.5):
        got = {r["__of"]: r["__own"] for r in quality_model.quantiles(df, q).collect()}
        assert got == {k: np.sort(v)[math.ceil(q * len(v)) - 1] for k, v in values.items()}


@pytest.mark.parametrize("fan_bits", [1, 2])
def test_many_levels_of_cells_give_the_same_scores(spark, documents, monkeypatch, fan_bits):
    rows = [(k, t) for k, t in sorted(documents.items())[:80]]
    docs = spark.createDataFrame([*rows, *[(7, "the same row again")] * 40, (None, "no key")], "doc_id long, text string").repartition(3)
    held = F.coalesce(F.col("doc_id") % 3 != 0, F.lit(True))
    cols = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def got():
        return sorted((str(r["doc_id"]), *(round(r[c], 6) for c in cols[1:])) for r in lm_scoring.scored(docs, held).collect())

    plain = got()
    monkeypatch.setattr(ngrams, "FAN_BITS", fan_bits), monkeypatch.setattr(ngrams, "SHARD_KEYS", 2000), monkeypatch.setattr(ngrams, "BLOCK_BYTES", 5000), monkeypatch.setattr(ngrams, "CHUNK_BYTES", 3000)
    assert got() == plain


# --- toxicity --------------------------------------------------------------------------------------------------------


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in toxicity.op4_toxicity(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").collect()
    held = [(r["toxic"], got[r["doc_id"]]["predicted"]) for r in labels if got[r["doc_id"]]["held_out"]]
    found, said, true = sum(a and b for a, b in held), sum(b for _, b in held), sum(a for a, _ in held)
    assert true and found >= 0.8 * true and found >= 0.8 * said


# --- SQL -------------------------------------------------------------------------------------------------------------


def same_rows(df, sql, **tables):
    c = duckdb.connect()
    for name, t in tables.items():
        c.register(name, t.toArrow())
    want = c.execute(sql).to_arrow_table()
    assert sorted(df.columns) == sorted(want.column_names)
    cols = sorted(df.columns)
    key = lambda r: tuple((v is None, str(v)) for v in r)
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=key) == sorted((tuple(r[c] for c in cols) for r in want.to_pylist()), key=key)


def test_quality_rules_equal_sql(spark):
    texts = [None, "", prose(30), prose(8), "same line\n" * 30 + prose(30), "# $ " * 30 + prose(20), "1 22 333 " * 10, "aa aa aa bb " * 8, "é ß ñ " * 20, "a b c " * 20, f"{prose(16)} {prose(9)}\n\n \t\nx\nx\nx\n" + prose(20)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate([*texts, texts[2]])], "doc_id long, text string, n_words int")
    same_rows(quality_rules.Cascade().judged(docs), quality_rules.ORACLE, documents=docs)
    assert set(quality_rules.Cascade().judged(docs, key="n_words").columns) >= {"n_words", "n_words_", "kept"}


def test_plan_counts_shared_measures_once(spark):
    docs = spark.createDataFrame([(i, prose(40) if i % 2 else "x y", 1) for i in range(200)], "doc_id long, text string, kept int").repartition(7)
    plan = quality_rules.Cascade().plan(docs)
    assert sorted(plan.order) == sorted(r.name for r in quality_rules.Cascade().rules) and plan.order[0] == "too_short"
    assert 0.3 < plan.rejected["too_short"] < 0.7 and all(plan.rejected[k] == 0 for k in plan.order[1:])
    assert quality_rules.Cascade().plan(docs.where("false")).order


def test_chat_equals_sql(spark):
    rows = [
        (1, 0, "u", "Hello there\nhow are you"), (1, 1, "a", "fine thanks"), (1, 2, "u", "> hello  there\nre hello"), (1, 3, "a", "next"),
        (1, 4, "u", "> re hello\n>> Hello there\nquoting two"), (1, 5, "a", "> fine thanks\nback"), (1, 6, "u", ">> how are you\nonly deep"),
        (1, 7, "u", "> nothing like it\n> > fine thanks\nshallow lines meet none"), (1, 8, "a", "> next\n> re hello\n> quoting two\nthree votes"), (1, 9, "a", "> back"),
        (2, 0, "u", None), (2, 0, "u", None), (2, 0, None, " "), (2, 3, "a", "> \nempty quote"), (None, 1, "u", "x"), (3, None, "u", "x"), (4, 1, "u", "long " * 20000 + "\nend"), (4, 2, "a", "> end\n" + "> long\n" * 3000),
    ]
    d = spark.createDataFrame([(*r, 0, "p") for r in rows], "conv_id long, turn long, role string, text string, position int, path string")
    same_rows(chat_format.formatted(d), chat_format.ORACLE, conversations=d)
    got = {(r["conv_id"], r["turn"]): r["parent"] for r in chat_format.formatted(d).collect()}
    assert got[1, 6] == 0 and got[1, 7] == 1 and got[4, 2] == 1


@pytest.mark.parametrize("conversation", [2000])
def test_chat_of_one_long_conversation(spark, conversation):
    d = spark.createDataFrame([(1, k, "u", f"line {k}\n> line {k // 2}") for k in range(conversation)], "conv_id long, turn long, role string, text string")
    same_rows(chat_format.formatted(d), chat_format.ORACLE, conversations=d)


# --- packing ---------------------------------------------------------------------------------------------------------


def test_ranges_and_rounds_pack_as_well_as_one_sweep(spark):
    lengths = Counter(np.minimum(4096, np.random.default_rng(4).lognormal(6, 1.3, 30000).astype(int) + 1).tolist())
    bound = -(-sum(n * c for n, c in lengths.items()) // 4096)
    for ranges in (1, 8):
        runs = packing.plan(spark, lengths, ranges=ranges)
        fill, placed = Counter(), Counter()
        for length, rank, n, first, sequences, offset in runs.tolist():
            placed[length] += n
            for i in range(n):
                fill[first + i % sequences] += length
                assert offset + (i // sequences + 1) * length <= 4096
        assert placed == lengths and max(fill.values()) <= 4096 and len(fill) <= 1.005 * bound + 1


# --- pipeline --------------------------------------------------------------------------------------------------------


def test_pipeline_equals_brute_force(spark, documents):
    import corpus_pipeline

    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    c = duckdb.connect()
    c.register("documents", docs.toArrow())
    kept = {r[0] for r in c.execute(f"SELECT doc_id FROM ({quality_rules.ORACLE}) WHERE kept").fetchall()}
    left = {k: t for k, t in documents.items() if k in kept}
    of = all_pairs_classes(left)
    left = {k: t for k, t in left.items() if of[k] == k}
    left = {k: t for k, t in left.items() if not any(brute_leak(t, x) for x in items.values())}
    left = {k: secret_scan.redact(t, secret_scan.spans(pa.array([t]))[0]) for k, t in left.items()}
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.vocabulary_path())
    want = {}
    for k, x in left.items():
        n = len(t.encode(x, add_special_tokens=False).ids) + 1
        want |= {(k, p): min(4096, n - lo) for p, lo in enumerate(range(0, n, 4096))}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {(r["doc_id"], r["piece"]): r["length"] for r in rows} == want and len(rows) == len(want)
    sequences = {r["sequence_id"] for r in rows}
    assert len(sequences) <= -(-sum(want.values()) // 4096) + 1


def test_pipeline_on_odd_tables(spark, tmp_path):
    import corpus_pipeline

    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(1, "what is the tallest hill that stands here")], "item_id long, text string").write.parquet(str(tmp_path / "empty/benchmark.parquet"))
    spark.createDataFrame([], kinds).write.parquet(str(tmp_path / "empty/documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "empty")).count() == 0
    good = prose(60)
    rows = [(1, good, None, None, None), (1, good, "en", "s", 1), (2, None, None, None, None), (3, "", "en", "s", 0), (None, prose(50), "en", "s", 1), (4, prose(30000), "en", "s", 1), (5, good, "fr", "s", 1)]
    spark.createDataFrame([(1, None), (None, "x")], "item_id long, text string").write.parquet(str(tmp_path / "odd/benchmark.parquet"))
    spark.createDataFrame([(*r, 1, "c") for r in rows], kinds + ", block int, kept string").write.parquet(str(tmp_path / "odd/documents.parquet"))
    got = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path / "odd")).collect())
    assert set(got) == {1, None, 4} and got[1] == 1
