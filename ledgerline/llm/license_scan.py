"""Licence notices found by patience alignment with templates.

Texts and templates are runs of letters and digits, A-Z lowered. A region of a
text can hold a notice only if enough of its words are the template's. Of the
covering share of a template's words, at least those beyond its common words
(COMMON) must be others, so windows of one and a half template lengths with that
many of the template's other words are the candidates, which loses no match. In
each, anchors are
the words unique to both sides; the longest increasing subsequence of their
places is kept; gaps between kept anchors are aligned in the same way, equal
ends first. The coverage is the aligned share of the template's words.

Defined cases: null text is an empty text without notices; of overlapping
matches of one template the best covered stays, the earliest of equals;
repeated rows are repeated; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import words as W
from .common import over_batches, table
from .decontamination import Tokens

COVERAGE = 0.75
#: Licence identifiers and notices to look for.
TEMPLATES = (
    ("Apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("MIT-line", "Released under the MIT License."),
    ("GPL-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)

#: Words that mark no template, for they fill any English text.
COMMON = "a all an and any are as at be been by can copy conditions for from has have if in is it may must no not of on one or other please that the these this those to under use was will with you your".split()


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places (i, j) of equal words, increasing in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, m, j, n = todo.pop()
        while i < m and j < n and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < m and j < n and a[m - 1] == b[n - 1]:
            m, n = m - 1, n - 1
            out.append((m, n))
        if i >= m or j >= n:
            continue
        left, right = Counter(a[i:m]), Counter(b[j:n])
        at = {w: k for k, w in enumerate(b[j:n], j) if right[w] == 1}
        pairs = [(k, at[w]) for k, w in enumerate(a[i:m], i) if left[w] == 1 and w in at]
        kept = _increasing(pairs)
        if not kept:
            continue
        out += kept
        edges = [(i - 1, j - 1), *kept, (m, n)]
        todo += [(p + 1, r, q + 1, s) for (p, q), (r, s) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence whose second members increase."""
    ends: list[int] = []
    last: list[int] = []
    before = [-1] * len(pairs)
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(ends, j)
        before[k] = last[p - 1] if p else -1
        if p == len(ends):
            ends.append(j)
            last.append(k)
        else:
            ends[p], last[p] = j, k
    out = []
    k = last[-1] if last else -1
    while k >= 0:
        out.append(pairs[k])
        k = before[k]
    return out[::-1]


class Scanner:
    def __init__(self, templates: tuple[tuple[str, str], ...] = TEMPLATES, coverage: float = COVERAGE):
        self.coverage = coverage
        self.names = [k for k, _ in templates]
        tokens = Tokens(pa.array([t for _, t in templates]))
        self.words = [tokens.plain[tokens.first[k] : tokens.first[k + 1]].tolist() for k in range(len(templates))]
        self.sets = [np.unique(np.array(w, W.U64)) for w in self.words]
        common = Tokens(pa.array([" ".join(COMMON)])).plain
        others = [np.array([w for w in words if w not in set(common.tolist())], W.U64) for words in self.words]
        need = [int(np.ceil(coverage * len(w))) for w in self.words]
        self.least = [n - (len(w) - len(o)) for n, w, o in zip(need, self.words, others, strict=True)]
        self.sets = [np.unique(o) if k > 0 else s for k, o, s in zip(self.least, others, self.sets, strict=True)]
        self.least = [k if k > 0 else n for k, n in zip(self.least, need, strict=True)]
        self.all = np.unique(np.concatenate(self.sets))

    def scan(self, column: pa.Array) -> list[tuple[int, str, float, int, int]]:
        """(row, template, coverage, first word, end word) of each notice."""
        t = Tokens(column)
        hits = np.flatnonzero(_among(self.all, t.plain))
        doc = np.searchsorted(t.first, hits, side="right") - 1
        out = []
        for k, words in enumerate(self.words):
            mine = _among(self.sets[k], t.plain[hits])
            at, of = hits[mine], doc[mine]
            need = self.least[k]
            span = len(words) + (len(words) + 1) // 2
            if len(at) < need:
                continue
            near = np.flatnonzero((at[need - 1 :] - at[: len(at) - need + 1] < span) & (of[need - 1 :] == of[: len(at) - need + 1]))
            # a notice may begin with common words before its first other word; a window belongs to one place, so each is aligned once
            low, high = t.first[of[near]], t.first[of[near] + 1]
            begin, end = np.maximum(low, at[near] - len(words) // 2), np.minimum(at[near] + span, high)
            last = np.minimum(np.searchsorted(at[near], at[near] + span), np.searchsorted(of[near], of[near], side="right"))
            known: dict[int, tuple[float, int, int]] = {}
            done = -1
            for i in range(len(near)):
                lo = int(at[near[i]])
                if lo <= done:
                    continue
                for j in range(i, int(last[i])):
                    if j not in known:
                        known[j] = self._aligned(t.plain, int(begin[j]), int(end[j]), words)
                best = max((known[j] for j in range(i, int(last[i]))), key=lambda x: (x[0], -x[1]))
                done = lo
                if best[0] >= self.coverage:
                    base = int(low[i])
                    out.append((int(of[near[i]]), self.names[k], best[0], best[1] - base, best[2] - base))
                    done = best[2] - 1
                known = {j: v for j, v in known.items() if j > i}
        return sorted(out)

    def _aligned(self, plain: np.ndarray, lo: int, hi: int, words: list) -> tuple[float, int, int]:
        pairs = patience(words, plain[lo:hi].tolist())
        if not pairs:
            return 0.0, lo, lo
        return len(pairs) / len(words), lo + pairs[0][1], lo + pairs[-1][1] + 1


def _among(values: np.ndarray, asked: np.ndarray) -> np.ndarray:
    if not len(values):
        return np.zeros(len(asked), bool)
    return values[np.minimum(np.searchsorted(values, asked), len(values) - 1)] == asked


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text", templates: tuple[tuple[str, str], ...] = TEMPLATES, coverage: float = COVERAGE) -> DataFrame:
    """(key, license, coverage, start_word, end_word): a row for each notice."""
    kind = docs.schema[key].dataType.simpleString()
    scanner = Scanner(templates, coverage)

    def scan(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = scanner.scan(batch.column(1))
        at = pa.array([r[0] for r in rows], pa.int64())
        return pa.record_batch({key: batch.column(0).take(at), "license": pa.array([r[1] for r in rows], pa.string()), "coverage": pa.array([r[2] for r in rows], pa.float64()), "start_word": pa.array([r[3] for r in rows], pa.int64()), "end_word": pa.array([r[4] for r in rows], pa.int64())})

    return over_batches(docs.select(key, text), scan, f"`{key}` {kind}, license string, coverage double, start_word long, end_word long")


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document."""
    return scanned(table(spark, sf_dir, "documents"))
