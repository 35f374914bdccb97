"""License scans by patience alignment of texts with license templates.

Words are normalised as in ``decontam`` (A-Z lower-cased, other ASCII than letters and digits separates).  For a template
of m words and a share ``coverage`` of them to be found:

1. *Filter*: a text whose words, counted with multiplicity, share fewer than ``coverage * m`` words with the template
   can't reach it.  This is an upper bound, so nothing is lost; it is one matrix operation per block of texts.
2. *Places*: the template's rarest words in this text, together more than ``(1 - coverage) * m`` of its positions.  A copy
   that misses none or few words must hold one of them, so each occurrence proposes a range of the text.
3. *Alignment* of the range (:func:`patience`): words that occur once in both sides are anchors; the longest increasing
   subsequence of their places is kept; the gaps between anchors are aligned in the same way, equal words at the ends
   of a gap first.  Coverage is the share of template words aligned.
4. *Whole text*: the most template words that the text holds in order (:func:`most_in_order`) bounds every alignment.
   Where the ranges stay below it, the shortest range that reaches it is taken (:func:`shortest_range`), whatever was
   inserted between the words, so coverage is always that of the whole text.

Per document: the template of highest coverage (ties: first in the list, then first in the text), its place in UTF-8
bytes of the original, and all templates found.  Templates found in a range of step 2 rank before those whose words
only align over wider gaps.

Defined cases: null and empty texts have no license; repeated rows are each reported; an empty template is refused;
further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .decontam import WORD, words_of

COVERAGE, SLACK = 0.8, 0.25
# Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "MIT": "Released under the MIT License",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "Apache-2.0 notice": "You may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "MIT grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                 "documentation files, to deal in the Software without restriction",
    "BSD conditions": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                      "the following conditions are met",
    "GPL notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "ISC grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}


def longest_increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing subsequence."""
    tails: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        back.append(at[k - 1] if k else -1)
        if k == len(tails):
            tails.append(v)
            at.append(i)
        else:
            tails[k], at[k] = v, i
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned index pairs of two word sequences, ascending in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i >= j or k >= m:
            continue
        ca, cb = Counter(a[i:j]), Counter(b[k:m])
        once = {w: q for q, w in enumerate(b[k:m], k) if cb[w] == 1 and ca.get(w) == 1}
        anchors = [(p, once[a[p]]) for p in range(i, j) if a[p] in once]
        kept = [anchors[x] for x in longest_increasing([q for _, q in anchors])]
        out += kept
        for (p, q), (r, s) in zip([(i - 1, k - 1), *kept], [*kept, (j, m)]):
            if kept and p + 1 < r and q + 1 < s:
                todo.append((p + 1, r, q + 1, s))
    return sorted(out)


def most_in_order(words: list[int], template: list[int]) -> int:
    """Length of a longest common subsequence, one bit per template word."""
    full = (1 << len(template)) - 1
    at: dict[int, int] = {}
    for j, w in enumerate(template):
        at[w] = at.get(w, 0) | 1 << j
    open_ = full
    for w in words:
        if w in at:
            hit = open_ & at[w]
            open_ = (open_ + hit | open_ - hit) & full
    return len(template) - open_.bit_count()


def shortest_range(words: list[int], template: list[int], most: int) -> tuple[int, int]:
    """First and last text word of the shortest range (the first of them) that holds ``most`` template words in order.

    ``most`` is the greatest number, so the alignments that lead to it have the greatest number at each of their words.
    """
    at: dict[int, list[int]] = {}
    for j, w in enumerate(template):
        at.setdefault(w, []).insert(0, j)
    best = [(0, 0)] * len(template)  # words aligned up to this template word, and the latest start of such an alignment
    found = None
    for p, w in enumerate(words):
        for j in at.get(w, ()):
            count, start = max(best[:j], default=(0, 0))
            reached = (count + 1, start if count else p)
            best[j] = max(best[j], reached)
            if reached[0] == most and (found is None or p - reached[1] < found[1] - found[0]):
                found = (reached[1], p)
    return found


class Scanner:
    def __init__(self, templates: dict[str, str], coverage: float, slack: float):
        self.names, self.coverage = list(templates), coverage
        texts = [[w.encode("latin-1") for w in words_of(t) if w] for t in templates.values()]
        if not all(texts):
            raise ValueError("a license template needs at least one word")
        every = sorted({w for t in texts for w in t})
        data = np.frombuffer(b"".join(every), np.uint8)
        ends = np.cumsum([len(w) for w in every])
        keys = C.word_hashes(data, ends - [len(w) for w in every], ends)
        order = np.argsort(keys)
        self.keys = keys[order]
        number = {every[o]: n for n, o in enumerate(order.tolist())}
        self.templates = [[number[w] for w in t] for t in texts]
        self.counts = np.array([np.bincount(t, minlength=len(every)) for t in self.templates])
        self.need = [max(1, int(np.ceil(coverage * len(t) - 1e-9))) for t in self.templates]
        self.slack = [max(2, int(slack * len(t))) for t in self.templates]

    def best(self, words: list[int], t: int) -> tuple[int, int, int, bool] | None:
        """Most aligned words of template ``t`` in a text, the first and last text word of that copy, and is it in a near range?"""
        template, need, slack = self.templates[t], self.need[t], self.slack[t]
        most = most_in_order(words, template)
        if most < need:
            return None
        have = Counter(w for w in words if w >= 0)
        places: list[int] = []
        covered = 0
        for w in sorted(set(template), key=lambda w: (have[w], template.index(w))):
            if covered > len(template) - need:
                break
            covered += template.count(w)
            places.append(w)
        starts = set()
        offsets = {w: [i for i, x in enumerate(template) if x == w] for w in places}
        for p, w in enumerate(words):
            if w in offsets:
                starts.update(p - o for o in offsets[w])
        found = None
        for s in sorted(starts):
            a, z = max(0, s - slack), min(len(words), s + len(template) + slack)
            pairs = patience(words[a:z], template)
            if len(pairs) >= need and (found is None or len(pairs) > found[0]):
                found = (len(pairs), a + pairs[0][0], a + pairs[-1][0])
                if len(pairs) == most:
                    break
        if found and found[0] == most:
            return (*found, True)
        return (most, *shortest_range(words, template, most), found is not None)

    def scan(self, data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple]:
        """``n_words, license, coverage, start, end, licenses`` of each text."""
        raw = C.LOWER[data]
        starts, ends, words = C.word_spans(raw, bounds, WORD)
        keys = C.word_hashes(raw, starts, ends)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        number = np.where(self.keys[at] == keys, at, -1)
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(words))
        known = number >= 0
        have = np.zeros((len(bounds) - 1, len(self.keys)), np.int32)
        np.add.at(have, (row[known], number[known]), 1)
        able = np.stack([np.minimum(have, c).sum(axis=1) >= n for c, n in zip(self.counts, self.need)], axis=1)
        for i in range(len(bounds) - 1):
            top, rank, names = None, (False, 0.0), []
            for t in np.flatnonzero(able[i]).tolist():
                got = self.best(number[words[i] : words[i + 1]].tolist(), t)
                if got:
                    names.append(self.names[t])
                    share = got[0] / len(self.templates[t])
                    if top is None or (got[3], share) > rank:
                        first, last = words[i] + got[1], words[i] + got[2]
                        rank = (got[3], share)
                        top = (self.names[t], share, int(starts[first] - bounds[i]), int(ends[last] - bounds[i]))
            yield (int(words[i + 1] - words[i]), *(top or (None, 0.0, None, None)), names)


_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("license", pa.string()), ("coverage", pa.float64()), ("start", pa.int32()),
                  ("end", pa.int32()), ("licenses", pa.list_(pa.string()))])


def scan_licenses(documents: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, slack: float = SLACK) -> DataFrame:
    """``doc_id, n_words, license, coverage, start, end, licenses`` for each document."""
    scanner = Scanner(templates or TEMPLATES, coverage, slack)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds, _ = C.text_bytes(b.column("text"))
            for i, j in C.row_chunks(bounds):
                got = list(zip(*scanner.scan(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])))
                yield C.batch(_OUT, b.column("doc_id").slice(i, j - i), *[list(c) for c in got])

    schema = "doc_id long, n_words long, license string, coverage double, start int, end int, licenses array<string>"
    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def op5_license_scan(spark, sf_dir: str) -> DataFrame:
    found = scan_licenses(C.table(spark, sf_dir, "documents"))
    return found.withColumn("licenses", F.array_join("licenses", ","))
