"""License scans by patience alignment.

A text and a license template are compared as word sequences. Words that occur
once in both are anchors; the longest increasing subsequence of their places
is kept, equal neighbours of a kept anchor are taken along, and the gaps are
aligned in the same way. Where no word is unique in the text's range (a
notice given twice, say), the range is divided at the rarest template word's
occurrences and the best part counts. The aligned words are split where the
text skips more than ``MAX_GAP`` words; the piece with most words gives the
coverage, its share of the template.

Before aligning, the share of the template's words that the text has at all is
computed for all templates with one product; below the threshold the coverage
cannot reach it either, so such a pair is out without loss.

Defined results: a null, empty or wordless text has no license; ties between
templates go to the one with more words, then the first listed; repeated rows
are scanned each; empty tables stay empty; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map
from .decontaminate import WORD_BYTES
from .textkit import LOWER, Words, chunks

THRESHOLD = 0.8
MAX_GAP = 12

# Public license notices and headers, as their owners word them.
TEMPLATES = (
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("proprietary", "All rights reserved."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
)


def align(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Aligned (text, template) places, ascending in both."""
    out: list[tuple[int, int]] = []
    # Ranges, and whether a pair that is kept stands right before and right after them.
    todo = [(0, len(text), 0, len(template), False, False)]
    while todo:
        a, b, c, d, left, right = todo.pop()
        while left and a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while right and a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        once = {w for w, n in Counter(template[c:d]).items() if n == 1}
        count = Counter(w for w in text[a:b] if w in once)
        where = {w: j for j, w in enumerate(template[c:d], c)}
        anchors = [(i, where[w]) for i, w in enumerate(text[a:b], a) if w in once and count[w] == 1]
        chain = increasing(anchors)
        if chain:
            out += chain
            edges = [(a - 1, c - 1, left), *((i, j, True) for i, j in chain), (b, d, right)]
            todo += [(i + 1, k, j + 1, m, p, q) for (i, j, p), (k, m, q) in zip(edges, edges[1:])]
            continue
        # No anchor: divide the text at the occurrences of its rarest template word.
        count = Counter(w for w in text[a:b] if w in where)
        if count:
            rarest = min(count, key=lambda w: (count[w], where[w]))
            if count[rarest] > 1:
                cut = [a - 1, *(i for i in range(a, b) if text[i] == rarest), b]
                parts = [align(text[p + 1:r], template[c:d]) for p, r in zip(cut, cut[2:])]
                k = max(range(len(parts)), key=lambda i: (len(parts[i]), -i))
                out += [(i + cut[k] + 1, j + c) for i, j in parts[k]]
            else:       # once in the text but several times in the template: pair it with its first place
                i, j = text.index(rarest, a, b), template.index(rarest, c, d)
                out.append((i, j))
                todo += [(a, i, c, j, left, True), (i + 1, b, j + 1, d, True, right)]
    return sorted(out)


def increasing(anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence with ascending second places (patience piles)."""
    tops: list[int] = []
    pile: list[int] = []
    back = [-1] * len(anchors)
    for k, (_, j) in enumerate(anchors):
        p = bisect_left(tops, j)
        back[k] = pile[p - 1] if p else -1
        tops[p:p + 1] = [j]
        pile[p:p + 1] = [k]
    out, k = [], pile[-1] if pile else -1
    while k >= 0:
        out.append(anchors[k])
        k = back[k]
    return out[::-1]


def densest(pairs: list[tuple[int, int]], max_gap: int = MAX_GAP) -> list[tuple[int, int]]:
    """The run of aligned words with most words and no larger gap in the text."""
    best: list[tuple[int, int]] = []
    run: list[tuple[int, int]] = []
    for p in pairs:
        if run and p[0] - run[-1][0] > max_gap:
            run = []
        run.append(p)
        if len(run) > len(best):
            best = list(run) if len(run) == 1 else run
    return best


class Templates:
    def __init__(self, templates=TEMPLATES):
        self.names = [name for name, _ in templates]
        self.hashes = []
        for chunk in chunks(pa.array([t for _, t in templates], pa.string())):
            words = Words(chunk, WORD_BYTES, LOWER)
            got = words.hashes()
            self.hashes += [got[a:b] for a, b in zip(words.begin, words.end)]
        self.vocabulary = np.unique(np.concatenate(self.hashes))
        self.words = [np.searchsorted(self.vocabulary, h).tolist() for h in self.hashes]
        self.times = np.zeros((len(self.words), len(self.vocabulary)))
        for t, ids in enumerate(self.words):
            np.add.at(self.times[t], ids, 1 / len(ids))

    def scan(self, column: pa.Array, threshold: float, max_gap: int):
        """Per text: number of words, and hits (template, coverage, first and last word, from, to byte)."""
        for chunk in chunks(column):
            words = Words(chunk, WORD_BYTES, LOWER)
            got = words.hashes()
            at = np.minimum(np.searchsorted(self.vocabulary, got), len(self.vocabulary) - 1)
            known = self.vocabulary[at] == got
            ids = np.where(known, at, -1)
            has = np.zeros((len(chunk), len(self.vocabulary)))
            has[words.doc[known], at[known]] = 1
            within = has @ self.times.T >= threshold - 1e-9
            for i in range(len(chunk)):
                a, b, hits = int(words.begin[i]), int(words.end[i]), []
                text = ids[a:b].tolist() if within[i].any() else []
                for t in np.flatnonzero(within[i]):
                    run = densest(align(text, self.words[t]), max_gap)
                    share = len(run) / len(self.words[t])
                    if share >= threshold - 1e-9:
                        p, q = run[0][0], run[-1][0]
                        hits.append({"template": int(t), "license": self.names[t], "coverage": share, "words": len(run),
                                     "first": p, "last": q, "a": int(words.start[a + p] - chunk.begin[i]),
                                     "b": int(words.stop[a + q] - chunk.begin[i])})
                hits.sort(key=lambda h: (-h["coverage"], -h["words"], h["template"]))
                yield b - a, hits


HIT = "template:int,license:string,coverage:double,words:int,first:int,last:int,a:int,b:int"
_HIT = pa.struct([(n, {"int": pa.int32(), "string": pa.string(), "double": pa.float64()}[k])
                  for n, k in (x.split(":") for x in HIT.split(","))])


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text", templates=TEMPLATES,
                  threshold: float = THRESHOLD, max_gap: int = MAX_GAP) -> DataFrame:
    """``key, n_words, hits`` for every row; a hit has the license, its coverage,
    and the words and UTF-8 bytes it spans, best first."""
    known = docs.sparkSession.sparkContext.broadcast(Templates(templates))
    slim = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = list(known.value.scan(batch.column("text"), threshold, max_gap))
        return pa.record_batch([batch.column("key"), pa.array([n for n, _ in got], pa.int64()),
                                pa.array([h for _, h in got], pa.list_(_HIT))], names=["key", "n_words", "hits"])
    kind = slim.schema["key"].dataType.simpleString()
    return arrow_map(slim, run, f"`{key}` {kind}, n_words bigint, hits array<struct<{HIT}>>")


def license_digest(docs: DataFrame) -> DataFrame:
    """One row a document: its best license and where it stands, and all licenses found."""
    best = F.col("hits")[0]
    return scan_licenses(docs).withColumn("hits", F.when(F.size("hits") > 0, F.col("hits"))).select(
        "doc_id", "n_words", best["license"].alias("license"), best["coverage"].alias("coverage"),
        best["words"].cast("long").alias("n_matched"), best["first"].cast("long").alias("first_word"),
        best["last"].cast("long").alias("last_word"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(F.col("hits.license"))), ","), F.lit("")).alias("licenses"))
