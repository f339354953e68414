"""Licence scans by a trained paragraph classifier.

Softmax regression over sparse word bigrams and trigrams names the licence
family of a paragraph.  It is trained on altered copies of the template
paragraphs below and on paragraphs of the corpus as the unknown class; its
probabilities are calibrated by a temperature on copies kept aside.  What it
predicts counts as confirmed if enough of a template of that family stands in
the paragraph.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, texts_of
from .decontaminate import words_of

#: Different lines of the corpus in the unknown class, at most in expectation.
UNKNOWN_ROWS = 1500
COPIES = 14
MIN_PROBABILITY = 0.5
MIN_OVERLAP = 0.5
#: A word of ``words_of`` before lower-casing.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Words of the smallest window that slides over a block of lines.
SMALLEST_WINDOW = 16

# Public notices and first paragraphs of common licences.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT license. See LICENSE file in the project root for full license information.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."],
    "BSD": ["Licensed under the BSD 3-Clause License.", "This source code is licensed under the BSD-style license found in the LICENSE file in the root directory of this source tree.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "GPL": ["This work is licensed under the GNU General Public License, version 3.", "Released under the GNU General Public License v2.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL": ["Licensed under the GNU Lesser General Public License, version 2.1.",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL": ["Licensed under the GNU Affero General Public License, version 3.",
             "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "ISC": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC0": ["Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
    "Proprietary": ["All rights reserved.", "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher."],
}
#: Sentences with the words but no grant.
MENTIONS = ["A driving licence is needed to rent a car.", "The club was licensed to sell wine under the new law.", "The album was released under the name of the band.",
            "The city issued a license to the company in the spring.", "She was granted permission to use the software at work.", "General public interest in the version was low.",
            "The terms of the license were under discussion.", "The film was released in version two.", "He works for the foundation of free art.", "Rights of the public were reserved for later."]


def _grams(words: list[bytes]) -> list[tuple]:
    return [*zip(words, words[1:]), *zip(words, words[1:], words[2:])]


def window_sizes() -> list[tuple[int, int]]:
    """Window sizes in words, doubling until half a window holds the longest
    template, each with the fewest n-grams that confirm a template meant for it
    (one that no smaller window's half holds)."""
    templates = [words_of(t.encode()) for ts in TEMPLATES.values() for t in ts]
    sizes = [SMALLEST_WINDOW]
    while sizes[-1] < 2 * max(map(len, templates)):
        sizes.append(2 * sizes[-1])
    meant = [(s, [len(set(_grams(t))) for t in templates if len(t) <= s // 2 and (s == SMALLEST_WINDOW or len(t) > s // 4)]) for s in sizes]
    return [(s, math.ceil(MIN_OVERLAP * min(n))) for s, n in meant if n]


@dataclass
class Model:
    families: list[str]  # the last class is unknown
    index: dict[tuple, int]
    weights: np.ndarray  # n-grams x classes
    bias: np.ndarray
    temperature: float
    templates: dict[str, list[set[tuple]]]

    def features(self, words: list[bytes]) -> tuple[list[int], float]:
        """Known n-grams of a paragraph (each once), and the root of the number of all its n-grams."""
        get = self.index.get
        known = {i for g in zip(words, words[1:]) if (i := get(g)) is not None}
        if known:
            known |= {i for g in zip(words, words[1:], words[2:]) if (i := get(g)) is not None}
        return sorted(known), float(np.sqrt(max(2 * len(words) - 3, 1)))

    def windows(self, words: list[bytes], sizes: list[tuple[int, int]]) -> list[tuple[int, int, tuple[list[int], float]]]:
        """Overlapping windows [a, b) of a block's words with their features.
        Every run of half a window's words stands whole in one window; windows
        with too few known n-grams to confirm a template of their size are
        left out, since no result could come from them."""
        get = self.index.get
        known = [(k, i, 2) for k, g in enumerate(zip(words, words[1:])) if (i := get(g)) is not None]
        if not known:
            return []
        known += [(k, i, 3) for k, g in enumerate(zip(words, words[1:], words[2:])) if (i := get(g)) is not None]
        known.sort()
        at = np.array([k for k, _, _ in known])
        out = []
        for size, fewest in sizes:
            first = np.arange(0, max(len(words) - size // 2, 1), size // 2)
            lo, hi = np.searchsorted(at, first), np.searchsorted(at, first + size)
            for j in np.flatnonzero(hi - lo >= fewest):
                a, b = int(first[j]), min(int(first[j]) + size, len(words))
                ids = {i for k, i, n in known[lo[j]:hi[j]] if k + n <= b}
                if len(ids) >= fewest:
                    out.append((a, b, (sorted(ids), math.sqrt(max(2 * (b - a) - 3, 1)))))
            if len(words) <= size:
                break
        return out

    def probabilities(self, rows: list[tuple[list[int], float]]) -> np.ndarray:
        n = np.array([len(f) for f, _ in rows])
        at, row = np.array([i for f, _ in rows for i in f], np.int64), np.repeat(np.arange(len(rows)), n)
        z = np.stack([np.bincount(row, self.weights[at, c], len(rows)) for c in range(len(self.bias))], 1)
        z = (z / np.array([s for _, s in rows])[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def overlap(self, family: str, words: list[bytes]) -> float:
        """Largest share of a template's n-grams of that family that the paragraph has."""
        own = set(_grams(words))
        return max((len(t & own) / len(t) for t in self.templates[family]), default=0.0)


def _copies(words: list[bytes], filler: list[bytes], rng: np.random.Generator, n: int) -> list[list[bytes]]:
    """Altered copies: a few words dropped, and foreign words before and after."""
    out = [words]
    for _ in range(n - 1):
        kept = [w for w in words if rng.random() > 0.04] if len(words) > 8 else list(words)
        pad = [list(rng.choice(filler, rng.integers(0, 9))) if filler else [] for _ in range(2)]
        out.append([*map(bytes, pad[0]), *kept, *map(bytes, pad[1])])
    return out


def train(unknown: list[bytes], seed: int = 5) -> Model:
    """Fit on the templates and on ``unknown`` paragraphs."""
    rng = np.random.default_rng(seed)
    templates = {f: [set(_grams(words_of(t.encode()))) for t in ts] for f, ts in TEMPLATES.items()}
    every = [t for ts in templates.values() for t in ts]
    none = [words_of(t) for t in unknown]
    filler = [w for p in none[:200] for w in p[:50]][:4000]
    # Paragraphs of the corpus that hold most of a template are not unknown.
    none = [p for p in none if p and not any(len(t & set(_grams(p))) >= MIN_OVERLAP * len(t) for t in every)]
    families = sorted(TEMPLATES)
    rows: list[tuple[list[bytes], int]] = [(c, k) for k, f in enumerate(families) for t in TEMPLATES[f]
                                           for c in _copies(words_of(t.encode()), filler, rng, COPIES)]
    rows += [(c, len(families)) for t in MENTIONS for c in _copies(words_of(t.encode()), filler, rng, 4)]
    rows += [(p, len(families)) for p in none]
    index = {g: i for i, g in enumerate(sorted({g for t in every for g in t} | {g for t in MENTIONS for g in _grams(words_of(t.encode()))}))}
    m = Model(families, index, np.zeros((len(index), len(families) + 1)), np.zeros(len(families) + 1), 1.0, templates)
    feats = [m.features(w) for w, _ in rows]
    x = np.zeros((len(rows), len(index) + 1), np.float32)
    for r, (f, s) in enumerate(feats):
        x[r, f] = 1 / s
    x[:, -1] = 1
    y = np.eye(len(families) + 1, dtype=np.float32)[[k for _, k in rows]]
    share = y.sum(0)
    aside = rng.random(len(rows)) < 0.2
    weight = ((1 / np.maximum(share, 1))[y.argmax(1)] * np.where(y[:, -1] == 1, 4.0, 1.0) * ~aside).astype(np.float32)
    weight /= weight.sum()
    w, velocity = np.zeros((x.shape[1], y.shape[1]), np.float32), 0.0
    for _ in range(150):
        z = x @ w
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        velocity = 0.9 * velocity + (x.T @ ((p - y) * weight[:, None]) + 1e-5 * w)
        w = w - 8.0 * velocity
    m.weights, m.bias = w[:-1].astype(float), w[-1].astype(float)
    z, best = x[aside] @ w, (np.inf, 1.0)
    for t in np.geomspace(0.25, 4, 25):  # the temperature of the least log loss on the copies kept aside
        q = z / t
        loss = float((np.log(np.exp(q - q.max(1, keepdims=True)).sum(1)) + q.max(1) - (q * y[aside]).sum(1)).mean()) if aside.any() else 0.0
        best = min(best, (loss, float(t)))
    m.temperature = best[1]
    return m


def fit(docs: DataFrame, text_col: str = "text", rows: int = UNKNOWN_ROWS) -> Model:
    """Train with a bounded sample of whole lines of the corpus: in expectation
    at most ``rows`` different ones, however many lines a text has, drawn by a
    hash of the line, so that the copies of a line are drawn together."""
    lines = docs.select(F.explode(F.split(F.col(text_col).cast("string"), "\n")).alias("line")).where(F.length("line") > 20)
    rate = rows / max(lines.count(), 1)
    draw = F.pmod(F.xxhash64("line", F.lit("line")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return train([r["line"].encode() for r in lines.where(draw < rate).distinct().sort("line").collect()])


def paragraphs(text: bytes) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """[start, end) byte ranges of all lines that are not blank, and of all
    blocks of lines between blank ones, whatever their size."""
    lines, blocks, block, at = [], [], [], 0
    for line in [*text.split(b"\n"), b""]:
        if line.strip():
            block.append((at, at + len(line)))
        elif block:
            lines += block
            blocks.append((block[0][0], block[-1][1]))
            block = []
        at += len(line) + 1
    return lines, blocks


def scan_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_paragraphs, licence`` (the family of
    the likeliest confirmed paragraph, null without one) and ``found``: every
    line whose likeliest class is a family with a probability of at least 0.5,
    and every confirmed window over a block of lines of which that holds and
    that meets no confirmed span of its family that is likelier, as
    struct(family, probability, confirmed, start, end) in characters.
    ``n_paragraphs`` counts lines and blocks of several lines.

    Windows of several sizes slide over every block, so a hard-wrapped notice
    is read whole wherever it stands, in very long texts too.  Null and empty
    texts have no paragraphs; an empty table gives no rows; other columns are
    not read, whatever their names.  Each row is judged alone, so repeats need
    no rule; of equal probabilities the first counts, lines before windows."""
    sent, sizes = docs.sparkSession.sparkContext.broadcast(model), window_sizes()

    def f(cols):
        m, texts = sent.value, texts_of(cols["text"])
        rows, owner, counts = [], [], []
        for i, t in enumerate(texts):
            lines, blocks = paragraphs(t)
            counts.append(len(lines) + len(set(blocks) - set(lines)))
            for a, b in lines:
                feats = m.features(words_of(t[a:b]))
                if feats[0]:  # without any known n-gram a paragraph is unknown
                    rows.append(feats)
                    owner.append((i, a, b, False))
            for a, b in blocks:
                for first, last, feats in m.windows(words_of(t[a:b]), sizes):
                    rows.append(feats)
                    owner.append((i, (a, b), (first, last), True))
        found: list[list[dict]] = [[] for _ in texts]
        wide: list[list[dict]] = [[] for _ in texts]
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        if rows:
            p = m.probabilities(rows)
            for r in np.flatnonzero((p.argmax(1) < len(m.families)) & (p.max(1) >= MIN_PROBABILITY)):
                i, a, b, window = owner[r]
                if window:  # word numbers of a block to bytes
                    (at, stop), (first, last) = a, b
                    if (i, at) not in spans:
                        spans[i, at] = [x.span() for x in WORD.finditer(texts[i], at, stop)]
                    a, b = spans[i, at][first][0], spans[i, at][last - 1][1]
                family = m.families[int(p[r].argmax())]
                ok = m.overlap(family, words_of(texts[i][a:b])) >= MIN_OVERLAP
                if window and not ok:
                    continue
                chars = len(texts[i][:a].decode()), len(texts[i][:b].decode())
                (wide if window else found)[i].append({"family": family, "probability": float(p[r].max()), "confirmed": bool(ok),
                                                       "start": chars[0], "end": chars[1]})
        for kept, more in zip(found, wide):
            for x in sorted(more, key=lambda x: -x["probability"]):
                if not any(y["confirmed"] and y["family"] == x["family"] and y["start"] < x["end"] and x["start"] < y["end"]
                           and y["probability"] >= x["probability"] for y in kept):
                    kept.append(x)
        best = [max((x for x in fs if x["confirmed"]), key=lambda x: x["probability"], default=None) for fs in found]
        return {"doc_id": cols["doc_id"], "n_paragraphs": counts, "licence": [x and x["family"] for x in best], "found": found}
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, f, "doc_id long, n_paragraphs long, licence string, "
                       "found array<struct<family:string,probability:double,confirmed:boolean,start:int,end:int>>")


def licence_report(docs: DataFrame) -> DataFrame:
    return scan_documents(docs, fit(docs))
