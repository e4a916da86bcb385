"""Licence scans by a trained paragraph classifier (operator 8).

A paragraph is a line of text.  Its features are the lower-cased word one-, two- and three-grams that
training gave a weight; a sparse multinomial logistic regression (proximal gradient, L1) tells
the licence families, ``unknown`` (licence terms of no known family) and ``none`` apart.  It is trained
here, on variations of TEMPLATES and UNKNOWN and on ``NEGATIVES`` paragraphs of the corpus without licence
words (a bounded sample, by hash).  Its probabilities are calibrated by a temperature
fitted on variations that training did not see.  A family that wins with ``LEAST`` or more is confirmed if the paragraph
holds at least ``CONFIRM`` of a template's word pairs; a family that isn't confirmed, and ``unknown``, count as unknown if the paragraph has a licence word (CUES), else not at all.

A notice may be wrapped over neighbouring lines; a line without words (blank, or comment marks alone) ends it.  Where
the words of such lines hold ``CONFIRM`` of a template's pairs within ``SPREAD`` times its length, over two lines or more, that
stretch is scored like a paragraph; of overlapping ones the template held best counts.  Its finding spans the
lines it touches, has the first one's number, and takes the place of their findings that are unknown or rest on the same words.

Every paragraph of every whole text is scored.  One without any weighted gram has the bias as its score, so only
paragraphs with hits are computed; that is exact.  The model is a few thousand weights.

Nulls and empty texts have no paragraphs; a null doc_id is passed through.  Repeated rows are judged each.  An empty table
gives no rows (and trains without corpus negatives).  Other columns are ignored.
"""

from __future__ import annotations

import bisect
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as tx
from .tables import read

#: Licence notices by family; fixed values.
TEMPLATES = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
            "This project is licensed under the terms of the MIT license."],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
                   "Released under the Apache 2.0 license."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-or-later",
                "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
                "Licensed under the GNU GPL v3."],
    "GPL-2.0": ["Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only",
                "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
                "Licensed under the GNU GPL v2."],
    "LGPL": ["Licensed under the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-2.1-or-later",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "AGPL-3.0": ["Licensed under the GNU Affero General Public License, version 3.", "SPDX-License-Identifier: AGPL-3.0-only",
                 "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "BSD": ["Released under the BSD License.", "Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "Use of this source code is governed by a BSD-style license"],
    "MPL-2.0": ["Licensed under the Mozilla Public License, version 2.0.", "SPDX-License-Identifier: MPL-2.0",
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-ND": ["Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."],
    "CC0": ["Released under CC0 1.0.", "This work is dedicated to the public domain under CC0 1.0 Universal."],
    "proprietary": ["All rights reserved.", "Copyright 2020 Example Corporation. All rights reserved.",
                    "This software is proprietary and confidential. Unauthorized copying is strictly prohibited."],
}
#: Licence terms of no family above; fixed values.
UNKNOWN = ["Licensed under the terms of the agreement.", "Released under a custom license.", "Licensed under the Foo Public License, version 1.",
           "Use is subject to license terms.", "See the license for details.", "This material is licensed to members only.",
           "Distributed under the Example Community License 1.1.", "Permission is granted to quote this text with a link to the source."]
#: Words that keep a corpus paragraph out of the negatives, and without which none is "unknown"; fixed values.
CUES = r"(?i)licen|copyright|permission|rights reserved|redistribut|public domain|\bgnu\b|\bbsd\b|apache|mozilla|spdx|confidential|proprietary"

NEGATIVES = 2000
NEGATIVE_CHARS = 400
VARIANTS = 24
LEAST = 0.5
CONFIRM = 0.6
#: A wrapped notice lies within so many times the template's word pairs.
SPREAD = 2
L1 = 1e-4
NONE_WEIGHT = 6.0
ROUNDS = 150
SEED = 8
_CUE = re.compile(CUES)
_LINE = tx.byte_table([(0x0A, 0x0A), (0x0D, 0x0D)], inside=False)


def grams(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the one- to three-grams inside each owner, with their owners."""
    out, who = [], []
    for n in (1, 2, 3):
        got = tx.gram_hashes(values, n)
        inside = owner[:len(got)] == owner[n - 1:]
        out.append(got[inside]), who.append(owner[:len(got)][inside])
    return np.concatenate(out), np.concatenate(who)


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw, offs = tx.buffers(pa.array(texts, pa.large_string()))
    raw = tx.LOWER[raw]
    starts, ends, at = tx.words(raw, offs, tx.ALNUM)
    return tx.span_hashes(raw, starts, ends), np.repeat(np.arange(len(texts)), np.diff(at))


def _variants(texts: list[str], rng: np.random.Generator, n: int) -> list[str]:
    """Each text as it is, and with words left out, cases changed, or filling words around it."""
    filling = "the see file for more note this document and page as of by in it text work here about".split()
    out = list(texts)
    for t in texts:
        w = t.split()
        for _ in range(n):
            kept = [x for x in w if rng.random() > 0.08] or w
            around = [filling[k] for k in rng.integers(0, len(filling), rng.integers(0, 5))]
            v = " ".join(around + kept + ([filling[k] for k in rng.integers(0, len(filling), rng.integers(0, 4))]))
            out.append(v.upper() if rng.random() < 0.1 else v)
    return out


class LicenceModel:
    """Weights by gram, bias, temperature, and the templates' word pairs."""

    def __init__(self, negatives: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.classes = [*TEMPLATES, "unknown", "none"]
        sources = [*TEMPLATES.values(), UNKNOWN]
        texts, labels, spare, spare_labels = [], [], [], []
        for c, own in enumerate(sources):
            some = _variants(own, rng, VARIANTS)
            texts += some
            labels += [c] * len(some)
            more = _variants(own, rng, 4)[len(own):]
            spare += more
            spare_labels += [c] * len(more)
        none = len(self.classes) - 1
        plain = negatives + _variants(["the work is here", "see this page for more about it", "version 3 of the text", "it is under the file"], rng, 8)
        cut = len(plain) // 5
        texts, labels = texts + plain[cut:], labels + [none] * (len(plain) - cut)
        spare, spare_labels = spare + plain[:cut], spare_labels + [none] * cut
        self._fit(texts, np.array(labels))
        self._calibrate(spare, np.array(spare_labels))
        self.pairs = {c: [self._pairs(t) for t in own] for c, own in TEMPLATES.items()}
        self.templates = [(c, np.array(sorted(t), np.uint64)) for c, own in self.pairs.items() for t in own]
        self.all_pairs = np.unique(np.concatenate([t for _, t in self.templates]))

    def _fit(self, texts: list[str], labels: np.ndarray) -> None:
        hashes, owner = grams(*_words(texts))
        kinds, of, count = np.unique(hashes, return_inverse=True, return_counts=True)
        kept = np.flatnonzero(count >= 4)
        column = np.full(len(kinds), -1)
        column[kept] = np.arange(len(kept))
        use = column[of] >= 0
        x = np.zeros((len(texts), len(kept)), np.float32)
        np.add.at(x, (owner[use], column[of][use]), 1.0)
        x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
        target = np.eye(len(self.classes), dtype=np.float32)[labels]
        balance = (1.0 / np.bincount(labels, minlength=len(self.classes)).clip(1))[labels][:, None].astype(np.float32)
        balance /= len(self.classes)
        balance[labels == len(self.classes) - 1] *= NONE_WEIGHT
        w = np.zeros((len(kept), len(self.classes)), np.float32)
        bias = np.zeros(len(self.classes), np.float32)
        ahead, t, step = w.copy(), 1.0, 8.0
        for _ in range(ROUNDS):  # accelerated proximal gradient
            z = x @ ahead + bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            error = (z / z.sum(axis=1, keepdims=True) - target) * balance
            new = ahead - step * (x.T @ error)
            new = np.sign(new) * np.maximum(np.abs(new) - step * L1, 0)
            bias -= step * error.sum(axis=0)
            t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
            ahead, w = new + np.float32((before - 1) / t) * (new - w), new
        some = np.abs(w).sum(axis=1) > 0
        # ``kept`` follows the sorted hashes, so these stay sorted.
        self.known, self.weights, self.bias = kinds[kept][some], w[some].astype(np.float64), bias.astype(np.float64)
        self.temperature = 1.0

    def _logits(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        hit = self.known[at] == hashes
        at, owner = at[hit], owner[hit]
        z = np.zeros((n, len(self.classes)))
        np.add.at(z, owner, self.weights[at])
        return z / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))[:, None] + self.bias

    def _calibrate(self, texts: list[str], labels: np.ndarray) -> None:
        z = self._logits(*grams(*_words(texts)), len(texts))
        def loss(t):
            p = z / t
            p = p - p.max(axis=1, keepdims=True)
            return float(np.mean(np.log(np.exp(p).sum(axis=1)) - p[np.arange(len(labels)), labels]))
        self.temperature = min(np.geomspace(0.05, 5.0, 60), key=loss)

    @staticmethod
    def _pairs(value: str) -> set[int]:
        words, _ = _words([value])
        return set((tx.gram_hashes(words, 2) if len(words) > 1 else words).tolist())

    def judge(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Best class and its probability for each of n paragraphs."""
        z = self._logits(hashes, owner, n) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return best, p[np.arange(n), best]

    def share(self, family: str, value: str) -> float:
        """The largest part of a template's word pairs that the text holds."""
        own = self._pairs(value)
        return max(len(own & t) / len(t) for t in self.pairs[family])

    def confirms(self, family: str, value: str) -> bool:
        return self.share(family, value) >= CONFIRM


def wrapped_notices(words: np.ndarray, line: np.ndarray, block: np.ndarray, model: LicenceModel) -> tuple[list, set]:
    """(family, probability, share, first word, last word) of the notices that go over several lines.

    Also (family, line) of what better stretches have ruled out.  ``line`` and ``block`` (neighbouring lines of
    one text) are given for each word.
    """
    got = tx.gram_hashes(words, 2)
    bitmap = np.zeros(1 << 18, bool)
    bitmap[(model.all_pairs & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
    place = np.flatnonzero(bitmap[(got & np.uint64((1 << 18) - 1)).astype(np.int64)])
    place = place[block[place] == block[place + 1]]
    at = np.minimum(np.searchsorted(model.all_pairs, got[place]), len(model.all_pairs) - 1)
    place = place[model.all_pairs[at] == got[place]]
    pair = got[place]
    some, several = [], set()
    for family, own in model.templates:
        n = len(own)
        need = int(np.ceil(CONFIRM * n))
        near = np.minimum(np.searchsorted(own, pair), n - 1)
        p = place[own[near] == pair]
        if len(p) < need:
            continue
        # Where so many of its pairs follow closely; pairs may repeat, so each such place is counted out below.
        first, last = p[:len(p) - need + 1], p[need - 1:]
        close = np.flatnonzero((last - first < SPREAD * n) & (block[first] == block[last]))
        end = np.minimum(np.searchsorted(p, first[close] + SPREAD * n), np.searchsorted(block[p], block[first[close]], side="right")) - 1
        over = line[first[close]] != line[p[end] + 1]
        several.update(block[first[close][over]].tolist())
        some.append((family, n, need, p, close, end))
    if not several:
        return [], set()
    found = []
    for family, n, need, p, close, ends in some:
        here = np.isin(block[p[close]], list(several))
        for k, end in zip(close[here].tolist(), ends[here].tolist()):
            values, nth = np.unique(got[p[k:end + 1]], return_index=True)
            if len(values) >= need:
                found.append((family, len(values) / n, n, int(p[k]), int(p[k + nth.max()]) + 1))
    # Of overlapping stretches the best one: the largest share, then the longest template, then the shortest stretch.
    out = []
    taken: list[tuple[int, int]] = []
    touched, kept = set(), set()
    for family, share, n, a, b in sorted(found, key=lambda x: (-x[1], -x[2], x[4] - x[3], x[3])):
        own = {(family, k) for k in range(int(line[a]), int(line[b]) + 1)}
        touched |= own
        k = bisect.bisect_left(taken, (a, b))
        if (k and taken[k - 1][1] >= a) or (k < len(taken) and taken[k][0] <= b):
            continue
        taken.insert(k, (a, b))
        kept |= own
        if line[a] == line[b]:
            continue
        best, prob = model.judge(*grams(words[a:b + 1], np.zeros(b + 1 - a, np.int64)), 1)
        if model.classes[best[0]] == family and prob[0] >= LEAST:
            out.append((family, float(prob[0]), share, a, b))
    return sorted(out, key=lambda x: x[3]), touched - kept


def scan_slice(column: pa.Array, model: LicenceModel) -> dict[str, list]:
    """n_paragraphs, families, n_unknown, best and findings of each text."""
    raw, offs = tx.buffers(column)
    n_docs = len(offs) - 1
    p_start, p_end, p_at = tx.words(raw, offs, _LINE)
    low = tx.LOWER[raw]
    starts, ends, _ = tx.words(low, offs, tx.ALNUM)
    words = tx.span_hashes(low, starts, ends)
    owner = np.searchsorted(p_start, starts, side="right") - 1
    hashes, who = grams(words, owner)
    bitmap = np.zeros(1 << 18, bool)
    bitmap[(model.known & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
    some = bitmap[(hashes & np.uint64((1 << 18) - 1)).astype(np.int64)]
    hashes, who = hashes[some], who[some]
    kinds, of = np.unique(who, return_inverse=True)
    out = {"n_paragraphs": np.diff(p_at).tolist(), "families": [[] for _ in range(n_docs)], "n_unknown": [0] * n_docs,
           "best": [0.0] * n_docs, "findings": [[] for _ in range(n_docs)]}
    if not len(kinds):
        return out
    best, prob = model.judge(hashes, of, len(kinds))
    findings: dict[int, list[tuple]] = {}              # by first line: last line, family, probability, share
    for k in np.flatnonzero(best != len(model.classes) - 1).tolist():
        par = int(kinds[k])
        name, p = model.classes[best[k]], float(prob[k])
        if p < LEAST:
            continue
        line = raw[p_start[par]:p_end[par]].tobytes().decode()
        share = model.share(name, line) if name != "unknown" else 0.0
        if share >= CONFIRM:
            findings[par] = [(par, name, p, share)]
        elif _CUE.search(line):
            findings[par] = [(par, "unknown", p, 0.0)]
    notices, lost = wrapped_notices(words, owner, _blocks(raw, offs, p_start, p_end, owner), model)
    for name, p, share, a, b in notices:
        lines = range(int(owner[a]), int(owner[b]) + 1)
        if any(f[1] == name and f[3] >= share for k in lines for f in findings.get(k, ())):
            continue                                   # a line of it says so already
        for k in lines:
            if k in findings:
                findings[k] = [f for f in findings[k] if f[1] not in ("unknown", name) and (f[1], k) not in lost]
        findings.setdefault(lines[0], []).append((lines[-1], name, p, share))
    for par, some in sorted(findings.items()):
        doc = int(np.searchsorted(offs, p_start[par], side="right")) - 1
        for last, name, p, _ in some:
            if name == "unknown":
                out["n_unknown"][doc] += 1
            else:
                out["families"][doc].append(name)
                out["best"][doc] = max(out["best"][doc], p)
            out["findings"][doc].append({"paragraph": par - int(p_at[doc]), "start_byte": int(p_start[par] - offs[doc]),
                                         "end_byte": int(p_end[last] - offs[doc]), "family": name, "probability": p})
    return out


def _blocks(raw: np.ndarray, offs: np.ndarray, p_start: np.ndarray, p_end: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each word the number of its block: neighbouring lines of one text, all with words."""
    new = np.ones(len(p_start), bool)
    for end_of_line in (0x0A, 0x0D):
        ends = np.concatenate([[0], np.cumsum(raw == end_of_line)])
        new[1:] &= ends[p_start[1:]] - ends[p_end[:-1]] <= 1
    text = np.searchsorted(offs, p_start, side="right")
    filled = np.zeros(len(p_start), bool)
    filled[owner] = True
    new[1:] = ~new[1:] | (text[1:] != text[:-1]) | ~filled[:-1] | ~filled[1:]
    return np.cumsum(new)[owner]


_FINDING = pa.struct([("paragraph", pa.int32()), ("start_byte", pa.int64()), ("end_byte", pa.int64()), ("family", pa.string()), ("probability", pa.float64())])
SCAN = ("n_paragraphs long, families array<string>, n_unknown long, best double, "
        "findings array<struct<paragraph:int,start_byte:bigint,end_byte:bigint,family:string,probability:double>>")


def negatives(docs: DataFrame, n: int = NEGATIVES) -> list[str]:
    """At most n paragraphs without licence words from about n documents, both picked by hash.

    The documents are picked before their lines are looked at, so what reaches the driver does not
    grow with the corpus.
    """
    share = min(1.0, n / max(1, docs.count()))
    picked = F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED)), F.lit(1 << 50)) < int(share * (1 << 50))
    line = docs.where(picked).select(F.explode(F.split("text", "[\\r\\n]+")).alias("line"))
    line = line.where((F.length("line") > 0) & (F.length("line") <= NEGATIVE_CHARS) & ~F.col("line").rlike(CUES))
    return [r.line for r in line.orderBy(F.xxhash64("line", F.lit(SEED)), "line").limit(n).collect()]


def scan_licences(docs: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """doc_id and SCAN of each row of ``docs``."""
    model = model or LicenceModel(sorted(set(negatives(docs))))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def task(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                found = scan_slice(part.column("text"), model)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(found["n_paragraphs"], pa.int64()),
                    pa.array([sorted(set(f)) for f in found["families"]], pa.list_(pa.string())), pa.array(found["n_unknown"], pa.int64()),
                    pa.array(found["best"], pa.float64()), pa.array(found["findings"], pa.list_(_FINDING))],
                    names=["doc_id", "n_paragraphs", "families", "n_unknown", "best", "findings"])
    return docs.select("doc_id", "text").mapInArrow(task, f"doc_id {kind}, {SCAN}")


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_paragraphs", F.array_join("families", ",").alias("families"), "n_unknown", "best", "findings")
