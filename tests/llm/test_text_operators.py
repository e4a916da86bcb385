"""Packing, token counts, quality, near duplicates, decontamination and licences on small tables."""

from __future__ import annotations

import gc
import random
import textwrap
import weakref

import numpy as np
import pyarrow as pa
import pytest

from revaudit.llm import decontamination, licences, near_duplicates, packing, quality, token_counts
from revaudit.llm.tables import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def frame(spark):
    ship_package(spark)

    def make(rows, schema=DOCS, partitions=3):
        if schema == DOCS:
            rows = [(i, t, "en", f"s{(i or 0) % 2}", len(t or "")) for i, t in rows]
        return spark.createDataFrame(rows, schema).repartition(partitions)
    return make


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


# --- packing ------------------------------------------------------------------

def reference_encoder():
    import base64

    import tiktoken
    with open(packing.TOKENIZER, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def test_encoder_equals_plain_encoding():
    rng = random.Random(5)
    letters = list("ab1é,'\n \n  \t　\xa0s") + ["  ", " \n", "'ll", "Zß", "日本"]
    texts = ["", " ", "a  b", "a b ", "it's we'll  ok 12", "　 x", "…… b“ c”"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    encoder, plain = packing.Encoder(), reference_encoder()
    for _ in range(2):  # the second time from remembered parts
        ids, at = encoder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [plain(t) for t in texts]


def test_best_fit_decreasing_equals_naive():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 64, 100):
        for _ in range(20):
            lengths = rng.integers(1, size + 1, rng.integers(1, 120))
            row_of, n = packing.best_fit_decreasing(lengths, size)
            rooms: list[int] = []
            for length in sorted(lengths.tolist(), reverse=True):
                fits = [r for r in rooms if r >= length]
                if fits:
                    rooms[rooms.index(min(fits))] -= length
                else:
                    rooms.append(size - length)
            used = np.bincount(row_of, weights=lengths, minlength=n)
            assert sorted(size - used) == sorted(rooms)


def test_packed_rows_round_trip(frame):
    rng = random.Random(2)
    texts = {i: prose(rng, rng.choice([1, 5, 40, 900])) for i in range(60)}
    texts |= {60: None, 61: "", 62: "  ", 63: texts[3]}
    rows = packing.packed_rows(frame(list(texts.items())), size=128, window_tokens=4000).collect()
    plain, found = reference_encoder(), {}
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(places) == 128 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (ids[r.n_tokens:] == packing.PAD).all()
        for doc, start, a, b in zip(r.doc_ids, r.doc_starts, r.cu_seqlens, r.cu_seqlens[1:]):
            assert places[a:b].tolist() == list(range(b - a))
            found.setdefault(doc, {})[start] = ids[a:b].tolist()
    for doc, text in texts.items():
        whole = [t for _, part in sorted(found.get(doc, {}).items()) for t in part]
        assert whole == (plain(text) if text else [])


def test_packed_rows_of_nothing(frame):
    assert packing.packed_rows(frame([])).count() == 0
    assert packing.packed_rows(frame([(1, None), (None, "a b")])).collect()[0].doc_ids == [None]


# --- token counts -------------------------------------------------------------

def test_histogram_answers_every_limit(frame):
    rng = random.Random(4)
    docs = frame([(i, prose(rng, rng.randrange(1, 700)) if i % 9 else None) for i in range(80)])
    lengths = token_counts.encoded_lengths(docs)
    per = {}
    for r in lengths.collect():
        per.setdefault(r.source, []).append(r.length)
    plain = reference_encoder()
    assert sorted(sum(per.values(), [])) == sorted(len(plain(r.text)) if r.text else 0 for r in docs.collect())
    rows = token_counts.length_histogram(lengths).collect()
    for r in rows:
        own = per[r.source]
        assert (r.docs, r.all_docs, r.all_tokens) == (own.count(r.length), len(own), sum(own))
        assert (r.docs_from, r.tokens_from) == (sum(n >= r.length for n in own), sum(n for n in own if n >= r.length))
        assert r.truncated_total == sum(min(n, r.length) for n in own)
        assert r.quantile == pytest.approx(sum(n <= r.length for n in own) / len(own))
    limits = [0, 1, 50, 333, 10**6]
    got = {(r.source, r.limit): (r.docs_over, r.truncated_total)
           for r in token_counts.at_limits(token_counts.length_histogram(lengths), limits).collect()}
    assert got == {(s, n): (sum(x > n for x in own), sum(min(x, n) for x in own)) for s, own in per.items() for n in limits}
    assert token_counts.length_histogram(token_counts.encoded_lengths(frame([]))).count() == 0


# --- quality ------------------------------------------------------------------

def quality_rows(n):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = [f"{rng.choice('bcdfgm')}{rng.choice('aeiou')}{rng.choice('nrst')}{rng.randrange(30)}" for _ in range(rng.randrange(30, 200))]
        rows.append((i, " ".join(words) + "." if good else " | ".join(words[:5] * (len(words) // 5))))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality_on_held_out_rows(spark, frame):
    rows, labels = quality_rows(900)
    docs = frame(rows + [(9000, None), (9001, ""), (None, "a plain text")])
    known = spark.createDataFrame(labels + [(None, 1, 0), (5000, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(quality.statistics_table(docs), known)
    truth = {i: q for i, q, _ in labels}
    x = quality.statistics(pa.array([t for _, t in rows]))
    right = (model.score(x) >= 0.5).astype(int) == np.array([truth[i] for i, _ in rows])
    assert right.mean() > 0.99
    kept = {r.doc_id for r in quality.keep_good(docs, known).collect()}
    assert sum((i in kept) == bool(q) for i, q in truth.items()) > 0.99 * len(truth)
    assert quality.keep_good(docs, known).columns == docs.columns


def test_quality_without_labels_or_rows(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = quality.fit(quality.statistics_table(frame([(1, "a")])), none)
    assert model.score(quality.statistics(pa.array(["x y", None, ""]))).tolist() == [0.5] * 3
    assert quality.keep_good(frame([]), none).count() == 0


def test_isotonic_rises():
    at, value = quality.isotonic(np.arange(6.0), np.array([5.0, 5, 5, 5, 5, 5]), np.array([0.0, 2, 1, 4, 3, 5]))
    assert (np.diff(value) >= 0).all() and (np.diff(at) > 0).all() and value[0] == 0 and value[-1] == 1


# --- near duplicates ----------------------------------------------------------

def near_rows():
    rng = random.Random(7)
    rows = {}
    for g in range(6):
        words = [f"g{g}x{rng.randrange(5000)}" for _ in range(rng.choice([6, 9, 40, 200]))]
        for _ in range(9):
            own = list(words)
            for _ in range(rng.randrange(0, 1 + len(own) // 12)):
                own[rng.randrange(len(own))] = f"n{rng.randrange(10**6)}"
            rows[len(rows) * 3 + 1] = " ".join(own) if rng.random() < 0.8 else " ".join(own).upper()
    rows |= {2: None, 5: "", 8: " \t\n", 11: "one two", 14: "ONE  two", 17: "one two three", 20: rows[1]}
    # A chain: neighbours are near, the ends are not.
    words = [f"c{k}" for k in range(120)]
    for k in range(8):
        rows[1000 + k] = " ".join(words[5 * k:5 * k + 80])
    return rows


@pytest.mark.parametrize("crowd,tile_bytes", [(near_duplicates.CROWD, near_duplicates.TILE_BYTES), (2, 3000)])
def test_near_duplicates_equal_brute_force(frame, crowd, tile_bytes):
    """Also with every bucket of three classes as a crowd, in many small tiles."""
    rows = near_rows()
    found = near_duplicates.near_duplicates(frame(list(rows.items())), crowd, tile_bytes)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    assert got == near_duplicates.brute_force(rows)
    groups = {}
    for doc, (_, c) in got.items():
        groups.setdefault(c, []).append(doc)
    assert len(groups[1000]) == 8  # the chain is one group


def test_near_duplicates_of_odd_rows(frame):
    docs = frame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (3, "a b c d e f"), (9, None)])
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in near_duplicates.near_duplicates(docs).collect())
    assert got == [(0, 0, True), (3, 3, True), (4, 3, False), (4, 3, False), (9, 9, True)]
    assert sorted(r.doc_id or 0 for r in near_duplicates.keep_first(docs).collect()) == [0, 3, 9]
    assert near_duplicates.near_duplicates(frame([])).count() == 0


def test_sketch_estimates_similarity():
    rng = np.random.default_rng(3)
    for same in (0.5, 0.75, 0.95):
        equal = []
        for _ in range(40):
            shared = rng.integers(0, 2**63, int(400 * same)).astype(np.uint64)
            rest = int(400 * (1 - same) / 2)
            a, b = (np.concatenate([shared, rng.integers(0, 2**63, rest).astype(np.uint64)]) for _ in range(2))
            bins = near_duplicates.sketches(np.concatenate([np.sort(a), np.sort(b)]), np.array([0, len(a), len(a) + len(b)]))
            assert (bins != 0xFFFFFFFF).all()
            equal.append((bins[0] == bins[1]).mean())
        assert np.mean(equal) == pytest.approx(same, abs=0.03)
    assert (near_duplicates.sketches(np.array([7], np.uint64), np.array([0, 1])) != 0xFFFFFFFF).all()


# --- decontamination ----------------------------------------------------------

def contaminated_rows():
    rng = random.Random(8)
    items = [(f"i{k}", prose(rng, rng.choice([1, 4, 12, 13, 14, 40]), 60) + f" key{k}") for k in range(12)]
    items += [("short", "lone"), ("null", None), ("none", " ,. "), (None, "no name at all"), ("i0", items[0][1])]
    rows = []
    for i in range(60):
        text = prose(rng, rng.randrange(0, 120), 60)
        if i % 3 == 0:
            words = items[rng.randrange(12)][1].split()
            a = rng.randrange(len(words))
            text += " " + ", ".join(words[a:]).upper() + "! " + prose(rng, 20, 60)
        rows.append((i, text if i % 17 else None))
    rows += [(60, "LONE"), (61, "no-name at all"), (62, items[3][1] + "\n" + items[4][1])]
    return rows, items


@pytest.mark.parametrize("block", [10**6, 30])
def test_decontamination_equals_brute_force(spark, frame, block):
    rows, items = contaminated_rows()
    docs = frame(rows)
    benchmark = spark.createDataFrame(items, "item_id string, text string")
    got = {r.doc_id: r for r in decontamination.decontaminate(docs, benchmark, block_words=block).collect()}
    for (doc, _), (n_words, n_hit, names, _) in zip(rows, decontamination.brute_force([t for _, t in rows], items)):
        r = got[doc]
        assert (r.n_words, r.n_hit, r.items) == (n_words, n_hit, names), doc
        assert sum(b - a for a, b in zip(r.hit_starts, r.hit_ends)) == n_hit
        assert bool(r.longest) == bool(n_hit)
    clean = {d for d, r in got.items() if not (r.n_hit and r.n_hit * 20 >= r.n_words)}
    assert {r.doc_id for r in decontamination.drop_contaminated(docs, benchmark).collect()} == clean


def test_decontamination_of_nothing(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminate(frame([(1, "a b")]), none).first().n_hit == 0
    assert decontamination.decontaminate(frame([]), none).count() == 0
    assert decontamination.drop_contaminated(frame([(1, "a b")]), none).count() == 1


def test_hits_of_several_blocks_count_together(frame):
    rng = random.Random(31)
    one, other = (" ".join(f"{name}{k}" for k in range(39)) for name in "xy")
    fill = [prose(rng, n) for n in (400, 300, 222)]
    text = " ".join([fill[0], one, fill[1], other, fill[2]])        # 1,000 words, 39 hit by each item
    benchmark = frame([(1, one), (2, other)]).selectExpr("cast(doc_id as string) item_id", "text")
    docs = frame([(1, text), (2, " ".join([*fill, one])), (None, text)]).withColumnRenamed("n_chars", "row")
    for block in (1, 10, 2_000_000):
        kept = decontamination.drop_contaminated(docs, benchmark, block_words=block)
        assert kept.columns == docs.columns
        assert [r.doc_id for r in kept.collect()] == [2]


def test_few_blocks_on_the_driver(frame, monkeypatch):
    alive, most, plain = [], [], decontamination.Items.__init__

    def init(self, *args):
        plain(self, *args)
        gc.collect()
        alive.append(weakref.ref(self))
        most.append(sum(r() is not None for r in alive))
    monkeypatch.setattr(decontamination.Items, "__init__", init)
    rng = random.Random(3)
    benchmark = frame([(k, prose(rng, 20)) for k in range(5)]).selectExpr("cast(doc_id as string) item_id", "text")
    docs = frame([(1, prose(rng, 50))])
    assert decontamination.decontaminate(docs, benchmark, block_words=1).count() == 1
    assert decontamination.drop_contaminated(docs, benchmark, block_words=1).count() == 1
    assert len(alive) == 10 and max(most) <= 2


# --- licences -----------------------------------------------------------------

def test_licences_are_found_and_prose_is_not(frame):
    rng = random.Random(9)
    notices = {1: ("MIT", "Released under the MIT License."), 2: ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
               3: ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
               4: ("CC-BY-NC", "Licensed under CC BY-NC 4.0."), 5: ("BSD", "LICENSED UNDER THE BSD 3-CLAUSE LICENSE"),
               6: ("CC-BY", "Licensed under CC BY 4.0."), 7: ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
               8: ("proprietary", "All rights reserved.")}
    plain = "the of to in and is under see this work file text with by for on at from".split()
    rows = [(i, "\n".join([prose(rng, 30), n, prose(rng, 12)])) for i, (_, n) in notices.items()]
    rows += [(100 + k, "\n".join(" ".join(rng.choice(plain) for _ in range(25)) for _ in range(4))) for k in range(60)]
    rows += [(300, "Released under the Zebra Community License."), (301, None), (302, ""), (303, "\n\n")]
    got = {r.doc_id: r for r in licences.scan_licences(frame(rows)).collect()}
    assert {i: r.families for i, r in got.items() if r.families} == {i: [f] for i, (f, _) in notices.items()}
    f = got[1].findings[0]
    assert rows[0][1].encode()[f.start_byte:f.end_byte].decode() == notices[1][1] and f.paragraph == 1
    assert got[300].n_unknown == 1 and got[301].n_paragraphs == got[302].n_paragraphs == got[303].n_paragraphs == 0
    assert licences.scan_licences(frame([])).count() == 0


def test_wrapped_licences_are_found(frame):
    bsd = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
           "following conditions are met:")
    isc = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
           "granted, provided that the above copyright notice and this permission notice appear in all copies.")
    gpl3 = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
            "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
    gpl2 = gpl3.replace("software:", "software;").replace("Foundation, either version 3", "Foundation; either version 2")
    lgpl = gpl2.replace("GNU General", "GNU Lesser General")
    rng = random.Random(9)
    rows, expected = [], {}
    for name, notice in (("BSD", bsd), ("ISC", isc), ("GPL-3.0", gpl3), ("GPL-2.0", gpl2), ("LGPL", lgpl)):
        for width in (50, 70, 78):
            for mark, end in (("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\r")):
                lines = [mark + x for x in textwrap.wrap(notice, width)]
                above = [prose(rng, 9) for _ in range(rng.randrange(3))]
                rows.append((len(rows), end.join([*above, *lines, prose(rng, 9)])))
                expected[rows[-1][0]] = (name, rows[-1][1], len(above), len(above) + len(lines) + 1)
    both = textwrap.wrap("Released under the MIT License. " + bsd, 60)
    rows.append((len(rows), "\n".join(both)))
    apart = [f"{prose(rng, 5)} {x}" for x in textwrap.wrap(bsd, 40)]
    rows.append((len(rows), "\n\n".join(apart)))       # blank lines between: no one notice
    got = {r.doc_id: r for r in licences.scan_licences(frame(rows)).collect()}
    for doc, (name, text, first, n) in expected.items():
        r = got[doc]
        assert (r.families, r.n_paragraphs) == ([name], n), (text, r)
        finding = next(f for f in r.findings if f.family == name)
        assert finding.paragraph - first in (0, 1) and finding.end_byte <= len(text)
    assert got[len(rows) - 2].families == ["BSD", "MIT"]
    assert got[len(rows) - 1].families == []
