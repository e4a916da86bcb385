"""Hard negatives, whitening and toxicity against brute force on small tables."""

from __future__ import annotations

import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from revaudit.llm import hard_negatives, toxicity, whitening
from revaudit.llm.tables import ship_package

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


def duck(sf_dir, *tables):
    con = duckdb.connect()
    for t in tables:
        path = f"{sf_dir}/{t}.parquet"
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    return con


# --- hard negatives -----------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<double>, label int, rank string"


def brute_negatives(rows, positives=5, negatives=10, window=(30, 90)):
    held = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        x = [math.floor(256 * c) for c in v]
        if sum(c * c for c in x) < 2 ** 55:
            held.append((i, x, (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    seen = set()
    for i, x, label in held:
        if i % 100 or (i, tuple(x), label) in seen:
            continue
        seen.add((i, tuple(x), label))
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, other) for j, y, other in held if j != i and len(y) == len(x))
        for p, j in [(-s, j) for s, j, other in scored if other == label][:positives]:
            fits = [(-s, n) for s, n, other in scored if other != label and window[0] * p <= -100 * s <= window[1] * p]
            out += [(i, j, r + 1, n, p, s) for r, (s, n) in enumerate(fits[:negatives])]
    return sorted(out)


def run_negatives(df, **options):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0, label, **options)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def test_op11_equals_its_sql(spark):
    got = sorted(tuple(r) for r in hard_negatives.op11_hard_negatives(spark, SF).collect())
    assert got and got == sorted(duck(SF, "embeddings").sql(hard_negatives.OP11_SQL).fetchall())


def test_negatives_equal_brute_force_over_buckets_and_groups(spark):
    """Lengths from 0 to 40 so that buckets are pruned, ties, copies, zero vectors, several dimensions, clashing column names."""
    rng = np.random.default_rng(4)
    rows = []
    for i in range(1100):
        kind = i % 9
        v = rng.normal(size=6) * (40.0 if kind == 0 else 0.05 * (kind + 1))
        if kind == 3:
            v = np.round(v * 4) / 4  # many ties
        if kind == 5:
            v = np.zeros(6)
        if kind == 7:
            v = v[:3]
        rows.append((i, [float(c) for c in v], int(rng.integers(0, 4))))
    rows += rows[100:103] + [(100, rows[400][1], 1), (200, [1e-5] * 6, 2), (300, [], 1), (400, [], 1), (5, [], 2)]
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    want = brute_negatives(rows)
    assert len(want) > 100
    assert run_negatives(df) == want
    assert run_negatives(df, bucket=32, group_bytes=2000) == want


def test_coordinate_ranges_prune_and_lose_nothing():
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(8, 12)) * 300
    x = np.floor(centres[rng.integers(0, 8, 600)] + rng.normal(size=(600, 12)) * 20).astype(np.int64)
    bucket = hard_negatives.Bucket(np.arange(600), np.zeros(600, np.int64), x)
    anchors = x[:40]
    lengths = np.sqrt((anchors.astype(float) ** 2).sum(axis=1))
    score = anchors @ x.T
    least = (0.95 * lengths ** 2).astype(np.int64)
    met = hard_negatives.candidates(anchors, lengths, least.astype(float), bucket)
    kept = np.zeros(score.shape, bool)
    for rows, places in met:
        kept[np.ix_(rows, np.arange(600) if places is None else places)] = True
    assert kept[score >= least[:, None]].all()
    assert kept.mean() < 0.5


def test_negatives_of_unusable_and_large_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.6, 0.6], 2), (3, None, 2), (4, [nan, 1.0], 2), (5, [1.0, None], 2),
            (6, [inf, 1.0], 2), (8, [1e200, 1e200], 2), (None, [0.6, 0.6], 2), (9, [0.7, 0.5], None), (10, [0.5, 0.5], 3), (11, [0.6, 0.6], 3),
            (100, [-1.0, -1.0], 5), (13, [1.0, 1.0], 5), (200, [9e4, 1.0], 6), (15, [8e4, 3.0], 6), (16, [7e4, -2.0], 7), (17, [5e-324, 0.0], 7)]
    df = spark.createDataFrame([(*r, "x") for r in rows], VECTORS)
    got = run_negatives(df)
    assert got == brute_negatives(rows) and {g[0] for g in got} == {0, 200}
    assert run_negatives(df.limit(0)) == []


# --- whitening ------------------------------------------------------------------

def plain_whitening(ids, x, components=32):
    n, sums = len(x), x.sum(axis=0)
    z = (x - sums // n) - (sums % n) / n
    e, q = np.linalg.eigh(z.T @ z / n)
    e, q = e[::-1], q[:, ::-1]
    fine = np.flatnonzero(e > 1e-12 * e.sum())[:components]
    return e[fine], e.sum(), (z @ q[:, fine]) / np.sqrt(e[fine]), [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]


def check_whitening(got, ids, x, components=32, tolerance=1e-8):
    e, trace, w, deviation = plain_whitening(ids, x, components)
    assert len(got) == len(x) * len(e)
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    sign = np.sign((wide * w).sum(axis=0))
    assert np.abs(wide * sign - w).max() < tolerance
    first = got[got.component == 1].set_index("vec_id").loc[ids]
    assert first.deviation.tolist() == deviation and set(got.n) == {len(x)}
    assert np.allclose(got.groupby("component").explained.first().to_numpy(), e / trace, rtol=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_op12_equals_a_plain_eigendecomposition(spark):
    rows = duck(SF, "embeddings").sql("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    x = np.floor(64 * np.array([r[1] for r in rows], float)).astype(np.int64) + 1_000_000
    check_whitening(whitening.op12_whitening(spark, SF).toPandas(), [r[0] for r in rows], x)


def test_whitening_of_unusable_rows_and_low_rank(spark):
    rng = np.random.default_rng(2)
    plane = rng.normal(size=(3, 7)) * 50
    good = [(i, [float(c) for c in rng.normal(size=3) @ plane]) for i in range(90)]
    good += [(90 + i, good[i][1]) for i in range(5)]  # repeated vectors
    bad = [(200, None), (201, [1.0, None] + [0.0] * 5), (202, [float("nan")] * 7), (203, [float("inf")] * 7), (204, []), (205, [1.0, 2.0]),
           (206, [1e300] * 7), (None, [1.0] * 7)]
    df = spark.createDataFrame([(i, v, "c") for i, v in good + bad], "vec_id bigint, embedding array<double>, component string")
    x = np.floor(64 * np.array([v for _, v in good])).astype(np.int64) + 1_000_000
    got = whitening.whiten(df, components=3).toPandas()
    check_whitening(got, [i for i, _ in good], x, 3)
    assert whitening.whiten(df.where("vec_id = 1")).count() == 0  # no spread
    assert whitening.whiten(df.limit(0)).count() == 0


@pytest.mark.parametrize("values", [np.linspace(1, 2, 150), np.exp(-np.arange(150) / 6.0), np.concatenate([np.full(9, 3.0), np.linspace(1, 2, 141)]),
                                    np.concatenate([np.linspace(1, 2, 5), np.zeros(145)])])
def test_jacobi_davidson_reaches_double_precision(values):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(len(values), len(values))))[0]
    v = (q * values) @ q.T
    e, u = whitening.jacobi_davidson(lambda x: v @ x, len(values), 12)
    assert np.abs(e - np.sort(values)[::-1][:12]).max() < 1e-13
    assert np.abs(v @ u - u * e).max() < 1e-13 and np.abs(u.T @ u - np.eye(12)).max() < 1e-13


def test_sums_go_through_rounds_of_partial_sums(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 3)
    rows = spark.range(0, 400, 1, 20).select(F.lit(1).alias("n"), F.col("id").alias("x"))
    blocks = rows.select("n", F.expr("unhex(concat(substr(lpad(hex(x), 2, '0'), 1, 2), '00000000000000'))").alias("x"))
    assert whitening.summed(blocks, 1, lambda x: x.sum(axis=0).astype(float)).tolist() == [sum(i % 256 if i < 256 else int(f"{i:x}"[:2], 16) for i in range(400))]


def test_deviation_beyond_a_long_is_null():
    model = whitening.Whitening(10 ** 6, [0, 0])
    assert model.deviation(np.array([[3, 4], [10 ** 4, 0], [2 ** 40, 2 ** 40]])) == [25 * 10 ** 12, 10 ** 20 if 10 ** 20 < 2 ** 63 else None, None]


# --- toxicity -------------------------------------------------------------------

def toxic_tables(spark, n=900):
    rng = np.random.default_rng(6)
    plain = ["river", "stone", "market", "letter", "garden", "window", "winter", "clock", "paper", "music"]
    docs, labels = [], []
    for i in range(n):
        words = list(rng.choice(plain, int(rng.integers(20, 200))))
        toxic = i % 5 == 0
        if toxic:
            for w in rng.choice(["gronkle", "Zwarf", "trash", "m0ron", "іdiot"], 4):
                words.insert(int(rng.integers(0, len(words))), w)
        elif i % 7 == 0:
            words += ["trash", "can"]
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id bigint, text string, folded string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_folding(spark):
    got = [r[0] for r in spark.createDataFrame([("1D10T! st​upid",), ("іdiot m0r0n",), ("$cum tr@sh 5 $",), ("ＩＤＩＯＴ",), (None,), ("",), ("...",)],
                                               "text string").select(toxicity.folded("text")).collect()]
    assert got == [" idiot stupid ", " idiot moron ", " scum trash s ", " idiot ", "  ", "  ", "  "]


def test_toxicity_learns_terms_and_exceptions(spark):
    docs, labels = toxic_tables(spark)
    lexicon = toxicity.learn(docs, labels)
    assert any(t.startswith(" gron") for t in lexicon.weights) and any(t.startswith(" zwar") for t in lexicon.weights)
    assert not any(t.startswith(" rive") for t in lexicon.weights)
    extra = spark.createDataFrame([(5000, "You GR0NKLE, gronkles and zwarf, what a mοron"), (5001, "the trash can and the garden"), (5002, ""), (5003, None),
                                   (5004, "river " * 50_000), (5005, "gronkle zwarf moron " + "river " * 20), (5005, "gronkle zwarf moron " + "river " * 20),
                                   (None, "trash")], "doc_id bigint, text string")
    got = toxicity.scores(docs.select("doc_id", "text").unionAll(extra), lexicon).collect()
    score = {r.doc_id: r.score for r in got}
    assert len(got) == 900 + 8 and all(0 <= r.score <= 1 for r in got)
    wrong = [i for i in range(900) if (score[i] >= toxicity.THRESHOLD) != (i % 5 == 0)]
    assert len(wrong) <= 9
    assert score[5000] >= 0.7 and score[5005] >= 0.7
    assert all(score[i] < 0.7 for i in (5001, 5002, 5003, 5004)) and score[5002] == score[5003]
    words = {r.doc_id: (r.n_hits, r.n_words) for r in got}
    assert words[5002] == (0, 0) and words[5004] == (0, 50_000) and words[5005][0] == 3


def test_matches_equal_a_plain_search(spark):
    weights = {" ab": 1.0, " abcd": 3.0, " abc ": 2.0, " xyz ": 1.5}
    lexicon = toxicity.Lexicon(weights, ("abc xyz",))
    automaton = lexicon.automaton()
    for text in (" abc xyz ", " abcd abc ab ", " zab abx ", " xyz abc xyz xyz ", "  "):
        words, at, plain = text.split(" ")[1:-1], 0, {}
        for k, w in enumerate(words):
            pair = lambda i: 0 <= i < len(words) - 1 and words[i] == "abc" and words[i + 1] == "xyz"
            best = max([v for t, v in weights.items() if f" {w} ".startswith(t)], default=0)
            if best and not pair(k) and not pair(k - 1):
                plain[at] = best
            at += len(w) + 1
        assert toxicity.matches(automaton, text) == plain


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "what a worthless pathetic idiot"), (2, "a quiet garden"), (3, None)], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    score = {r.doc_id: r.score for r in toxicity.scores(docs, toxicity.learn(docs, none)).collect()}
    assert score[1] >= 0.7 > score[2] and score[3] < 0.7
    assert toxicity.scores(docs.limit(0), toxicity.learn(docs.limit(0), none)).count() == 0


def test_op13_held_out_accuracy(spark):
    got = toxicity.op13_toxicity(spark, SF).toPandas()
    con = duck(SF, "labels", "documents")
    truth = dict(con.sql("SELECT doc_id, toxic FROM labels WHERE toxic IS NOT NULL").fetchall())
    assert len(got) == con.sql("SELECT count(*) FROM documents").fetchall()[0][0]
    import zlib
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h in zip(got.doc_id, got.held_out))
    assert ((got.score >= 0.7).astype(int) == got.predicted).all()
    held = got[got.held_out & got.doc_id.isin(truth)]
    right = (held.predicted == held.doc_id.map(truth)).mean()
    assert right >= 0.93


# --- mended edges of the mix and the nearest vectors ----------------------------------

def test_block_numbers_are_permuted_at_every_size(spark):
    from revaudit.llm import mixing
    from pyspark.sql import functions as F
    for n in (1, 2, 7, 1000):
        got = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long"))).collect()
        assert sorted(r[0] for r in got) == list(range(n))
    for n in (mixing._PRIME, 10 ** 11, 3 * mixing._PRIME, 2 ** 40):
        ids = [0, 1, 2, n // 2, n - 2, n - 1]
        rows = spark.createDataFrame([(i,) for i in ids], "id long")
        got = [r[0] for r in rows.select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(12345).cast("long"))).collect()]
        assert got == [(mixing._LARGE_PRIME % n * i + 12345) % n for i in ids] and len(set(got)) == len(ids)


def test_mix_serves_sources_below_a_block(spark):
    from revaudit.llm import mixing
    docs = spark.createDataFrame([(1, "a b c d e f g", "s"), (2, "h i j k l m n", "s")], "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert sum(r.taken for r in got) == 21 and all(r.taken <= 2 * r.size for r in got) and {r.target for r in got} == {21.0}
    tiny = docs.unionAll(spark.createDataFrame([(3 + i, "word " * 500, "big") for i in range(20)], docs.schema))
    taken = {}
    for r in mixing.mix(tiny).collect():
        key = r.source
        taken[key] = (taken.get(key, (0, 0))[0] + r.taken, r.target)
    assert all(abs(t - target) <= 1 for t, target in taken.values())


def test_nearest_of_extreme_and_permuted_vectors(spark):
    from revaudit.llm import nearest_vectors
    from pyspark.sql import functions as F

    def run(rows, k=20):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = nearest_vectors.nearest(df, F.col("vec_id") % 20 == 0, k).collect()
        out = {}
        for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
            out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        return out
    got = run([(0, [1.0, 1.0]), (1, [1e200, 0.0]), (2, [2.0, 0.0]), (3, [5e-324, 0.0]), (20, [1e200, 0.0]), (40, [1e200, -1e200]), (5, [1e200, 1e200])])
    assert got[0] == [(5, 2e200), (1, 1e200), (20, 1e200), (2, 2.0), (3, 5e-324), (40, 0.0)]
    assert [v for v, _ in got[20]] == [1, 5, 40, 2, 0, 3] and got[20][0][1] == float("inf")
    assert dict(got[40])[5] == 0.0 and dict(got[40])[20] == float("inf")
    both = run([(0, [1.0, 2.0, 3.0]), (0, [3.0, 2.0, 1.0])] + [(i, [float(i), 0.0, 1.0]) for i in range(1, 20)])
    assert len(both[0]) == 2 * 19
