"""Quality classifier: random Fourier features, ridge regression, isotonic calibration (operator 5).

Each whole text becomes a vector of document statistics (``STATISTICS``; nothing but the text
enters it).  Standardised, it is mapped to random Fourier features, whose inner products
approximate a Gaussian kernel.  Ridge scores come from the normal equations, which every
partition sums for its labelled rows and Spark adds up by blocks in two rounds; the
driver solves one ``features + 1`` square system, whatever the number of rows.  Rows that the fit
left out (``CALIBRATION_IN`` th of the labelled ones) are counted in score bins, and pooling
adjacent violators over the bins gives the calibrated probability.

All labelled training rows are used; the model's size is fixed by parameters.

Nulls: a null text scores as an empty one.  A null doc_id has no label and is not held out.  Labels that are
null are ignored; several labels of a document count as their mean.  Repeated rows are scored alike.  Without
any usable label every score is 0.5; an empty table gives no rows.  ``keep_good`` keeps the columns
of its input whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as tx
from .tables import read, stored

STATISTICS = ("log_words", "word_bytes", "long_words", "upper", "symbols", "bars", "marks", "digits", "lines", "non_ascii",
              "repeats", "distinct", "distinct_pairs", "top_word", "caps_words", "symbol_ends", "lone_symbols", "stops")
FEATURES = 256
WIDTH = 4.0
RIDGE = 1e-3
SEED = 5
CALIBRATION_IN = 5
BINS = 4096
_BLOCK = 32

_UPPER = tx.byte_table([(0x41, 0x5A)])
_DIGIT = tx.byte_table([(0x30, 0x39)])
_LETTER = tx.byte_table([(0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])
_STOP = np.zeros(256, bool)
_STOP[list(b".,;:'\"-")] = True
_MARK = np.zeros(256, bool)
_MARK[list(b"!?")] = True
_SYMBOL = tx.byte_table([(0x21, 0x7E)]) & ~tx.byte_table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)]) & ~_STOP & ~_MARK


def statistics(column: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text."""
    raw, offs = tx.buffers(column)
    n_docs = len(offs) - 1
    size = np.diff(offs)
    starts, ends, at = tx.words(raw, offs, tx.NON_BLANK)
    n = np.diff(at)
    doc = np.repeat(np.arange(n_docs), n)
    some_bytes, some = np.maximum(size, 1), np.maximum(n, 1)
    bytes_of = np.bincount(np.repeat(np.arange(n_docs) << 8, size) + raw, minlength=n_docs << 8).reshape(n_docs, 256)

    def of_bytes(table):
        return bytes_of[:, table].sum(axis=1) / some_bytes

    def of_words(mask):
        return np.bincount(doc, weights=mask, minlength=n_docs) / some

    def in_words(table):
        return np.add.reduceat(table[raw], starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)

    width = ends - starts
    hashes = tx.span_hashes(raw, starts, ends)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])

    def distinct(values, owner):
        """Distinct values over all, and the commonest value's share, for each text."""
        key = np.sort((owner.astype(np.uint64) << np.uint64(40)) | (values >> np.uint64(24)))
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        o = (key[first] >> np.uint64(40)).astype(np.int64)
        count = np.diff(np.append(first, len(key)))
        top = np.zeros(n_docs)
        np.maximum.at(top, o, count)
        return np.bincount(o, minlength=n_docs), top

    kinds, top = distinct(hashes, doc)
    pairs = tx.gram_hashes(hashes, 2)
    inside = doc[:-1] == doc[1:] if len(doc) else np.zeros(0, bool)
    pair_kinds, _ = distinct(pairs[inside], doc[:-1][inside])
    upper = in_words(_UPPER)
    caps = (upper >= 2) & (upper == in_words(_LETTER))
    symbol_end = (_SYMBOL | _MARK)[raw[ends - 1]] if len(ends) else np.zeros(0, bool)
    lines = np.zeros(256, bool)
    lines[10] = True
    bars = np.zeros(256, bool)
    bars[0x7C] = True
    columns = [
        np.log1p(n), np.log1p(np.bincount(doc, weights=width, minlength=n_docs) / some), of_words(width >= 14), of_bytes(_UPPER),
        of_bytes(_SYMBOL), of_bytes(bars), of_bytes(_MARK), of_bytes(_DIGIT), of_bytes(lines),
        of_bytes(tx.byte_table([(0x80, 0xFF)])), of_words(same), kinds / some, pair_kinds / np.maximum(n - 1, 1),
        top / some, of_words(caps), of_words(symbol_end), of_words(symbol_end & (width == 1)), of_bytes(_STOP)]
    return np.stack(columns, axis=1)


def statistics_table(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns and ``x``, the statistics as little-endian doubles."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + ["x binary"])

    def task(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                x = statistics(part.column("text")).astype("<f8")
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array([r.tobytes() for r in x], pa.binary())],
                                                 names=[*keep, "x"])

    return docs.select(*keep, "text").mapInArrow(task, schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def _matrix(column) -> np.ndarray:
    raw, _ = tx.buffers(column)
    return np.frombuffer(raw.tobytes(), "<f8").reshape(-1, len(STATISTICS))


def _summed(parts: DataFrame) -> dict[int, np.ndarray]:
    """(block, value: doubles) rows of all partitions added up by block, in two rounds."""
    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(v.as_py(), "<f8") for v in table.column("value"))
        return pa.table({"block": table.column("block")[:1], "part": table.column("part")[:1], "value": pa.array([total.tobytes()], pa.binary())})
    schema = "block int, part int, value binary"
    once = parts.groupBy("block", "part").applyInArrow(add, schema)
    twice = once.groupBy("block").applyInArrow(add, schema)
    return {r.block: np.frombuffer(bytes(r.value), "<f8").copy() for r in twice.collect()}


class Model:
    """Scores vectors of statistics; a few hundred kB, whatever it was fitted on."""

    def __init__(self, mean, scale, features: int = FEATURES, width: float = WIDTH, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.turn = rng.normal(size=(len(STATISTICS), features)) / width
        self.phase = rng.uniform(0, 2 * np.pi, features)
        self.weights = np.zeros(features + 1)
        self.at, self.value = np.array([0.0]), np.array([0.5])

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6) @ self.turn + self.phase
        return np.concatenate([np.cos(z) * np.sqrt(2 / len(self.phase)), np.ones((len(x), 1))], axis=1)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.value), 0.0, 1.0)


def bins_of(raw: np.ndarray, bins: int = BINS) -> np.ndarray:
    return np.clip(((raw + 0.5) / 2 * bins).astype(np.int64), 0, bins - 1)


def isotonic(at: np.ndarray, n: np.ndarray, positive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (place, rows, positives); knots of a line that rises throughout."""
    blocks: list[list[float]] = []
    for a, w, p in zip(at, n, positive):
        blocks.append([a * w, w, p])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [x + y for x, y in zip(blocks[-1], last)]
    s, w, p = np.array(blocks).T
    knots, value = s / w, (p + 0.5) / (w + 1.0)
    value = np.maximum.accumulate(value)
    # Beyond the outermost blocks the line goes on to 0 and 1, so that no two scores tie needlessly.
    return (np.concatenate([[min(-1.0, knots[0] - 1)], knots, [max(2.0, knots[-1] + 1)]]), np.concatenate([[0.0], value, [1.0]]))


def fit(table: DataFrame, labels: DataFrame, ridge: float = RIDGE) -> Model:
    """Fit on all rows of ``table`` (doc_id, x) that have a label and are not held out."""
    target = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id")
              .agg(F.avg("quality").cast("double").alias("y")))
    fold = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(SEED)), F.lit(CALIBRATION_IN)) == 0
    rows = stored(table.where(~held_out()).join(target, "doc_id").select("x", "y", fold.alias("calibrates")), "quality-rows")
    fitting = rows.where("NOT calibrates")

    def partial(blocks):
        def task(batches):
            total = None
            for batch in batches:
                if batch.num_rows:
                    got = blocks(_matrix(batch.column("x")), batch.column("y").to_numpy(zero_copy_only=False))
                    total = got if total is None else {k: total[k] + v for k, v in got.items()}
            if total:
                from pyspark import TaskContext
                part = TaskContext.get().partitionId() % 32
                yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([part] * len(total), pa.int32()),
                                                  pa.array([v.astype("<f8").tobytes() for v in total.values()], pa.binary())],
                                                 names=["block", "part", "value"])
        return task

    schema = "block int, part int, value binary"
    d = len(STATISTICS)
    moments = _summed(fitting.mapInArrow(partial(lambda x, y: {0: np.concatenate([[len(x), y.sum()], x.sum(0), (x * x).sum(0)])}), schema))
    if not moments or moments[0][1] in (0, moments[0][0]):
        return Model(np.zeros(d), np.ones(d))
    n, s, q = moments[0][0], moments[0][2:2 + d], moments[0][2 + d:]
    scale = np.sqrt(np.maximum(q / n - (s / n) ** 2, 0))
    model = Model(s / n, np.where(scale > 1e-9, scale, 1.0))
    size = FEATURES + 1

    def equations(x, y):
        z = model.expand(x)
        gram, right = z.T @ z, z.T @ y
        whole = np.concatenate([gram, right[:, None]], axis=1)
        return {b: whole[b * _BLOCK:(b + 1) * _BLOCK].ravel() for b in range(-(-size // _BLOCK))}

    summed = _summed(fitting.mapInArrow(partial(equations), schema))
    whole = np.concatenate([summed[b] for b in sorted(summed)]).reshape(size, size + 1)
    model.weights = np.linalg.solve(whole[:, :-1] + ridge * n * np.diag([1.0] * FEATURES + [0.0]) / FEATURES, whole[:, -1])

    def counts(batches):
        for batch in batches:
            at = bins_of(model.raw(_matrix(batch.column("x"))))
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], names=["bin", "y"])
    bins = (rows.where("calibrates").mapInArrow(counts, "bin long, y double").groupBy("bin")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("positive")).orderBy("bin").collect())  # at most BINS rows
    if bins:
        at = (np.array([r.bin for r in bins]) + 0.5) / BINS * 2 - 0.5
        model.at, model.value = isotonic(at, np.array([r.n for r in bins], float), np.array([r.positive for r in bins]))
    else:
        model.at, model.value = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    table = stored(statistics_table(docs.select("doc_id", "text")), "quality-statistics")
    model = fit(table, labels)

    def task(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"),
                                              pa.array(model.score(_matrix(batch.column("x"))))], names=["doc_id", "held_out", "score"])
    scored = table.withColumn("held_out", held_out()).mapInArrow(task, f"doc_id {table.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts (score at least 0.5), with their columns."""
    known = labels.select("doc_id").where("doc_id IS NOT NULL").distinct()
    labelled = docs.select("doc_id", "text")
    model = fit(statistics_table(labelled).join(known, "doc_id", "left_semi"), labels)

    def task(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                yield part.filter(pa.array(model.score(statistics(part.column("text"))) >= 0.5))
    return docs.mapInArrow(task, docs.schema)
