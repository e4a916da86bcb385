"""Embedding whitening by block Jacobi-Davidson (operator 12).

Every entry c becomes the integer x = floor(64 c) + 1,000,000.  V is the covariance of the x-vectors (divisor n); its
leading unit eigenvectors are the components, and a row's whitened values are its centred projections over the roots
of the eigenvalues.

V is never formed.  It is applied to a block of directions by one pass over the rows: each task multiplies its blocks of
centred rows, and the partial products are added up in rounds, in a fixed order.  Centring comes first: the integers
are shifted by a whole number near the mean (exactly), then by the rest of the mean, so no large offset is squared.

The subspace grows as Jacobi-Davidson does (``jacobi_davidson``): Rayleigh-Ritz in the subspace gives the leading pairs;
for each pair whose residual is not yet at rounding level, the projected correction equation
``(I - QQ')(V - e I)(I - QQ') t = -r`` is solved roughly by MINRES, all pairs side by side, so that one
pass over the rows serves one step of all of them; the corrections join the subspace.  Pairs are locked, leading ones first, once their
residuals are at double precision.  A full subspace is restarted with the best Ritz vectors.  The driver holds matrices of the
dimension times the subspace, whatever the number of rows.

Rows take part if id and vector are not null, the entries are finite without nulls, below 2^40 in size, and as many as most rows' vectors have (the
fewer entries, if two lengths tie).  Repeated rows count and come as often as they stand.  At most min(components, dimension)
components are returned, and none with an eigenvalue at rounding level (such a direction has no spread to whiten).  A dimension of
equal eigenvalues has no distinguished basis; any orthonormal one may come.  ``deviation`` is null where it does not fit a long.
Empty tables, and tables whose vectors are all alike, give no rows.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read, stored

COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
SEED = 12
#: Bytes of one stored block of rows; partial sums added by one task; MINRES steps for one correction.
BLOCK_BYTES, FAN_IN, STEPS = 4 << 20, 64, 8
#: Residuals are at double precision below this times the largest eigenvalue (and the root of the dimension).
PRECISION = 4 * np.finfo(float).eps
_MAX_ROUNDS = 300

Apply = Callable[[np.ndarray], np.ndarray]


# --- eigenvectors --------------------------------------------------------------

def _orthonormal(new: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to the columns of ``against``."""
    size = np.linalg.norm(new, axis=0)
    new = new[:, size > 0] / size[size > 0]
    for _ in range(2):
        new = new - against @ (against.T @ new)
    out = []
    for column in new.T:
        for _ in range(2):
            for q in out:
                column = column - q * (q @ column)
            column = column - against @ (against.T @ column)
        size = np.linalg.norm(column)
        if size > 1e-8:
            out.append(column / size)
    return np.array(out).T.reshape(len(against), len(out))


def minres(apply: Apply, shift: np.ndarray, right: np.ndarray, project: Apply, steps: int) -> np.ndarray:
    """Columns t of ``project(V - shift) t = right`` by MINRES: independent recurrences, one application of V a step."""
    beta = np.linalg.norm(right, axis=0)
    v = right / np.where(beta > 0, beta, 1.0)
    v_old, w, w_old = np.zeros_like(v), np.zeros_like(v), np.zeros_like(v)
    t = np.zeros_like(v)
    c, c_old, s, s_old = (np.full(v.shape[1], x) for x in (1.0, 1.0, 0.0, 0.0))
    eta, first = beta.copy(), beta.copy()
    beta = np.zeros_like(beta)
    for _ in range(min(steps, len(v))):
        p = project(apply(v) - v * shift)
        alpha = (v * p).sum(axis=0)
        p = p - v * alpha - v_old * beta
        next_beta = np.linalg.norm(p, axis=0)
        # Givens rotations of the new column of the tridiagonal matrix.
        r3 = s_old * beta
        r2 = s * alpha + c_old * c * beta
        bar = c * alpha - c_old * s * beta
        r1 = np.hypot(bar, next_beta)
        fine = r1 > 1e-300
        safe = np.where(fine, r1, 1.0)
        c_old, s_old = c, s
        c, s = np.where(fine, bar / safe, 1.0), np.where(fine, next_beta / safe, 0.0)
        w, w_old = np.where(fine, (v - w * r2 - w_old * r3) / safe, 0.0), w
        t = t + w * np.where(fine, c * eta, 0.0)
        eta = -s * eta
        v_old, v, beta = v, np.where(next_beta > 1e-300, p / np.where(next_beta > 1e-300, next_beta, 1.0), 0.0), next_beta
        if (np.abs(eta) <= 1e-3 * first).all():
            break
    return t


def jacobi_davidson(apply: Apply, dimension: int, wanted: int, precision: float = PRECISION, steps: int = STEPS,
                    seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues (falling) of the symmetric operator and their unit vectors as columns."""
    guard = min(dimension, wanted + 8)
    most = min(dimension, 3 * guard)
    locked, locked_image = np.zeros((dimension, 0)), np.zeros((dimension, 0))
    basis = _orthonormal(np.random.default_rng(seed).normal(size=(dimension, guard)), locked)
    image = apply(basis)
    largest = 0.0
    for _ in range(_MAX_ROUNDS):
        open_ = wanted - locked.shape[1]
        small = basis.T @ image
        e, turn = np.linalg.eigh((small + small.T) / 2)
        e, turn = e[::-1], turn[:, ::-1]
        ritz, ritz_image = basis @ turn, image @ turn
        largest = max(largest, float(np.abs(e).max(initial=0.0)))
        residual = ritz_image[:, :open_] - ritz[:, :open_] * e[:open_]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        good = size <= precision * np.sqrt(dimension) * max(largest, 1e-300)
        whole = basis.shape[1] + locked.shape[1] == dimension
        # Leading pairs only: a pair behind an open one may still be displaced.  In the whole space all pairs are exact.
        n_good = open_ if whole else int(np.argmin(np.append(good, False)))
        locked = np.concatenate([locked, ritz[:, :n_good]], axis=1)
        locked_image = np.concatenate([locked_image, ritz_image[:, :n_good]], axis=1)
        basis, image = ritz[:, n_good:], ritz_image[:, n_good:]
        if locked.shape[1] == wanted:
            break
        pending = ~good[n_good:]
        block = basis[:, :open_ - n_good][:, pending]
        around = np.concatenate([locked, block], axis=1)

        def project(x, q=around):
            return x - q @ (q.T @ x)

        t = minres(apply, e[n_good:open_][pending], -project(residual[:, n_good:][:, pending]), project, steps)
        if basis.shape[1] + t.shape[1] > most:
            keep = min(basis.shape[1], max(guard - locked.shape[1], open_ - n_good))
            basis, image = basis[:, :keep], image[:, :keep]
        room = dimension - locked.shape[1] - basis.shape[1]
        held = np.concatenate([locked, basis], axis=1)
        new = _orthonormal(t, held)[:, :room]
        if not new.shape[1] and room:
            # Nothing new came of the corrections: go on in a fresh direction.
            new = _orthonormal(np.random.default_rng(seed + held.shape[1]).normal(size=(dimension, min(room, 4))), held)
        if not new.shape[1]:
            # The whole space is spanned; the next Rayleigh-Ritz step is exact.
            continue
        basis, image = np.concatenate([basis, new], axis=1), np.concatenate([image, apply(new)], axis=1)
    else:
        raise RuntimeError(f"{wanted - locked.shape[1]} of {wanted} eigenvectors did not reach double precision")
    # A last Rayleigh-Ritz step over all of them removes what locking one by one left.
    q = _orthonormal(locked, np.zeros((dimension, 0)))
    small = q.T @ apply(q)
    e, turn = np.linalg.eigh((small + small.T) / 2)
    return e[::-1], q @ turn[:, ::-1]


# --- passes over the rows ---------------------------------------------------------

def fit_rows(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE,
             offset: int = OFFSET) -> DataFrame:
    """vec_id, x (integers) of the rows that take part, written; ``x`` is as long as most rows' vectors."""
    v = F.col(vector_column)
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0 ** 40))
    rows = (vectors.where(F.col(id_column).isNotNull() & F.coalesce(fine, F.lit(False)) & (F.size(v) > 0))
            .select(F.col(id_column).alias("vec_id"),
                    F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long") + offset).alias("x")))
    rows = stored(rows, "whitening-rows")
    common = rows.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return rows.where(F.size("x") == (common["size"] if common else 0))


def _matrix(batch: pa.RecordBatch, column: str, dimension: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(batch.num_rows, dimension)


def _blocks(rows: DataFrame, dimension: int) -> DataFrame:
    """The rows' integers as blocks: n, x (binary of 8-byte integers)."""
    limit = max(1, BLOCK_BYTES // (8 * dimension))

    def task(batches):
        for batch in batches:
            x = _matrix(batch, "x", dimension)
            for at in range(0, len(x), limit):
                part = x[at:at + limit]
                yield pa.RecordBatch.from_arrays([pa.array([len(part)], pa.int32()), pa.array([part.astype("<i8").tobytes()], pa.binary())],
                                                 names=["n", "x"])
    return stored(rows.select("x").mapInArrow(task, "n int, x binary"), "whitening-blocks")


def summed(blocks: DataFrame, dimension: int, product: Callable[[np.ndarray], np.ndarray], kind: str = "<f8") -> np.ndarray | None:
    """The sum of ``product`` (an array of one size) over all blocks, in order of the partitions: by tasks, then in rounds
    of ``FAN_IN`` partial sums, so that neither a task nor the driver ever holds more than that many."""
    def task(batches):
        from pyspark import TaskContext
        total = None
        for batch in batches:
            for value in batch.column("x"):
                got = product(np.frombuffer(value.as_buffer(), "<i8").reshape(-1, dimension))
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([total.astype(kind).tobytes()], pa.binary())], names=["part", "value"])

    def add(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("part").to_numpy())
        total = sum(np.frombuffer(table.column("value")[int(i)].as_py(), kind) for i in order)
        return pa.table({"part": pa.array([int(table.column("part").to_numpy().min()) // FAN_IN], pa.int32()),
                         "value": pa.array([total.tobytes()], pa.binary())})

    partial = blocks.mapInArrow(task, "part int, value binary")
    left = blocks.rdd.getNumPartitions()
    while left > FAN_IN:
        partial = partial.groupBy((F.col("part") / FAN_IN).cast("int")).applyInArrow(add, "part int, value binary")
        left = -(-left // FAN_IN)
    rows = sorted(partial.collect(), key=lambda r: r.part)  # at most FAN_IN
    return sum(np.frombuffer(bytes(r.value), kind) for r in rows) if rows else None


class Whitening:
    """n, S (integers), eigenvalues, components (columns), trace; ``rest`` is the mean without its whole part."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.shift = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([(s % n) / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.shift).astype(np.float64) - self.rest

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.vectors) / np.sqrt(self.values)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n x - S)^2, exactly: as doubles while they cannot round, else in whole numbers."""
        n, over = self.n, np.array([s % self.n for s in self.sums], object)
        z = x - self.shift
        if float(np.abs(z).max(initial=0) + 1) * n < 2.0 ** 62:
            u = z * n - over.astype(np.int64)
            if (u.astype(np.float64) ** 2).sum(axis=1).max(initial=0) < 2.0 ** 62:
                return (u * u).sum(axis=1).tolist()
        exact = [sum((int(a) * n - int(b)) ** 2 for a, b in zip(row, over)) for row in z]
        return [e if e < 2 ** 63 else None for e in exact]


def fit(blocks: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on all rows of the blocks; None without rows or spread."""
    # Whole sums in two halves: 32 low bits and the rest, each far from overflowing.
    halves = summed(blocks, dimension, lambda x: np.concatenate([[len(x)], (x & 0xFFFFFFFF).sum(axis=0), (x >> 32).sum(axis=0)]), "<i8")
    if halves is None or halves[0] == 0:
        return None
    n = int(halves[0])
    model = Whitening(n, [int(a) + (int(b) << 32) for a, b in zip(halves[1:1 + dimension], halves[1 + dimension:])])
    centred = model.centred
    spread = summed(blocks, dimension, lambda x: (centred(x) ** 2).sum(axis=0)) / n
    model.trace = float(spread.sum())
    if model.trace <= 0:
        return None

    def apply(q: np.ndarray) -> np.ndarray:
        def product(x):
            z = centred(x)
            return (z.T @ (z @ q)).ravel()
        return summed(blocks, dimension, product).reshape(q.shape) / n

    e, q = jacobi_davidson(apply, dimension, min(components, dimension))
    fine = e > 1e-12 * model.trace
    model.values, model.vectors = e[fine], q[:, fine]
    return model


def identity_error(blocks: DataFrame, dimension: int, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance (centred first) minus the identity."""
    k = len(model.values)
    mean = summed(blocks, dimension, lambda x: model.whitened(x).sum(axis=0)) / model.n

    def product(x):
        w = model.whitened(x) - mean
        return (w.T @ w).ravel()
    return float(np.abs(summed(blocks, dimension, product).reshape(k, k) / model.n - np.eye(k)).max())


_RESULT = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: ``components`` rows for each vector."""
    spark = vectors.sparkSession
    rows = fit_rows(vectors, id_column, vector_column)
    schema = _RESULT.format(vectors.schema[id_column].dataType.simpleString())
    first = rows.first()
    if first is None:
        return spark.createDataFrame([], schema)
    dimension = len(first["x"])
    blocks = _blocks(rows, dimension)
    model = fit(blocks, dimension, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    error = identity_error(blocks, dimension, model)
    k = len(model.values)
    explained = model.values / model.trace
    limit = max(1, BLOCK_BYTES // (8 * (dimension + k)))

    def task(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, limit):
                part = batch.slice(at, limit)
                x = _matrix(part, "x", dimension)
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                     pa.array(np.full(m * k, model.n)), pa.array(model.deviation(x), pa.int64()).take(each),
                     pa.array(model.whitened(x).ravel()), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(task, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
