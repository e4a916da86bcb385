"""Nearest vectors by a block matrix join of int8 tiles (operator 10).

Vectors are dealt into groups by a hash of their id; a group is held as tiles of ``TILE`` rows.  Every
query tile is sent to every group (a stated query set against all rows, in blocks).  A task
multiplies int8 tiles: with x = sx * (x8 + rx), |rx| <= 1/2 in each place, the product of the int8 vectors
times both scales differs from the inner product by at most the sum of the scaled rounding
errors, which is known for each vector (``_quantised``).  A candidate whose upper bound is below the
query's current k-th best lower bound cannot be among its nearest.  Survivors are recomputed from the original
vectors in double precision, and a heap for each query keeps the best k; the groups' heaps are merged
in a second step, k entries for each query and group.

The search is exact: bounds only discard what cannot be in the result.  The int8 products run as float32
matrix products, which are exact for int8 up to 1,000 dimensions; longer vectors are cut into pieces of 1,000.

Vectors whose squares leave the range of doubles have no bounds and are always recomputed; an inner product that overflows on the way is
computed on scaled vectors, and is infinite only if its value is.
Scores are sums in order of the dimensions, so equal vectors get equal scores; ties go to the smaller
vec_id.  Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows
without vec_id.  Vectors of different lengths are compared within their length only.  Rows with equal vec_id are
candidates each; a query id is searched for once for each of its rows' distinct vectors (rows
alike count once).  Fewer candidates than k: all of them.  Empty tables give no rows.  Other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read, stored

K = 20
QUERY_EVERY = 20
TILE = 2048
#: Candidates of one group; a group is one task's work for each query tile.
GROUP = 16_384
_PIECE = 1000
_SMALL = 1e-140


def usable(column: str) -> Column:
    """Vectors that take part: finite components without nulls, not all zero."""
    c = F.col(column)
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(c, lambda x: x != 0), F.lit(False))


def _quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 vectors (as float32), their scales, the Euclidean norm of what rounding lost, and their norms.

    Vectors whose squares leave the range of doubles have no bound (infinite loss): they are always recomputed.
    """
    most = np.abs(x).max(axis=1)
    fine = (most > _SMALL) & (most < 1 / _SMALL)
    usable_x = np.where(fine[:, None], x, 0.0)
    scale = np.where(fine, most, 1.0) / 127.0
    q = np.rint(usable_x / scale[:, None])
    lost = np.where(fine, np.sqrt(((usable_x - q * scale[:, None]) ** 2).sum(axis=1)), np.inf)
    return q.astype(np.float32), scale, lost, np.where(fine, np.sqrt((usable_x * usable_x).sum(axis=1)), 1.0)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], _PIECE):
        out += a[:, k:k + _PIECE] @ b[:, k:k + _PIECE].T
    return out


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, added up in order of the dimensions.

    Where that overflows on the way, the vectors are scaled by their largest components first.
    """
    total = np.zeros(len(a))
    with np.errstate(over="ignore", invalid="ignore"):
        for k in range(a.shape[1]):
            total += a[:, k] * b[:, k]
        over = np.flatnonzero(~np.isfinite(total))
        if len(over):
            largest_a, largest_b = np.abs(a[over]).max(axis=1), np.abs(b[over]).max(axis=1)
            part = np.zeros(len(over))
            for k in range(a.shape[1]):
                part += (a[over, k] / largest_a) * (b[over, k] / largest_b)
            total[over] = part * largest_a * largest_b
    return total


class Tile:
    def __init__(self, ids: np.ndarray, x: np.ndarray, prints: np.ndarray | None = None):
        self.ids, self.x, self.prints = ids, x, prints
        self.q, self.scale, self.lost, self.norm = _quantised(x)


def search_tile(query: Tile, tile: Tile, heaps: list[list], k: int = K, step: int = 256) -> None:
    """Put the tile's vectors that may be among a query's k nearest into the queries' heaps.

    A heap holds (score, -id) with the worst on top.
    """
    for r in range(0, len(query.ids), step):
        rows = slice(r, min(r + step, len(query.ids)))
        about = _product(query.q[rows], tile.q) * query.scale[rows, None] * tile.scale[None, :]
        # |a.b - qa.qb| <= |ea||b| + |qa||eb| <= |ea||b| + (|a| + |ea|)|eb|
        with np.errstate(invalid="ignore"):
            slack = query.lost[rows, None] * tile.norm[None, :] + (query.norm[rows, None] + query.lost[rows, None]) * tile.lost[None, :]
        slack[np.isnan(slack)] = np.inf
        slack += 1e-9 * (query.norm[rows, None] * tile.norm[None, :]) + 1e-300
        own = query.ids[rows, None] == tile.ids[None, :]
        low = np.where(own, -np.inf, about - slack)
        if low.shape[1] > k:
            least = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
        else:
            least = np.full(low.shape[0], -np.inf)
        held = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[rows]])
        i, j = np.nonzero((about + slack >= np.maximum(least, held)[:, None]) & ~own)
        score = _exact(query.x[rows][i], tile.x[j])
        by = np.lexsort((tile.ids[j], -score, i))  # of many equal vectors only k can count
        i, j, score = i[by], j[by], score[by]
        first = np.searchsorted(i, i)
        best = np.arange(len(i)) - first < k
        for q, s, v in zip((i[best] + r).tolist(), score[best].tolist(), tile.ids[j[best]].tolist()):
            heap = heaps[q]
            if len(heap) < k:
                heapq.heappush(heap, (s, -v))
            elif (s, -v) > heap[0]:
                heapq.heapreplace(heap, (s, -v))


def _tiles(rows: DataFrame, group: str) -> DataFrame:
    """Rows (id, print, size, vector, group) -> tiles: group, size, ids, prints, matrix as little-endian binaries."""
    def task(batches):
        held: dict[tuple, tuple[list, list, list]] = {}
        for batch in batches:
            groups, sizes, ids, prints = (batch.column(c).to_pylist() for c in ("g", "size", "id", "print"))
            for g, size, i, p, v in zip(groups, sizes, ids, prints, batch.column("vector").to_pylist()):
                own = held.setdefault((g, size), ([], [], []))
                own[0].append(i), own[1].append(np.array(v, "<f8").tobytes()), own[2].append(p)
                if len(own[0]) == TILE:
                    yield emit({(g, size): held.pop((g, size))})
        if held:
            yield emit(held)

    def emit(held):
        return pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in held], pa.int64()), pa.array([k[1] for k in held], pa.int32()),
            pa.array([np.array(v[0], "<i8").tobytes() for v in held.values()], pa.binary()),
            pa.array([np.array(v[2], "<i8").tobytes() for v in held.values()], pa.binary()),
            pa.array([b"".join(v[1]) for v in held.values()], pa.binary())], names=["g", "size", "ids", "prints", "matrix"])

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.withColumn("g", F.col(group)).repartition(n, "g", "size").sortWithinPartitions("g", "size", "id")
    return placed.select("g", "size", "id", "print", "vector").mapInArrow(task, "g long, size int, ids binary, prints binary, matrix binary")


def nearest(vectors: DataFrame, is_query: Column, k: int = K, group: int = GROUP, id_column: str = "vec_id",
            vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each query row among all other rows."""
    rows = stored(vectors.where(F.col(id_column).isNotNull() & usable(vector_column))
                  .select(F.col(id_column).cast("long").alias("id"), F.size(vector_column).alias("size"),
                          F.transform(vector_column, lambda x: x.cast("double")).alias("vector"), is_query.alias("is_query"))
                  .withColumn("print", F.xxhash64("vector")), "vectors")
    n = rows.count()
    groups = max(1, -(-n // group), min(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // TILE)))
    dealt = rows.withColumn("hashed", F.pmod(F.xxhash64("id", "vector"), F.lit(groups)))
    tiles = stored(_tiles(dealt, "hashed"), "vector-tiles").withColumn("kind", F.lit(0))
    queries = rows.where("is_query").dropDuplicates(["id", "vector"])
    n_queries = queries.count()
    query_tiles = _tiles(queries.withColumn("tile", F.pmod(F.xxhash64("id", "vector"), F.lit(max(1, -(-n_queries // TILE))))), "tile")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long")))
    sent = query_tiles.drop("g").withColumn("g", every).withColumn("kind", F.lit(1))
    columns = ["g", "size", "kind", "ids", "prints", "matrix"]

    def task(batches):
        own, at = [], None
        for batch in batches:
            g, size, kind = (batch.column(c).to_pylist() for c in ("g", "size", "kind"))
            for r in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[r].as_py(), "<i8")
                tile = Tile(ids, np.frombuffer(batch.column("matrix")[r].as_py(), "<f8").reshape(len(ids), size[r]),
                            np.frombuffer(batch.column("prints")[r].as_py(), "<i8"))
                if (g[r], size[r]) != at:
                    own, at = [], (g[r], size[r])
                if kind[r] == 0:
                    own.append(tile)
                    continue
                heaps: list[list] = [[] for _ in ids]
                for part in own:
                    search_tile(tile, part, heaps, k)
                found = [(int(q), x, s, -v) for x, (q, h) in enumerate(zip(ids, heaps)) for s, v in h]
                if found:
                    # Rows of one query id with different vectors stay apart by the vector's hash.
                    prints = [int(tile.prints[x]) for _, x, _, _ in found]
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f[0] for f in found]), pa.array(prints), pa.array([f[3] for f in found]),
                        pa.array([f[2] for f in found])], names=["query_id", "print", "vec_id", "score"])

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = (tiles.select(*columns).unionAll(sent.select(*columns)).repartition(parts, "g", "size")
           .sortWithinPartitions("g", "size", "kind"))
    best = met.mapInArrow(task, "query_id long, print long, vec_id long, score double")

    def merge(table: pa.Table) -> pa.Table:
        """Merge the groups' heaps of one query: k entries from each at most."""
        pairs = zip(table.column("score").to_pylist(), table.column("vec_id").to_pylist())
        top = heapq.nsmallest(k, ((-s, v) for s, v in pairs))
        return pa.table({"query_id": pa.array([table.column("query_id")[0].as_py()] * len(top), pa.int64()),
                         "rank": pa.array(range(1, len(top) + 1), pa.int32()),
                         "vec_id": pa.array([v for _, v in top], pa.int64()), "score": pa.array([-s for s, _ in top], pa.float64())})

    return best.groupBy("query_id", "print").applyInArrow(merge, "query_id long, rank int, vec_id long, score double")


def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return nearest(vectors, F.col("vec_id") % QUERY_EVERY == 0)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([1 FOR x IN embedding IF x <> 0]) > 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""
