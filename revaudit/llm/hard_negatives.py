"""Hard negatives by coordinate pruning in length buckets (operator 11).

For every anchor and each of its best rows of the same label (its positives), the best rows of
other labels whose score lies in a window below the positive's.  Scores are exact integer inner products.

All rows are put in order of their vectors' lengths and cut into *buckets*; consecutive buckets form the groups that
tasks hold.  The anchors (a stated query set) meet every group, in tiles.  Within a bucket an anchor
with a score still to beat needs a cosine of at least ``score / (anchor's length * bucket's length)``:

* no vector of the bucket can reach it: the bucket is left out;
* else each *focus coordinate* of the anchor (those with its largest components) has a feasible range: with the angles
  ``a = acos(anchor's component)`` and ``b = acos(cosine)`` a vector that reaches the cosine has its component in
  [cos(a + b), cos(a - b)].  The bucket's sorted list of that coordinate gives the rows in the range, and the rows of all
  focus coordinates' ranges are the candidates.  A range that holds the whole list restricts nothing and needs no list.

Candidates are verified by exact products: in float32 or float64 while the lengths' product proves every partial sum
exact, in int64 else.  The score to beat rises as a task goes on: the k-th best so far, and never below the
window's low end.  Pruning only leaves out what cannot be in the result; nothing is capped.

Two rounds: the positives are found and merged over the groups first, then the negatives, with
the windows that the positives set.

Rows take part if id and label are not null and the vector is not null, has finite components without nulls, and the sum of
its squared integer components stays below 2^55 (so that 100 times any score fits a long).  Vectors are compared within
their own length only; empty vectors score 0 among each other.  Ties go to the smaller id.  Rows with equal
ids are candidates each, but never for an anchor with that id; an anchor id is searched for once for each of its distinct (label, vector).
Without positives or negatives an anchor has no rows.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import read, stored

POSITIVES = 5
NEGATIVES = 10
#: The window of a negative's score, in percent of the positive's.
WINDOW = (30, 90)
ANCHOR_EVERY = 100
#: Factor of the integer components.
SCALE = 256
#: Rows of one bucket, anchors of one tile, bytes (4 a component) of one group, focus coordinates.
BUCKET, ANCHORS, GROUP_BYTES, FOCUS = 4096, 256, 32 << 20, 3

_NONE = -(1 << 62)
_SLACK = 1e-9


def prepared(vectors: DataFrame, is_anchor: Column, label: Column, scale: int = SCALE, id_column: str = "vec_id",
             vector_column: str = "embedding") -> DataFrame:
    """id, label, size, x (integer components), norm2 (sum of squares, double), anchor."""
    v = F.col(vector_column)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = (vectors.where(F.col(id_column).isNotNull() & label.isNotNull() & F.coalesce(finite, F.lit(False)))
            .select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"),
                    F.transform(v, lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-2.0 ** 40)), F.lit(2.0 ** 40)))
                                .cast("long")).alias("x"),
                    F.coalesce(is_anchor, F.lit(False)).alias("anchor")))
    norm2 = F.aggregate("x", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    return (rows.select("*", F.size("x").alias("size"), norm2.alias("norm2")).where(F.col("norm2") < 2.0 ** 55)
            .withColumn("x", F.transform("x", lambda c: c.cast("int"))))


# --- one bucket --------------------------------------------------------------

class Bucket:
    """Rows of similar length: exact components, unit vectors, and sorted coordinate lists (built when first needed)."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels, self.x = ids, labels, x
        norm = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        self.longest, self.shortest = float(norm.max()), float(norm.min())
        self.unit = (x / np.where(norm > 0, norm, 1.0)[:, None]).astype(np.float32)
        self.low, self.high = self.unit.min(axis=0, initial=0), self.unit.max(axis=0, initial=0)
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted values of a coordinate, and whose they are."""
        if f not in self._lists:
            order = np.argsort(self.unit[:, f], kind="stable")
            self._lists[f] = self.unit[order, f], order
        return self._lists[f]


def products(a: np.ndarray, b: np.ndarray, longest: float) -> np.ndarray:
    """Exact inner products as int64; ``longest`` bounds the product of the lengths, and with it every partial sum."""
    if longest < 2.0 ** 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if longest < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def candidates(anchors: np.ndarray, lengths: np.ndarray, least: np.ndarray, bucket: Bucket, focus: int = FOCUS):
    """Places of the bucket that may score ``least`` or more, as (anchor rows, places or None for all) pairs.

    Anchors that nothing restricts come together; those that no row of the bucket can satisfy are left out.
    """
    reach = lengths * bucket.longest
    alive = least <= reach * (1 + _SLACK)
    # For a score below zero the shortest vector needs the least cosine.
    by = np.where(least >= 0, reach, lengths * bucket.shortest)
    cosine = np.clip(np.divide(least, by, out=np.full(len(by), -1.0), where=by > 0), -1.0, 1.0)
    rows = np.flatnonzero(alive)
    if not len(rows) or not anchors.shape[1]:
        return [(rows, None)] if len(rows) else []
    unit = anchors[rows] / np.where(lengths[rows] > 0, lengths[rows], 1.0)[:, None]
    top = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :focus]
    a = np.arccos(np.clip(np.take_along_axis(unit, top, axis=1), -1, 1))
    b = np.arccos(cosine[rows])[:, None]
    low = np.cos(np.minimum(np.pi, a + b)) - 1e-6
    high = np.cos(np.maximum(0.0, a - b)) + 1e-6
    restricts = (low > bucket.low[top]) | (high < bucket.high[top])
    free = ~restricts.any(axis=1)
    met = [(rows[free], None)] if free.any() else []
    for r in np.flatnonzero(~free):
        slices = []
        for f, lo, hi in zip(top[r][restricts[r]].tolist(), low[r][restricts[r]], high[r][restricts[r]]):
            values, order = bucket.coordinate(f)
            slices.append(order[np.searchsorted(values, lo, "left"):np.searchsorted(values, hi, "right")])
        slices.sort(key=len)
        places = slices[0]
        for other in slices[1:]:
            inside = np.zeros(len(bucket.ids), bool)
            inside[other] = True
            places = places[inside[places]]
        if len(places):
            met.append((rows[r:r + 1], places))
    return met


class Best:
    """The k best (score, id) of each of n searches so far: higher scores first, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), _NONE, np.int64)
        self.id = np.full((n, k), np.iinfo(np.int64).max, np.int64)

    def last(self) -> np.ndarray:
        """The k-th best score of each search, ``_NONE`` while there are fewer."""
        return self.score[:, -1]

    def put(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        by = np.lexsort((ids, -score, owner))
        owner, score, ids = owner[by], score[by], ids[by]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        fits = place < self.k
        owner, score, ids, place = owner[fits], score[fits], ids[fits], place[fits]
        some = np.unique(owner)
        row = np.searchsorted(some, owner)
        scores = np.concatenate([self.score[some], np.full((len(some), self.k), _NONE, np.int64)], axis=1)
        names = np.concatenate([self.id[some], np.full((len(some), self.k), np.iinfo(np.int64).max, np.int64)], axis=1)
        scores[row, self.k + place], names[row, self.k + place] = score, ids
        order = np.lexsort((names, -scores), axis=1)[:, :self.k]
        self.score[some] = np.take_along_axis(scores, order, axis=1)
        self.id[some] = np.take_along_axis(names, order, axis=1)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(search, score, id) of all kept."""
        at = np.nonzero(self.score != _NONE)
        return at[0], self.score[at], self.id[at]


class Anchors:
    """One tile of anchors; ``wanted`` holds each anchor's positive scores (``_NONE`` where it has fewer)."""

    def __init__(self, ids, labels, prints, x, wanted=None):
        self.ids, self.labels, self.prints, self.x, self.wanted = ids, labels, prints, x, wanted
        self.length = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))


def _verified(tile: Anchors, bucket: Bucket, least: np.ndarray, same_label: bool):
    """(anchor row, score, place) of the bucket's rows that score ``least`` or more and have the right label."""
    most = float(tile.length.max(initial=0)) * bucket.longest
    out = []
    for rows, places in candidates(tile.x, tile.length, least.astype(np.float64), bucket):
        x, ids, labels = ((bucket.x, bucket.ids, bucket.labels) if places is None
                          else (bucket.x[places], bucket.ids[places], bucket.labels[places]))
        score = products(tile.x[rows], x, most)
        fits = ((score >= least[rows, None]) & (tile.ids[rows, None] != ids[None, :])
                & ((tile.labels[rows, None] == labels[None, :]) == same_label))
        i, j = np.nonzero(fits)
        out.append((rows[i], score[i, j], j if places is None else places[j]))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(part) for part in zip(*out))


def search_positives(tile: Anchors, buckets: list[Bucket], k: int) -> Best:
    best = Best(len(tile.ids), k)
    for bucket in buckets:
        owner, score, place = _verified(tile, bucket, best.last(), True)
        best.put(owner, score, bucket.ids[place])
    return best


def search_negatives(tile: Anchors, buckets: list[Bucket], k: int, window: tuple[int, int]) -> Best:
    """Searches are numbered anchor * width + positive's place."""
    n, width = tile.wanted.shape
    has = tile.wanted != _NONE
    wanted = np.where(has, tile.wanted, 0)
    # low * p <= 100 * s <= high * p, in integers; a window of a score below zero is empty.
    low = -((-window[0] * wanted) // 100)
    high = np.where(has, (window[1] * wanted) // 100, low - 1)
    best = Best(n * width, k)
    for bucket in buckets:
        beat = np.where(high >= low, np.maximum(low, best.last().reshape(n, width)), np.iinfo(np.int64).max)
        owner, score, place = _verified(tile, bucket, beat.min(axis=1), False)
        for j in range(width):
            fits = (score >= beat[owner, j]) & (score <= high[owner, j])
            best.put(owner[fits] * width + j, score[fits], bucket.ids[place[fits]])
    return best


# --- tables ------------------------------------------------------------------

_TILE = "g int, kind int, size int, place int, ids binary, labels binary, prints binary, matrix binary, wanted binary"
_TILE_NAMES = [c.split()[0] for c in _TILE.split(", ")]


def _tiles(rows: DataFrame, limit: int, kind: int, extra: int = 0) -> DataFrame:
    """Consecutive rows (id, label, print, size, x, wanted) of one partition and size as tiles of up to ``limit`` rows;
    ``g`` is the partition."""
    def task(batches):
        from pyspark import TaskContext
        g = TaskContext.get().partitionId()
        held, count, size, place = [], 0, None, 0

        def tile():
            ids, labels, prints, x, wanted = (np.concatenate(part) for part in zip(*held))
            values = [ids.astype("<i8"), labels.astype("<i8"), prints.astype("<i8"), x.astype("<i4"), wanted.astype("<i8")]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.int32()) for v in (g, kind, size, place)]
                                              + [pa.array([v.tobytes()], pa.binary()) for v in values], names=_TILE_NAMES)

        for batch in batches:
            ids, labels, prints, sizes = (batch.column(c).to_numpy() for c in ("id", "label", "print", "size"))
            at = 0
            while at < len(ids):
                if held and (sizes[at] != size or count == limit):
                    yield tile()
                    held, count, place = [], 0, place + 1
                size = int(sizes[at])
                to = min(at + limit - count, int(np.searchsorted(sizes, size, side="right")))
                x = batch.column("x").slice(at, to - at).flatten().to_numpy().reshape(to - at, size)
                wanted = (batch.column("wanted").slice(at, to - at).flatten().to_numpy().reshape(to - at, extra) if extra
                          else np.zeros((to - at, 0), np.int64))
                held.append((ids[at:to], labels[at:to], prints[at:to], x, wanted))
                count += to - at
                at = to
        if held:
            yield tile()
    return rows.select("id", "label", "print", "size", "x", "wanted").mapInArrow(task, _TILE)


def _searched(buckets: DataFrame, anchors: DataFrame, groups: int, search, width: int) -> DataFrame:
    """Every anchor tile meets every group of buckets: one partition for each group, buckets first, longest vectors first."""
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    sent = anchors.drop("g").withColumn("g", every).select(*_TILE_NAMES)
    met = (buckets.select(*_TILE_NAMES).unionAll(sent).repartitionById(groups, "g")
           .sortWithinPartitions("size", "kind", "place"))

    def task(batches):
        own: list[Bucket] = []
        size = None
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                if row["size"] != size:
                    own, size = [], row["size"]
                ids, labels, prints = (np.frombuffer(row[c], "<i8") for c in ("ids", "labels", "prints"))
                x = np.frombuffer(row["matrix"], "<i4").reshape(len(ids), size)
                if row["kind"] == 0:
                    own.append(Bucket(ids, labels, x))
                    continue
                wanted = np.frombuffer(row["wanted"], "<i8").reshape(len(ids), -1) if row["wanted"] else None
                owner, score, found = search(Anchors(ids, labels, prints, x, wanted), own).found()
                if len(owner):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[owner // width]), pa.array(prints[owner // width]), pa.array((owner % width).astype(np.int32)),
                         pa.array(found), pa.array(score)], names=["anchor_id", "print", "part", "found_id", "score"])

    return met.mapInArrow(task, "anchor_id long, print long, part int, found_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best k of each search over all groups: at most k rows come from each group."""
    best = Window.partitionBy("anchor_id", "print", "part").orderBy(F.col("score").desc(), "found_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   window: tuple[int, int] = WINDOW, scale: int = SCALE, id_column: str = "vec_id",
                   vector_column: str = "embedding", group_bytes: int = GROUP_BYTES, bucket: int = BUCKET) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = vectors.sparkSession
    rows = stored(prepared(vectors, is_anchor, label, scale, id_column, vector_column)
                  .withColumn("print", F.xxhash64("id", "label", "x")).withColumn("wanted", F.lit(None).cast("array<bigint>")), "negatives-rows")
    n, components = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, -(-components * 4 // group_bytes), min(shuffle, -(-n // bucket)))
    by_length = ["size", F.col("norm2").desc(), "id", "print"]
    ordered = rows.repartitionByRange(groups, *by_length).sortWithinPartitions(*by_length)
    buckets = stored(_tiles(ordered, bucket, kind=0), "negatives-buckets")
    # Partitions of the range shuffle may be more than asked for; every one is a group.
    groups = int(buckets.agg(F.coalesce(F.max("g"), F.lit(0))).first()[0]) + 1
    anchors = rows.where("anchor").dropDuplicates(["id", "print"])
    # Anchors are spread over tiles by range: one tile's anchors have one size and similar lengths.
    spread = max(1, min(shuffle, -(-anchors.count() // ANCHORS)))

    def placed(df):
        return df.repartitionByRange(spread, *by_length).sortWithinPartitions(*by_length)

    found = _searched(buckets, _tiles(placed(anchors), ANCHORS, kind=1), groups, lambda tile, own: search_positives(tile, own, positives), 1)
    best = stored(_ranked(found, positives).select("anchor_id", "print", (F.col("rank") - 1).alias("part"), F.col("found_id").alias("positive_id"),
                                                   F.col("score").alias("positive_score")), "negatives-positives")
    slots = best.groupBy("anchor_id", "print").agg(F.map_from_entries(F.collect_list(F.struct("part", "positive_score"))).alias("have"))
    wanted = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda j: F.coalesce(F.try_element_at("have", j), F.lit(_NONE)))
    hungry = (anchors.withColumnRenamed("id", "anchor_id").join(slots, ["anchor_id", "print"]).withColumnRenamed("anchor_id", "id")
              .withColumn("wanted", wanted))
    found = _searched(buckets, _tiles(placed(hungry), ANCHORS, kind=1, extra=positives), groups,
                      lambda tile, own: search_negatives(tile, own, negatives, window), positives)
    return (_ranked(found, negatives).join(best, ["anchor_id", "print", "part"])
            .select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % ANCHOR_EVERY == 0, label)


OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.e, c.e) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id AND len(a.e) = len(c.e)
  WHERE a.vec_id % 100 = 0),
p AS (
  SELECT * FROM (SELECT anchor_id, vec_id, score,
                        row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same)
  WHERE place <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
WHERE rank <= 10
"""
