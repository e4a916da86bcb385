"""MinHash near-duplicates by fast similarity sketching (operator 7).

Shingles: five consecutive lower-cased words, as 64-bit hashes; a shorter text is one shingle.
Sketch: in round i every shingle of a document is placed in a hashed bin with the value i plus a
hashed fraction and each bin keeps its least value; from round ``COORDINATES`` on, round
``COORDINATES`` + j places all of them in bin j.  So every bin is filled after twice as many rounds
at most (long before, as a rule), and equal bins of two sketches estimate their Jaccard
similarity with concentration bounds as if the bins were independent.

Candidates are documents that agree in one of ``BANDS`` bands of ``ROWS`` bins (a pair of similarity 0.75
agrees in none with probability 5e-6) and in at least ``LEAST_EQUAL`` of the 128 bins (five standard
deviations below 0.75).  Links are confirmed on the full shingle sets of the whole texts.

Copies and groups.  Documents with one shingle set are a class, found by its 128-bit fingerprint and
represented by its smallest doc_id; classes that hold many rows get back to them by a bounded broadcast list (``class_values``).  In a bucket, every class is first compared with
the bucket's smallest one; the confirmed links give components.  Then only buckets that still hold
several components are compared further, and only between components.  Those of at most ``CROWD`` classes give
pairs.  Larger ones are joined into families (classes connected by such buckets); a family's texts are
compared with each other tile against tile, inside the tasks, on full sets, and only links that join two
components come out.  So neither buckets nor partners have a cap, no group is gathered in one task, and pairs inside a
component or a crowd are never made; what remains quadratic is the comparing, in a family of
texts that are alike but not linked.

Nulls: null and empty texts have no shingles and link with nothing.  A null doc_id links with nothing (component
null, kept).  Rows with equal doc_ids are one node: links of any of them count.  Identical rows are one class.
An empty table gives no rows.  ``keep_first`` keeps the input's columns whatever their names; of rows that repeat both id and
text one stays, and so of rows without an id that repeat a text with words.  Rows without an id are compared by their whole texts, and
only with each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as tx
from .components import components
from .tables import read, stored, unused

SHINGLE = 5
COORDINATES = 128
ROWS = 4
BANDS = COORDINATES // ROWS
LEAST_EQUAL = 70
PERCENT = 75
CROWD = 256
#: A class is hot if it holds more than this fraction of a shuffle partition's share of the rows (4: a quarter).
HOT_SHARE = 4
TILE_BYTES = 4 << 20

SKETCH = "doc_id long, n_shingles long, f1 long, f2 long, sketch binary, bands array<long>"


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, and n + 1 offsets."""
    raw, offs = tx.buffers(column)
    raw = tx.LOWER[raw]
    starts, ends, at = tx.words(raw, offs, tx.NON_BLANK)
    words = tx.span_hashes(raw, starts, ends)
    n = np.diff(at)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    owner, place = tx.ragged(count)
    grams = tx.gram_hashes(words, SHINGLE)
    value = np.zeros(len(owner), np.uint64)
    long = (n >= SHINGLE)[owner]
    value[long] = grams[at[owner[long]] + place[long]]
    if not long.all():
        for k in range(1, SHINGLE):  # a short text is one shingle of k words
            short = (n == k)[owner]
            if short.any():
                value[short] = tx.gram_hashes(words, k)[at[owner[short]]]
    by = np.argsort(value)
    by = by[np.argsort(owner[by], kind="stable")]
    value, owner = value[by], owner[by]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.searchsorted(owner, np.arange(len(offs)))


def sketches(values: np.ndarray, at: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """A row of ``size`` uint32 bins for each set: the round above the hashed fraction's 24 bits."""
    n = len(at) - 1
    bins = np.full((n, size), 0xFFFFFFFF, np.uint32)
    count = np.diff(at)
    open_rows = np.flatnonzero(count > 0)
    with np.errstate(over="ignore"):
        for i in range(2 * size):
            if not len(open_rows):
                break
            owner, place = tx.ragged(count[open_rows])
            h = tx.mix(values[at[open_rows][owner] + place] + np.uint64(i + 1) * np.uint64(0x9E3779B97F4A7C15))
            value = (np.uint32(i) << np.uint32(24)) | (h >> np.uint64(40)).astype(np.uint32)
            if i < size:
                slot = (h & np.uint64(size - 1)).astype(np.int64)
                np.minimum.at(bins.reshape(-1), open_rows[owner] * size + slot, value)
            else:
                first = np.concatenate([[0], np.cumsum(count[open_rows])[:-1]])
                bins[open_rows, i - size] = np.minimum(bins[open_rows, i - size], np.minimum.reduceat(value, first))
            open_rows = open_rows[(bins[open_rows] == 0xFFFFFFFF).any(axis=1)]
    return bins


def sketch_table(docs: DataFrame) -> DataFrame:
    """A SKETCH row for each row of ``docs``."""
    def task(batches):
        for batch in batches:
            for part in tx.slices(batch, "text"):
                values, at = shingle_sets(part.column("text"))
                bins = sketches(values, at)
                some = np.diff(at) > 0
                sums = np.concatenate([np.zeros((1, 2), np.uint64), np.cumsum(
                    np.stack([tx.mix(values), tx.mix(values ^ np.uint64(0x5851F42D4C957F2D))], axis=1), axis=0)])
                prints = (sums[at[1:]] - sums[at[:-1]]).view(np.int64)
                with np.errstate(over="ignore"):
                    wide = bins.reshape(len(bins), BANDS, ROWS).astype(np.uint64)
                    key = np.zeros((len(bins), BANDS), np.uint64)
                    for r in range(ROWS):
                        key = tx.mix(key + wide[:, :, r] + np.uint64(r + 1) * np.uint64(0x9E3779B97F4A7C15))
                    key = tx.mix(key + np.arange(BANDS, dtype=np.uint64)[None, :]).view(np.int64)
                small = tx.mix(bins.astype(np.uint64)).astype(np.uint8)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(bins) + 1) * BANDS, BANDS), pa.int32()), pa.array(key.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(np.diff(at)), pa.array(np.where(some, prints[:, 0], 0)),
                     pa.array(np.where(some, prints[:, 1], 0)), pa.array([r.tobytes() for r in small], pa.binary()), bands],
                    names=["doc_id", "n_shingles", "f1", "f2", "sketch", "bands"])

    return docs.select("doc_id", "text").mapInArrow(task, SKETCH)


def _equal_bins(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a == b).sum(axis=-1)


def _bins(column) -> np.ndarray:
    raw, _ = tx.buffers(column)
    return raw.reshape(-1, COORDINATES)


def near_in_sketch(pairs: DataFrame, sketch: DataFrame) -> DataFrame:
    """The (a, b) whose sketches agree in LEAST_EQUAL bins; ``sketch``: id, sketch."""
    left = sketch.select(F.col("id").alias("a"), F.col("sketch").alias("sa"))
    right = sketch.select(F.col("id").alias("b"), F.col("sketch").alias("sb"))

    def task(batches):
        for batch in batches:
            near = _equal_bins(_bins(batch.column("sa")), _bins(batch.column("sb"))) >= LEAST_EQUAL
            yield batch.select(["a", "b"]).filter(pa.array(near))
    # An id has several sketches only if several rows share a doc_id.
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "sb").mapInArrow(task, "a long, b long").distinct()


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) with 100 |A and B| >= 75 |A or B| on full shingle sets; ``texts``: id, text.

    Pairs of one ``a`` and text lie together, so its set is made once for each slice of pairs.  Rows that share an id give several texts.
    """
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"), F.xxhash64("text").alias("ha"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))

    def task(batches):
        for batch in batches:
            for part in tx.slices(batch, "tb", tx.SLICE_BYTES // 2):
                a, ha = part.column("a").to_numpy(), part.column("ha").to_numpy()
                new = np.ones(len(a), bool)
                new[1:] = (a[1:] != a[:-1]) | (ha[1:] != ha[:-1])
                first, of = np.flatnonzero(new), np.cumsum(new) - 1
                va, at_a = shingle_sets(part.column("ta").take(pa.array(first)))
                vb, at_b = shingle_sets(part.column("tb"))
                # Pair number and shingle in one list: what occurs twice is shared.
                owner, place = tx.ragged(np.diff(at_a)[of])
                value = np.concatenate([va[at_a[of][owner] + place], vb])
                owner = np.concatenate([owner, np.repeat(np.arange(len(of)), np.diff(at_b))])
                by = np.argsort(value)
                by = by[np.argsort(owner[by], kind="stable")]
                twice = (value[by][1:] == value[by][:-1]) & (owner[by][1:] == owner[by][:-1])
                shared = np.bincount(owner[by][1:][twice], minlength=len(of))
                union = np.diff(at_a)[of] + np.diff(at_b) - shared
                link = (shared > 0) & (100 * shared >= PERCENT * union)
                yield part.select(["a", "b"]).filter(pa.array(link))
    return (pairs.join(right, "b").join(left, "a").select("a", "b", "ha", "ta", "tb")
            .sortWithinPartitions("a", "ha").mapInArrow(task, "a long, b long"))


def cross_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of one bucket that lie in different components and not in one family, and agree in LEAST_EQUAL bins.

    ``members``: key, id, component, family, sketch; buckets of at most CROWD classes.
    """
    def pairs_of(table: pa.Table):
        ids, comp, bins = table.column("id").to_numpy(), table.column("component").to_numpy(), _bins(table.column("sketch"))
        family = table.column("family").to_numpy()
        key = table.column("key").to_numpy()
        by = np.argsort(key, kind="stable")
        for group in np.split(by, np.flatnonzero(np.diff(key[by])) + 1):
            x, y = np.triu_indices(len(group), 1)
            x, y = group[x], group[y]
            apart = (comp[x] != comp[y]) & ((family[x] != family[y]) | (family[x] < 0)) & (ids[x] != ids[y])
            x, y = x[apart], y[apart]
            near = _equal_bins(bins[x], bins[y]) >= LEAST_EQUAL
            yield np.stack([np.minimum(ids[x[near]], ids[y[near]]), np.maximum(ids[x[near]], ids[y[near]])])

    def emit(held):
        found = np.concatenate(list(pairs_of(pa.Table.from_batches(held).combine_chunks())), axis=1)
        a, b = np.unique(found, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    def task(batches):
        # Rows arrive sorted by key; a bucket that a batch cuts is held until its end.
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < 8192:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield emit(table.slice(0, cut).to_batches())
                held, size = table.slice(cut).to_batches(), size - cut
        if size:
            yield emit(held)

    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = members.select("key", "id", "component", "family", "sketch").repartition(n, "key").sortWithinPartitions("key")
    return placed.mapInArrow(task, "a long, b long").distinct()


def family_links(texts: DataFrame, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """Links (a, b) between different components of one family, at most one for each class and task.

    ``texts``: family, id, component, text.  A family is dealt into tiles of about ``tile_bytes``; a task holds
    two tiles (or one) and counts the shingles that its texts share by an inverted list.
    """
    size = texts.groupBy("family").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.octet_length("text")) / tile_bytes)).cast("int").alias("tiles"))
    dealt = texts.join(size, "family").withColumn("t", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda o: F.struct(
        F.least("t", o).alias("i"), F.greatest("t", o).alias("j"))))
    rows = dealt.withColumn("p", meets).select("family", "p.i", "p.j", "t", "id", "component", "text")

    def links(table: pa.Table) -> pa.Table:
        ids, comp = table.column("id").to_numpy(), table.column("component").to_numpy()
        side, i, j = table.column("t").to_numpy(), table.column("i")[0].as_py(), table.column("j")[0].as_py()
        value, at = shingle_sets(table.column("text"))
        n = np.diff(at)
        owner = np.repeat(np.arange(len(ids)), n)
        right = side[owner] == j
        by = np.argsort(value[right])
        list_value, list_owner = value[right][by], owner[right][by]
        _, label = np.unique(comp, return_inverse=True)
        parent = list(range(int(label.max(initial=-1)) + 1))

        def root(c):
            while parent[c] != c:
                parent[c] = c = parent[parent[c]]
            return c
        found = []
        for x in np.flatnonzero(side == i).tolist():
            own = value[at[x]:at[x + 1]]
            low, high = np.searchsorted(list_value, own), np.searchsorted(list_value, own, side="right")
            who, nth = tx.ragged(high - low)
            shared = np.bincount(list_owner[low[who] + nth], minlength=len(ids))
            near = (shared > 0) & (100 * shared >= PERCENT * (n[x] + n - shared)) & (label != label[x])
            for y in np.flatnonzero(near).tolist():
                p, q = root(label[x]), root(label[y])
                if p != q:
                    parent[p] = q
                    found.append((ids[x], ids[y]))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return rows.groupBy("family", "i", "j").applyInArrow(links, "a long, b long")


def class_values(rows: DataFrame, classes: DataFrame, value: str, hot_rows: int) -> DataFrame:
    """``rows`` (with f1, f2) and the ``value`` of their class (``classes``: f1, f2, n and the value); NULL without a class.

    Classes of more than ``hot_rows`` rows are at most all rows / ``hot_rows``, i.e. HOT_SHARE for each shuffle partition: that
    list is broadcast, so their rows stay where they are.  The others' rows meet their class by a shuffle.
    """
    hot = classes.where(F.col("n") > hot_rows).select("f1", "f2", value)
    cold = classes.where(F.col("n") <= hot_rows).select("f1", "f2", value)
    inside = rows.join(F.broadcast(hot), ["f1", "f2"])
    outside = rows.join(F.broadcast(hot.select("f1", "f2")), ["f1", "f2"], "left_anti").join(cold, ["f1", "f2"], "left")
    return inside.unionByName(outside)


def near_duplicates(docs: DataFrame, crowd: int = CROWD, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text)."""
    rows = stored(sketch_table(docs), "sketches")
    linkable = rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    # A class's sketch and bands are those of any member, so they are aggregated with its id, map-side first.
    classes = stored(linkable.groupBy("f1", "f2").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("sketch").alias("sketch"),
                                                      F.first("bands").alias("bands")), "classes")
    heads = classes.select("id", "sketch", "bands")
    hot_rows = max(1, rows.count() // (HOT_SHARE * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    banded = heads.select("id", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.min("id").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(banded.join(shared.select("key", "hub"), "key"), "buckets")
    sketch = stored(heads.join(members.select("id").distinct(), "id", "left_semi").select("id", "sketch"), "bucketed")

    stars = members.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    star_pairs = stored(near_in_sketch(stars, sketch), "star-pairs")
    # One way to meet at every size: both sides by id, however short the list is.
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(sketch.select("id").distinct().hint("merge"), "id", "left_semi")
    texts = stored(texts, "candidate-texts")
    links = stored(confirmed(star_pairs, texts), "star-links")
    first = components(links)

    grouped = members.select("key", "id").join(first.withColumnRenamed("node", "id"), "id", "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "id"))
    mixed = (grouped.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("id").alias("least"),
                                        F.count(F.lit(1)).alias("n")).where("lo <> hi").select("key", "least", "n"))
    rest = stored(grouped.join(mixed, "key"), "mixed-buckets")
    crowded = F.col("n") > crowd
    families = components(rest.where(crowded).select(F.col("least").alias("a"), F.col("id").alias("b")))
    families = families.select(F.col("node").alias("id"), F.col("component").alias("family"))
    pairs = rest.where(~crowded).join(sketch, "id").join(families, "id", "left").withColumn("family", F.coalesce("family", F.lit(-1).cast("long")))
    pairs = cross_pairs(pairs).join(star_pairs, ["a", "b"], "left_anti")
    inside = rest.select("id", "component").distinct().join(families, "id").join(texts, "id")
    more = stored(confirmed(pairs, texts).unionAll(family_links(inside, tile_bytes)), "cross-links")
    # Rows that share a doc_id may lie in several classes.
    own = linkable.select("doc_id", "f1", "f2").distinct()
    several = own.groupBy("doc_id").count().where("count > 1")
    alias = class_values(own.join(several, "doc_id", "left_semi"), classes, "id", hot_rows)
    alias = alias.where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    second = components(links.unionAll(more).unionAll(alias))

    # The component goes to the classes first, one row each, and from there to the rows.
    named = classes.select("f1", "f2", "id", "n").join(second.withColumnRenamed("node", "id"), "id", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "id")), "class-components")
    alone = rows.where("doc_id IS NULL OR n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    whole = class_values(linkable.select("doc_id", "n_shingles", "f1", "f2"), named, "component", hot_rows)
    return (whole.select("doc_id", "n_shingles", F.col("component").alias("component_id")).unionAll(alone)
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def one_of_each(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each combination of ``keys``, combined map-side: the least as JSON, so that reruns agree."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in keys]
    least = F.min_by(whole, F.to_json(F.struct(*rest)) if rest else F.lit(""))
    first = rows.groupBy(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).agg(least.alias("first"))
    return first.select("first.*")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are the first of their group, with their columns."""
    name = unused(docs.columns, "odd_id")
    per_id = near_duplicates(docs).where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    odd = stored(per_id.where("NOT kept OR n > 1").select(F.col("doc_id").alias(name), "kept"), "odd-ids")
    same, named = F.col("doc_id") == F.col(name), docs.where("doc_id IS NOT NULL")
    out = named.join(odd.select(name).hint("merge"), same, "left_anti")
    repeated = odd.where("kept").select(name)
    if not repeated.isEmpty():
        out = out.unionAll(one_of_each(named.join(repeated, same, "left_semi"), "doc_id", "text"))
    nameless = docs.where("doc_id IS NULL")
    has_words = F.coalesce(F.col("text").rlike("[^\\x20\\x09-\\x0D]"), F.lit(False))
    return out.unionAll(one_of_each(nameless.where(has_words), "text")).unionAll(nameless.where(~has_words))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


def brute_force(texts: dict[int, str | None]) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id) by comparing all pairs; for tests."""
    import re
    sets = {}
    for doc, value in texts.items():
        w = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), value or ""))
        sets[doc] = {tuple(w[k:k + SHINGLE]) for k in range(max(1, len(w) - SHINGLE + 1))} if w else set()
    parent = {d: d for d in texts}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d
    by: dict = {}
    for doc, shingles in sets.items():
        for s in shingles:
            by.setdefault(s, []).append(doc)
    shared: dict = {}
    for docs in by.values():
        for i, a in enumerate(docs):
            for b in docs[i + 1:]:
                shared[a, b] = shared.get((a, b), 0) + 1
    for (a, b), n in shared.items():
        if 100 * n >= PERCENT * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    return {d: (len(sets[d]), find(d)) for d in texts}
