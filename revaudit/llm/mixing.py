"""Mixing sources to target weights by Sainte-Lague apportionment (operator 3, native).

Sources, by code point and null last, weigh 5, 2, 1, repeating.  Together they get 150 %
of all words; a source's target stops at twice its own words and what is over goes to the
others by weight, until none is above (``source_targets``).

The mix is dealt in blocks of ``block_words`` words.  Sainte-Lague gives the blocks to the
sources by the highest quotients target / (2 k + 1), and as the method is monotone in the
number of blocks, each of ``shards`` equal shards of the mix has integer quotas per source:
the difference of two apportionments (``block_quotas``).

A source's documents, in a seeded order, form one stream of words.  Its quota takes whole
passes over the stream first; the rest are distinct blocks of one more pass, picked by a
seeded affine permutation of the block numbers.  A last block, cut or added, brings the source to its target in words (so a source
whose target is less than a block is served as well), at most twice its size.  A document's share is what
those blocks cover of it (``taken``); ``copies`` counts the blocks, one for each pass, that hold its
middle word, for mixing whole documents.

Scale: sizes are computed once and written (one row for each document, without text).  A stream's
places are prefix sums over hashed buckets and then within a bucket, so a source that
holds a third of all rows is spread over its buckets.  Sources are a dimension: target and quota
tables have a row for each source, and only their sums reach the driver.

Nulls: a null text has size 0, a null source is a source.  Rows with equal doc_id each count.
Sources without words get target 0.  An empty table gives no rows.  Input columns other than doc_id,
text and source are dropped by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .tables import read, stored, unused

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 64
SHARDS = 8
SEED = 20261
#: Primes beyond the number of blocks in a source: multiplying by one permutes block numbers.  Products of the first
#: and a block number fit a long; sources of as many blocks take the second, in wide decimals.
_PRIME, _LARGE_PRIME = 2147483647, 1000000000000000003
_BUCKET_ROWS = 2000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """``sizes`` (source, size) -> source, size, docs, weight, target; one row for each source.

    The common factor of the uncapped targets is found by raising it until no further
    source is capped; each round is one aggregate over the sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights)
    weighed = stored(totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1)),
                     "mix-sources")
    whole = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    wanted, cap = share * whole[0], F.col("source_size") * most
    factor = wanted / whole[1] if whole[1] else 0.0
    while True:
        over = cap < F.col("weight") * F.lit(factor)
        capped, free = weighed.agg(F.coalesce(F.sum(F.when(over, cap)), F.lit(0)),
                                   F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).first()
        again = (wanted - capped) / free if free else factor
        if again <= factor:
            break
        factor = again
    return weighed.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(factor))))


def apportion(targets: DataFrame, seats: list[int]) -> DataFrame:
    """Sainte-Lague: for each number of seats, the integer quota of each source.

    Rounding target / divisor gives the quotas up to a few seats (at most half the number
    of sources); those few are then given to the highest open quotients, or taken from the
    lowest held ones.  A source offers as many quotients as it could get of them.  Ties go to
    the larger target, then to the earlier source.
    """
    spark = targets.sparkSession
    total = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    n = targets.count()
    if not total:
        return targets.select("source", "target", F.explode(F.array(*[F.lit(s) for s in seats])).alias("seats"),
                              F.lit(0).cast("long").alias("quota"))
    rows = (targets.where("target > 0").select("source", "target")
            .withColumn("seats", F.explode(F.array(*[F.lit(s).cast("long") for s in seats])))
            .withColumn("q", F.floor(F.col("target") * F.col("seats") / F.lit(total) + 0.5)))
    gap = rows.groupBy("seats").agg((F.first("seats") - F.sum("q")).alias("gap"))
    rows = rows.join(F.broadcast(gap), "seats")  # one row for each shard
    offers = F.ceil((F.abs("gap") + n) * F.col("target") / F.lit(total)) + 2
    offers = F.least(offers, F.abs("gap"), F.when(F.col("gap") < 0, F.col("q")).otherwise(F.abs("gap")))
    offered = (rows.where(offers > 0).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), offers - 1)))
               .withColumn("quotient", F.when(F.col("gap") > 0, F.col("target") / (2 * (F.col("q") + F.col("i")) + 1))
                           .otherwise(F.col("target") / (2 * (F.col("q") - F.col("i")) - 1))))
    sign = F.when(F.col("gap") > 0, -F.col("quotient")).otherwise(F.col("quotient"))
    rank = F.row_number().over(Window.partitionBy("seats").orderBy(
        sign, F.col("target").desc(), F.col("source").asc_nulls_last()))
    moved = (offered.withColumn("rank", rank).where(F.col("rank") <= F.abs("gap"))
             .groupBy("seats", "source").agg(F.sum(F.signum("gap")).cast("long").alias("moved")))
    moved = moved.select(F.col("seats").alias("m_seats"), F.col("source").alias("m_source"), "moved")
    return (rows.join(moved, (F.col("seats") == F.col("m_seats")) & _same("source", "m_source"), "left")
            .select("source", "target", "seats", (F.col("q") + F.coalesce("moved", F.lit(0))).cast("long").alias("quota")))


def block_quotas(targets: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS) -> DataFrame:
    """source, shard, quota: blocks of the source in each shard of the mix."""
    total = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    blocks = round(total / block_words)
    bounds = [blocks * s // shards for s in range(1, shards + 1)]
    dealt = apportion(targets, sorted(set(bounds)))
    shard = F.explode(F.filter(F.arrays_zip(F.array(*[F.lit(b).cast("long") for b in bounds]).alias("bound"),
                                            F.array(*[F.lit(s) for s in range(shards)]).alias("shard")),
                               lambda x: x["bound"] == F.col("seats")))
    rows = dealt.withColumn("at", shard).select("source", F.col("at.shard").alias("shard"), "quota")
    so_far = Window.partitionBy("source").orderBy("shard")
    return rows.withColumn("quota", F.col("quota") - F.coalesce(F.lag("quota").over(so_far), F.lit(0)))


def near_target(blocks: Column, block_words: int = BLOCK_WORDS) -> Column:
    """Words of a source with that many blocks: its target, at most one block from the quota's words."""
    return F.least(F.greatest(F.round("target").cast("long"), (blocks - 1) * block_words, F.lit(0).cast("long")), (blocks + 1) * block_words)


def permuted(b: Column, blocks: Column, shift: Column) -> Column:
    """The number of block b of ``blocks`` in the seeded order: (prime * b + shift) mod blocks, without overflow."""
    def wide(c: Column) -> Column:
        return c.cast("decimal(38,0)")
    small = F.pmod(F.pmod(F.lit(_PRIME), blocks) * b + F.pmod(shift, blocks), blocks)
    factor = F.pmod(F.lit(_LARGE_PRIME).cast("long"), blocks).cast("decimal(19,0)")
    product = (factor * b.cast("decimal(18,0)")).cast("decimal(38,0)")
    large = ((product + wide(F.pmod(shift, blocks))) % wide(blocks)).cast("long")
    return F.when(blocks < F.lit(_PRIME), small).otherwise(large)


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies, source for each row of ``docs``."""
    sizes = stored(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"),
                               F.xxhash64("text").alias("t")), "mix-sizes")
    targets = stored(source_targets(sizes), "mix-targets")
    quotas = block_quotas(targets, block_words, shards).groupBy("source").agg(F.sum("quota").alias("blocks"))
    quotas = quotas.select(F.col("source").alias("q_source"), "blocks")
    size = F.col("source_size")
    plan = (targets.join(quotas, _same("source", "q_source"), "left")
            .withColumn("words", F.least(near_target(F.coalesce("blocks", F.lit(0)), block_words), size * MOST))
            .withColumn("passes", F.when(size > 0, F.floor(F.col("words") / size)).otherwise(0).cast("long"))
            .withColumn("rest", F.col("words") - F.col("passes") * size)
            .select(F.col("source").alias("p_source"), "source_size", "target", "passes", "rest",
                    F.greatest(F.lit(1), F.ceil(F.col("docs") / _BUCKET_ROWS)).cast("long").alias("buckets")))
    plan = stored(plan, "mix-plan")

    # Places in the source's stream: prefix sums over buckets, then within one.
    placed = (sizes.join(plan, _same("source", "p_source")).drop("p_source")
              .withColumn("o", F.xxhash64("doc_id", "t", F.lit(seed)))
              .withColumn("bucket", F.pmod(F.col("o"), F.col("buckets"))))
    per = placed.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    per = per.select(F.col("source").alias("b_source"), F.col("bucket").alias("b_bucket"),
                     F.coalesce(before, F.lit(0)).alias("before"))
    within = F.sum("size").over(Window.partitionBy("source", "bucket").orderBy("o", "doc_id", "size")
                                .rowsBetween(Window.unboundedPreceding, -1))
    stream = (placed.join(per, _same("source", "b_source") & (F.col("bucket") == F.col("b_bucket")))
              .withColumn("start", F.col("before") + F.coalesce(within, F.lit(0)))
              .withColumn("stop", F.col("start") + F.col("size")))

    # Block b of the last pass is number(b) in the seeded order; the blocks numbered below
    # rest / block_words are taken, the next one up to the words left over.
    # The stream's last block may be short, so it is numbered last: the permutation runs over the others.
    shift = F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(_PRIME).cast("long"))
    full = F.floor(F.col("source_size") / F.lit(block_words))

    def number(b: Column) -> Column:
        other = F.greatest(full, F.lit(1))
        return F.when(b >= full, full).otherwise(permuted(b, other, shift))

    def block_end(b: Column) -> Column:
        """End of the taken part of block b."""
        used = F.least(F.greatest(F.col("rest") - number(b) * block_words, F.lit(0)), F.lit(block_words))
        return b * block_words + used

    first = F.floor(F.col("start") / F.lit(block_words))
    last = F.floor((F.col("stop") - 1) / F.lit(block_words))
    covered = F.aggregate(
        F.sequence(first, last), F.lit(0).cast("long"),
        lambda acc, b: acc + F.greatest(F.least(F.col("stop"), block_end(b)) - F.greatest(F.col("start"), b * block_words),
                                        F.lit(0)).cast("long"))
    middle = F.floor((F.col("start") + F.col("stop")) / 2)
    has_words = F.col("size") > 0
    extra = F.when(has_words & (middle < block_end(F.floor(middle / F.lit(block_words)))), 1).otherwise(0)
    return stream.select(
        "doc_id", "source", "size", "source_size", "target", "t",
        F.when(has_words, F.col("passes") * F.col("size") + covered).otherwise(0).cast("long").alias("taken"),
        F.when(has_words, F.col("passes") + extra).otherwise(0).cast("int").alias("copies"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mix in whole documents: each row of ``docs`` as often as its ``copies``, columns as given."""
    plan = mix(docs).where("copies > 0").groupBy("doc_id", "t").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    doc, t, n, i = (unused(docs.columns, name) for name in ("m_doc", "m_t", "m_n", "m_i"))
    plan = plan.select(F.col("doc_id").alias(doc), F.col("t").alias(t), F.ceil(F.col("copies") / F.col("rows")).alias(n))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return (docs.join(plan, _same("doc_id", doc) & (F.xxhash64("text") == F.col(t)))
            .withColumn(i, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*names))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies")
