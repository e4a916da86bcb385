"""Exact token counts by a histogram of encoded lengths (operator 4).

Every text is encoded once, in its task; the lengths are counted per source (a partial aggregate, so a
source with a third of all rows is no hot spot).  Suffix sums over the histogram then answer, for any
context limit L, how many documents and tokens there are, how many are longer, and how many
tokens are left when each document is cut at L; running counts give quantiles.

The result has a row for each source and length that occurs, so the answer for a limit between two lengths follows
from the next longer row: ``truncated_total`` at limit L is
``tokens - tokens_from + L * docs_from`` of it (``at_limits`` does that).

Suffix sums are made in two steps, over blocks of ``BLOCK`` lengths and inside them, so that no task holds more than
one source's blocks or one block's lengths.

Nulls: a null text has length 0, a null source is a source.  Repeated rows count each.  An empty table gives no rows.  Other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import text as tx
from .packing import TOKENIZER, Encoder
from .tables import read, stored

BLOCK = 1024


def encoded_lengths(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, source, length of each row."""
    def task(batches):
        encoder = Encoder(tokenizer)
        for batch in batches:
            for part in tx.slices(batch, "text"):
                _, at = encoder.encode(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("source"), pa.array(np.diff(at))],
                                                 names=["doc_id", "source", "length"])
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "source", "text").mapInArrow(task, f"doc_id {kind}, source string, length long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """source, length, docs -> with suffix sums and quantiles of each source."""
    counted = stored(lengths.groupBy("source", "length").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc")),
                     "lengths")
    counted = counted.withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn("tokens", F.col("docs") * F.col("length"))
    blocks = counted.groupBy("source", "block").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.partitionBy("source").orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("source")
    blocks = blocks.select(F.col("source").alias("s"), F.col("block").alias("b"),
                           F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_docs"),
                           F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_tokens"),
                           F.sum("d").over(every).alias("all_docs"), F.sum("t").over(every).alias("all_tokens"))
    longer = Window.partitionBy("source", "block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    rows = counted.join(blocks, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    rows = (rows.withColumn("docs_from", F.col("later_docs") + F.sum("docs").over(longer))
            .withColumn("tokens_from", F.col("later_tokens") + F.sum("tokens").over(longer)))
    return rows.select(
        "source", "length", "docs", "first_doc", "docs_from", "tokens_from", "all_docs", "all_tokens",
        (F.col("all_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_from") + F.col("docs")) / F.col("all_docs")).alias("quantile"))


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """source, limit, docs_over, truncated_total for each context limit."""
    rows = histogram.withColumn("limit", F.explode(F.array(*[F.lit(n).cast("long") for n in limits])))
    over = F.col("length") > F.col("limit")
    return (rows.groupBy("source", "limit")
            .agg(F.coalesce(F.sum(F.when(over, F.col("docs"))), F.lit(0)).alias("docs_over"),
                 F.sum(F.least("length", "limit") * F.col("docs")).alias("truncated_total")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(encoded_lengths(read(spark, sf_dir, "documents")))
