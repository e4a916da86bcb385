"""Corpus pipeline: from ``documents`` to packed training rows.

STAGES are applied in order; each one's result is written as Parquet and read
back as the next one's documents.  All but the last keep the columns of ``documents``.
ORACLE_SQL is None: the classifier, the sketches, the seeded mix and the encoding have no SQL form;
tests compare the stages with plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from revaudit.llm import decontamination, mixing, near_duplicates, packing, quality
from revaudit.llm.tables import read, ship_package, stored

ORACLE_SQL = None


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    ship_package(spark)
    return quality.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest doc_id."""
    ship_package(spark)
    return near_duplicates.keep_first(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item."""
    ship_package(spark)
    return decontamination.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    ship_package(spark)
    return mixing.mixed_documents(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed rows of token ids (see ``packing.ROWS``)."""
    ship_package(spark)
    return packing.packed_rows(docs)


STAGES = [("quality_classifier", quality_filter), ("near_dedup", near_dedup), ("benchmark_decontamination", decontaminate),
          ("source_mix", mix_sources), ("token_output", pack_tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
