"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import functools
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .tables import ship_package

_WHERE = {
    "op1_packed_rows": "packing", "op2_repeated_substrings": "substrings", "op3_source_mix": "mixing",
    "op4_token_counts": "token_counts", "op5_quality": "quality", "op6_url_filters": "urls",
    "op7_near_duplicates": "near_duplicates", "op8_licences": "licences", "op9_decontamination": "decontamination",
    "op10_nearest_vectors": "nearest_vectors", "op11_hard_negatives": "hard_negatives", "op12_whitening": "whitening",
    "op13_toxicity": "toxicity",
}


def _query(name: str, module: str) -> Callable[[SparkSession, str], DataFrame]:
    function = getattr(importlib.import_module(f".{module}", __package__), name)

    @functools.wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return function(spark, sf_dir)
    return run


QUERIES = {name: _query(name, module) for name, module in _WHERE.items()}


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = _pipeline


def oracle_sql() -> dict[str, str]:
    from . import hard_negatives, nearest_vectors, urls
    return {"op6_url_filters": urls.OP6_SQL, "op10_nearest_vectors": nearest_vectors.OP10_SQL,
            "op11_hard_negatives": hard_negatives.OP11_SQL}
