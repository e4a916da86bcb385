"""Invariants of the build on the sf0.01 test tables."""
from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from revaudit.operators.fingerprint import processed_fingerprint, source_fingerprint, validate
from revaudit.plans.build import build_enriched
from revaudit.sources import testdata

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_build_invariants(spark):
    src = testdata.load(spark, SF)
    enriched = build_enriched(src, number=True)
    r = enriched.agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("rownumber").alias("numbers"),
        F.min("rownumber").alias("first"), F.max("rownumber").alias("last"),
        F.sum(F.when(F.col("before_date_diff") > 0, 1).otherwise(0)).alias("bad_before"),
        F.sum(F.when(F.col("after_date_diff") < 0, 1).otherwise(0)).alias("bad_after"),
        F.sum(F.when(F.col("before_date_e") > F.col("dispatch_ts"), 1).otherwise(0)).alias("late_before"),
        F.sum(F.when(F.col("after_date_e") < F.col("dispatch_ts"), 1).otherwise(0)).alias("early_after"),
    ).first()
    assert r["n"] == src.movements.count()                       # one row per movement
    assert r["numbers"] == r["n"] and (r["first"], r["last"]) == (1, r["n"])
    assert r["bad_before"] == 0 and r["bad_after"] == 0          # before <= 0 <= after
    assert r["late_before"] == 0 and r["early_after"] == 0
    assert validate(source_fingerprint(src.movements), processed_fingerprint(enriched)) == []
