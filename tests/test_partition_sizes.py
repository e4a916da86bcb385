"""Shuffles of wide rows have as many partitions as their rows need, whatever the session's number."""
from __future__ import annotations

import glob
import os
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import line, make_sources, movement, rows
from revaudit import session
from revaudit.operators.enrich import heavy_pairs, movements_with_invoices
from revaudit.operators.invoices import invoice_match
from revaudit.operators.movements import normalise_movements
from revaudit.plans import buckets, catalog
from revaudit.plans.build import build_enriched
from revaudit.plans.publish import in_number_order, publish


def _sources(spark, n=120):
    moves = [movement(f"C{k % 30}", f"2020-01-{1 + k % 20:02d} 00:00:00", f"S{k % 7}") for k in range(n)] + [movement(None, None, None)]
    lines = [line(f"c{k % 30}", f"S{k % 7}", "0.01.01.01", when=f"2020-01-{1 + k % 15:02d} 00:00:00", order=k) for k in range(n)]
    return make_sources(spark, moves, lines)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_rows(spark, monkeypatch):
    assert session.partitions_of(spark) == session.partitions_of(spark, 1000) == 8
    assert session.partitions_of(spark, 10 * session.PARTITION_ROWS + 1) == 11
    assert buckets.BUCKET_ROWS <= session.PARTITION_ROWS  # a bucket is one task's sort, too


def test_the_build_and_its_numbers_are_dealt_over_enough_partitions(spark, scratch_dir, monkeypatch):
    """published_snapshot, published_presentation, refresh_decision, table_status."""
    src = _sources(spark)
    want = rows(build_enriched(src, number=True), "rownumber", "container_no", "invoice_document_no", "before_order_id", "after_order_id")
    monkeypatch.setattr(session, "PARTITION_ROWS", 10)
    built = build_enriched(src, number=True)  # 241 rows of both tables
    plan = _plan(built)
    assert plan.count("REPARTITION_BY_NUM") >= 4 and re.search(r"rangepartitioning\(.*, 25\)", plan)
    assert len(re.findall(r"hashpartitioning\(container#\d+, 25\)", plan)) == 3
    placed = in_number_order(built, 121)
    assert re.search(r"shufflepartitionidpassthrough\(.*, 13\)", _plan(placed))
    path = publish(placed, scratch_dir, view_name=None)
    table = spark.read.parquet(path)
    assert rows(table, "rownumber", "container_no", "invoice_document_no", "before_order_id", "after_order_id") == want
    files = glob.glob(f"{path}/*.parquet")
    assert len(files) == 13 and all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)
    spans = sorted((r["lo"], r["hi"]) for r in table.groupBy(F.input_file_name()).agg(F.min("rownumber").alias("lo"), F.max("rownumber").alias("hi")).collect())
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables not present")
def test_the_slices_are_dealt_over_enough_partitions(spark, monkeypatch):
    """sliced_build."""
    asked = []
    real = catalog.build_sliced
    monkeypatch.setattr(catalog, "build_sliced", lambda df, path, files=None: asked.append(files) or real(df, path, files=files))
    want = catalog._src(spark, "/root/testdata/sf0.001").movements.count()
    monkeypatch.setattr(session, "PARTITION_ROWS", want // 20)
    assert catalog.q_sliced_build(spark, "/root/testdata/sf0.001").count() == want
    assert asked[0] >= 20


def test_heavy_pairs_are_joined_in_enough_partitions(spark, monkeypatch):
    """invoices_of_heavy_pair: same rows, and pieces that follow the join's partitions."""
    src = _sources(spark)
    mv = normalise_movements(src.movements)
    skewed = mv.withColumns({"container_no": F.when(F.col("shipment_no") < "S4", F.lit("C1")).otherwise(F.col("container_no")),
                             "shipment_no": F.when(F.col("shipment_no") < "S4", F.lit("S1")).otherwise(F.col("shipment_no"))})
    invoices = invoice_match(src.ledger, mv, only_shipped=False)
    want = rows(movements_with_invoices(skewed, invoices, heavy_pairs(skewed, table_rows=0)))
    monkeypatch.setattr(session, "PARTITION_ROWS", 5)
    n = session.partitions_of(spark, skewed.count())
    heavy = heavy_pairs(skewed, table_rows=0)
    assert n == 25 and max(r["pieces"] for r in heavy.collect()) > 4 * 8
    for h in (heavy, None):
        out = movements_with_invoices(skewed, invoices, h, n + 1)
        assert _plan(out).count(", 26), REPARTITION_BY_NUM") == 2
        assert rows(out) == want
