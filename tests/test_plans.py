"""Plan-shape checks: no pair-producing joins, pushdown to the scans, broadcast only where hinted."""
from __future__ import annotations

import os
import re

import pytest

from revaudit.plans.build import build_enriched
from revaudit.sources import testdata

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def test_enrichment_plan_shape(spark, capsys):
    src = testdata.load(spark, SF)
    plan = _plan(build_enriched(src, number=True), capsys)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # service-code filter and blank-document filter reach the ledger scan
    assert re.search(r"PushedFilters: \[[^\]]*In\(esu_id", plan)
    assert "Not(EqualTo(document_reasons_number,))" in plan
    # column pruning: the ledger scan for the invoice pivot reads five columns
    assert re.search(r"ReadSchema: struct<document_reasons_number:string,service_details_container_number:string,"
                     r"esu_id:string,amount_in_rub_without_vat:decimal\(18,2\),"
                     r"amount_in_contract_currency_without_vat:decimal\(18,2\)>", plan)
    # the wide movement rows meet the billing events in one window scan, not a second join
    assert "Window" in plan


def test_no_estimate_based_broadcast(spark, capsys):
    src = testdata.load(spark, SF)
    plan = _plan(build_enriched(src), capsys)
    broadcast_joins = len(re.findall(r"BroadcastHashJoin", plan.split("\n\n")[0]))
    # the six dimension lookups (checked hint) are the only broadcasts of a table that is one chunk
    assert broadcast_joins <= 6


def _scans(df, column) -> int:
    """Parquet scans that read a column in the physical plan (before it runs)."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}#", plan))


def test_invoice_pairs_are_not_shuffled_in_the_build(spark, capsys):
    src = testdata.load(spark, SF)
    plan = _plan(build_enriched(src), capsys)
    assert "LeftSemi" not in plan        # the left joins that follow do the same test


def test_one_range_exchange_numbers_the_rows(spark):
    from revaudit.operators.numbering import number_rows
    df = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey")
    out = number_rows(df, partitions=6)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    ranged = len(re.findall(r"(?<!Reused)Exchange rangepartitioning", final))
    reused = final.count("ReusedExchange")
    assert ranged - reused <= 1 and ranged >= 1


def test_split_containers_cost_one_narrow_scan(spark):
    """Splitting adds one scan of the ledger, cut down to the split containers at the scan."""
    src = testdata.load(spark, SF)
    split = build_enriched(src, chunks=12)
    whole = build_enriched(src, chunks=1)
    assert _scans(split, "container_number") == _scans(whole, "container_number") >= 1
    assert _scans(split, "esu_id") == _scans(whole, "esu_id") + 1 >= 3
    plan = split._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Filter \(.*upper\(service_details_container_number#\d+\) IN", plan)


def test_half_the_ledger_on_one_container_is_spread(spark, scratch_dir):
    """No task of the events' plan gets much more than the others, with runtime broadcasts off."""
    from pyspark.sql import functions as F

    from dataclasses import replace

    from revaudit.operators.billing import billing_events
    from revaudit.operators.movements import normalise_movements
    src = testdata.load(spark, "/root/testdata/sf0.01")
    half = F.xxhash64("service_details_order_id") % 2 == 0
    ledger = src.ledger.withColumn("service_details_container_number",
                                   F.when(half, F.lit("c1")).otherwise(F.col("service_details_container_number")))
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        events = billing_events(replace(src, ledger=ledger), normalise_movements(src.movements), only_moved=False)
        per = sorted(r["count"] for r in events.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert len(per) >= 4 and per[-1] <= 2 * per[len(per) // 2]


def test_one_railway_is_a_filter_of_the_scan(spark):
    from revaudit.operators.movements import normalise_movements, of_railways
    src = testdata.load(spark, SF)
    plan = normalise_movements(src.movements, railway="AMERICA")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r'PushedFilters: \[[^\]]*(In\(railway_from_name|EqualTo\(railway_from_name,"AMERICA"|IsNotNull\(railway_from_name\), EqualTo)', plan)
    assert of_railways(src.movements, ["NOWHERE"]).count() == 0
    assert of_railways(src.movements, ["AMERICA", "ASIA"]).count() == src.movements.filter(
        "railway_from_name IN ('\"AMERICA\"', '\"ASIA\"')").count()


def test_spellings_of_one_railway(spark, monkeypatch):
    from conftest import movement
    from revaudit.operators import movements
    from conftest import make_sources
    names = ['"R1"', "R1", 'R"1"', '"R2"', None, ""]
    src = make_sources(spark, [movement(container=f"C{i}", railway=r) for i, r in enumerate(names)], [])

    def got(railways):
        return sorted(r[0] for r in movements.of_railways(src.movements, railways).select("container_number").collect())
    for limit in (1000, 1):
        monkeypatch.setattr(movements, "MAX_SPELLINGS", limit)
        assert got(["R1"]) == got(['"R1"']) == ["C0", "C1", "C2"]
        assert got([None, "R2"]) == ["C3", "C4"] and got([""]) == ["C5"] and got([None]) == ["C4"]


def test_half_the_movements_on_one_pair_are_spread(spark):
    """The invoice join gives no task much more than the others, without any skew handling at run time."""
    from pyspark.sql import functions as F
    from revaudit.operators.enrich import heavy_pairs, movements_with_invoices
    from revaudit.operators.invoices import invoice_match
    from revaudit.operators.movements import normalise_movements
    src = testdata.load(spark, "/root/testdata/sf0.01")
    mv = normalise_movements(src.movements)
    invoices = invoice_match(src.ledger, mv, only_shipped=False)
    first = invoices.first()
    half = F.xxhash64("shipment_no", "container_no", "dispatch_ts") % 2 == 0
    skewed = (mv.withColumn("container_no", F.when(half, F.lit(first["invoice_container_no"])).otherwise(F.col("container_no")))
                .withColumn("shipment_no", F.when(half, F.lit(first["invoice_document_no"])).otherwise(F.col("shipment_no"))))
    assert heavy_pairs(skewed) is None  # too few rows to need it
    heavy = heavy_pairs(skewed, table_rows=0)
    assert [tuple(r)[:2] for r in heavy.collect()] == [(first["invoice_container_no"], first["invoice_document_no"])]
    settings = {"spark.sql.adaptive.skewJoin.enabled": "false", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    saved = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = movements_with_invoices(skewed, invoices, heavy)
        per = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        plain = sorted(r["count"] for r in movements_with_invoices(skewed, invoices).groupBy(F.spark_partition_id()).count().collect())
        assert out.exceptAll(movements_with_invoices(skewed, invoices)).count() == 0
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert sum(per) == sum(plain) == mv.count()
    assert per[-1] <= 2 * per[len(per) // 2] < plain[-1]


def test_movements_and_lines_are_exchanged_once(spark):
    """By container; grouping, pair window and time window work where the rows then lie."""
    plan = build_enriched(testdata.load(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 3
    assert len(re.findall(r"(?<!Broadcast)Exchange", plan)) == 3


def test_lines_are_grouped_by_names_only(spark):
    from revaudit.operators.billing import billing_events
    from revaudit.operators.movements import normalise_movements
    src = testdata.load(spark, SF)
    mv = normalise_movements(src.movements)
    events = billing_events(src, mv, only_moved=False)
    assert len(re.findall(r"(?<!Broadcast)Exchange", events._jdf.queryExecution().executedPlan().toString())) == 1
    shuffled = billing_events(src, mv, only_moved=False, max_broadcast_bytes=0)
    assert shuffled.count() == events.count() and shuffled.exceptAll(events).count() == 0


def test_large_containers_are_built_apart(spark, monkeypatch):
    from conftest import line, make_sources, movement, rows

    from revaudit.operators import nearest
    moves = [movement(f"C{i % 9 if i % 2 else 0}", f"2020-01-{1 + i % 28:02d} 00:00:00", f"S{i % 5}") for i in range(120)]
    moves += [movement(None), movement("C1", None), movement("C1", shipment=None), moves[0], moves[0]]
    lines = [line(f"c{i % 9 if i % 3 else 0}", f"S{i % 5}", when=f"2020-01-{1 + i % 28:02d} 00:00:00", order=i // 2, client=i % 4) for i in range(120)]
    src = make_sources(spark, moves, lines + [line(None), lines[0]], counterparty=[(1, "x"), (2, None), (2, "y"), (3, "")])
    want = rows(build_enriched(src, nearest_method="join"))
    assert rows(build_enriched(src)) == want and len(want) == 125
    monkeypatch.setattr(nearest, "CHUNK_ROWS", 10)
    large = build_enriched(src)
    assert rows(large) == want == rows(build_enriched(src, chunks=30, rest_whole=True))
    assert "shufflepartitionidpassthrough" in large._jdf.queryExecution().executedPlan().toString()
    numbered = build_enriched(src, number=True)
    assert sorted(r["rownumber"] for r in numbered.collect()) == list(range(1, 126)) and rows(numbered.drop("rownumber")) == want
