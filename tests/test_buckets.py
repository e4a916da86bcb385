"""Fact tables stored by container: same rows as the build, no exchange, heavy containers apart."""
from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import line, make_sources, movement, rows
from revaudit.operators.enrich import invoices_in_place, movements_with_invoices
from revaudit.operators.invoices import invoice_match
from revaudit.operators.movements import normalise_movements
from revaudit.plans import buckets
from revaudit.plans.buckets import build_from_buckets, build_in_buckets, heavy_containers, open_buckets, store_buckets
from revaudit.plans.build import build_enriched
from revaudit.schemas import ENRICHED_COLUMNS


def random_sources(spark, seed, hot=0.0, n=160):
    """Containers of any case, some missing; shipments, times and amounts with gaps, ties and repeated rows."""
    r = random.Random(seed)
    name = lambda: "C1" if r.random() < hot else r.choice(["C2", "C3", "c4", "C5", "C6", "", "Ä7"] + [f"D{k}" for k in range(40)])
    day = lambda: f"2020-01-{r.randint(1, 20):02d} 0{r.randint(0, 2)}:00:00"
    moves = [movement(r.choice([name(), name(), None]) if r.random() < 0.1 else name(), r.choice([day(), day(), day(), None]),
                      r.choice(["S1", "S2", "S3", None, ""])) for _ in range(n)]
    lines = [line(r.choice([name(), None]) if r.random() < 0.1 else name(), r.choice(["S1", "S2", "S3", "", None]),
                  r.choice(["0.01.01.01", "0.01.01.02", "0.01.01.04", "2.01.01.01", "0.02.01.01", "9.99"]),
                  r.choice([day(), day(), None]), rub=r.choice(["0.00", "10.00", "-3.50", None]), cur=r.choice(["0.00", "1.00"]),
                  order=r.randint(1, 4), client=r.choice([1, 2, 9]), st_from=r.choice([1, 2, 9])) for _ in range(n)]
    return make_sources(spark, moves + moves[:5], lines + lines[:5])


@pytest.mark.parametrize("seed, hot, n_buckets", [(1, 0.0, 4), (2, 0.5, 4), (3, 0.5, 1), (4, 0.0, 64)])
def test_same_rows_as_the_build(spark, scratch_dir, seed, hot, n_buckets):
    src = random_sources(spark, seed, hot)
    assert store_buckets(spark, src, scratch_dir, n_buckets) == 1
    stored = open_buckets(spark, scratch_dir)
    assert stored.buckets == n_buckets
    assert stored.movements.count() + stored.rest_movements.count() == src.movements.count()
    assert stored.ledger.count() + stored.rest_ledger.count() == src.ledger.count()
    out, want = build_from_buckets(stored, src, chunks=5), build_enriched(src)
    assert out.columns == want.columns == list(ENRICHED_COLUMNS)
    assert [f.dataType for f in out.schema] == [f.dataType for f in want.schema]
    assert rows(out) == rows(want)


def test_heavy_containers_lie_apart_whole(spark, scratch_dir):
    src = random_sources(spark, 5, hot=0.5, n=400)
    store_buckets(spark, src, scratch_dir, 4)
    stored = open_buckets(spark, scratch_dir)
    for light, rest in ((stored.movements, stored.rest_movements), (stored.ledger, stored.rest_ledger)):
        inside, apart = ({r[0] for r in t.select("container_no").distinct().collect()} for t in (light, rest))
        assert "C1" in apart and None in apart and not inside & apart
    # A container that stays in the buckets holds at most a part of a bucket's share.
    total = src.movements.count() + src.ledger.count()
    both = stored.movements.select("container_no").unionByName(stored.ledger.select("container_no"))
    assert both.groupBy("container_no").count().agg(F.max("count")).first()[0] <= total // (buckets.PARTS * 4)


def test_no_exchange_of_movements_or_ledger(spark, scratch_dir):
    src = make_sources(spark, [movement(f"C{k}", shipment=f"S{k}") for k in range(200)], [line(f"C{k}", f"S{k}") for k in range(200)])
    store_buckets(spark, src, scratch_dir, 4)
    stored = open_buckets(spark, scratch_dir)
    assert stored.rest_movements.count() == 0
    built = build_in_buckets(stored, src)
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Bucketed: true") == 3 and "Window" in plan
    assert "Exchange" not in plan.replace("BroadcastExchange", "")
    assert built.count() == 200


def test_reopened_by_a_session_without_the_tables(spark, scratch_dir):
    src = random_sources(spark, 6)
    store_buckets(spark, src, scratch_dir, 3)
    want = rows(build_from_buckets(open_buckets(spark, scratch_dir), src))
    for table in spark.catalog.listTables():
        if table.name.startswith("revaudit_"):
            spark.sql(f"DROP TABLE {table.name}")  # not managed: the files stay
    again = build_from_buckets(open_buckets(spark, scratch_dir), src)
    assert rows(again) == want == rows(build_enriched(src))
    assert "Bucketed: true" in again._jdf.queryExecution().executedPlan().toString()


def test_versions(spark, scratch_dir):
    assert open_buckets(spark, scratch_dir) is None
    first, second = random_sources(spark, 7, n=30), random_sources(spark, 8, n=40)
    assert [store_buckets(spark, s, scratch_dir, 2) for s in (first, second)] == [1, 2]
    assert rows(build_from_buckets(open_buckets(spark, scratch_dir), second)) == rows(build_enriched(second))
    assert rows(build_from_buckets(open_buckets(spark, scratch_dir, 1), first)) == rows(build_enriched(first))


@pytest.mark.parametrize("n_moves, n_lines", [(0, 0), (0, 3), (3, 0)])
def test_empty_tables(spark, scratch_dir, n_moves, n_lines):
    src = make_sources(spark, [movement("C1")] * n_moves, [line("C1")] * n_lines)
    store_buckets(spark, src, scratch_dir, 2)
    out = build_from_buckets(open_buckets(spark, scratch_dir), src)
    assert rows(out) == rows(build_enriched(src)) and out.count() == n_moves


def test_containers_of_any_case(spark, scratch_dir):
    src = make_sources(spark, [movement("c1", shipment="S1")], [line("C1", "S1")])
    store_buckets(spark, src, f"{scratch_dir}/a", 2)
    assert build_from_buckets(open_buckets(spark, f"{scratch_dir}/a"), src).first()["invoice_document_no"] is None
    store_buckets(spark, src, f"{scratch_dir}/b", 2, normalise_container=True)
    row = build_from_buckets(open_buckets(spark, f"{scratch_dir}/b"), src).first()
    assert (row["container_no"], row["invoice_document_no"], row["before_order_id"]) == ("C1", "S1", 1)


def test_no_heavy_containers_among_none(spark):
    empty = spark.createDataFrame([], "container string")
    assert heavy_containers([empty, empty], 4, 0) is None


def test_invoices_in_place_equals_the_join(spark):
    src = random_sources(spark, 9, hot=0.3)
    mv = normalise_movements(src.movements).withColumn("kind", F.lit("extra")).withColumn("m", F.lit(1))
    invoices = invoice_match(src.ledger, mv)
    a, b = invoices_in_place(mv, invoices), movements_with_invoices(mv, invoices)
    assert a.columns == b.columns and rows(a) == rows(b)
