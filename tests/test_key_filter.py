"""The Bloom filter of moved containers, and the sum of broadcast tables."""
from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import line, make_sources, movement, rows
from revaudit.functions.joins import fitting
from revaudit.functions.key_filter import BLOCK_BYTES, key_filter
from revaudit.operators.billing import billing_events
from revaudit.operators.invoices import ledger_by_document
from revaudit.operators.movements import normalise_movements
from revaudit.sources import testdata

SF = "/root/testdata/sf0.001"


def test_every_held_key_passes_and_few_others(spark):
    held = spark.range(20_000).select(F.concat(F.lit("C"), "id").alias("k"))
    keys = key_filter(held.unionByName(held), "k")
    others = spark.range(20_000, 120_000).select(F.concat(F.lit("C"), "id").alias("k"))
    assert keys.n_blocks > 1 and keys.blocks.count() == keys.n_blocks
    assert keys.blocks.select(F.max(F.octet_length(F.to_json("__kf_bits"))), F.min(F.size("__kf_bits"))).first()[1] * 8 == BLOCK_BYTES
    assert keys(held, "k").count() == 20_000
    assert keys(others, "k").count() < 2_000


def test_columns_nulls_repeats_and_the_size_bound(spark):
    rows_ = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("zz", 3)], "k string, `odd.name` int")
    held = spark.createDataFrame([("a",), (None,), ("",)], "k string")
    got = key_filter(held, "k")(rows_, "k")
    assert got.columns == rows_.columns and [tuple(r) for r in got.filter("k = 'a'").collect()] == [("a", 1)] * 2
    assert got.filter("k IS NULL").count() == 0
    assert key_filter(held.limit(0), "k")(rows_, "k").count() == 0
    assert key_filter(held, "k", max_bytes=BLOCK_BYTES - 1) is None


def test_results_are_the_same_with_and_without(spark):
    ledger = [line(container=f"C{i % 40}", order=i, doc=f"S{i % 7}", when=f"2020-01-{1 + i % 28:02d} 00:00:00") for i in range(200)]
    ledger += [line(container=None), line(container="c3")]
    src = make_sources(spark, [movement(container=f"C{i}") for i in range(0, 40, 3)] + [movement(container=None)], ledger)
    mv = normalise_movements(src.movements)
    keys = key_filter(mv, "container_no")
    assert rows(billing_events(src, mv, moved=keys)) == rows(billing_events(src, mv)) != []
    assert rows(ledger_by_document(src.ledger, mv, moved=keys)) == rows(ledger_by_document(src.ledger, mv)) != []
    # Half of all lines on one container that never moved: they go before the first shuffle.
    assert keys(src.ledger.select(F.lit("NEVER").alias("c")), "c").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_the_filter_stands_below_the_first_exchange(spark):
    src = testdata.load(spark, SF)
    mv = normalise_movements(src.movements)
    keys = key_filter(mv, "container_no")
    for df, grouped in ((billing_events(src, mv, moved=keys), "order_id"), (ledger_by_document(src.ledger, mv, moved=keys), "document_no")):
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        tests = [i for i, text in enumerate(plan) if "__kf_of" in text and "BroadcastHashJoin" in text]
        assert len(tests) == 1
        # the nearest exchange above the test is the ledger's own grouping, and no shuffle of the ledger is below it
        above = [text for text in plan[:tests[0]] if "Exchange" in text]
        assert re.search(rf"Exchange hashpartitioning\({grouped}", above[-1])
        scan = next(i for i in range(tests[0], len(plan)) if "FileScan" in plan[i])
        assert not any("Exchange" in text for text in plan[tests[0]:scan])


def test_broadcast_tables_share_one_bound():
    sizes = {"a": 10, "b": 50, "c": 60}
    assert fitting(sizes, 60) == {"a": True, "b": True, "c": False}
    assert fitting(sizes, 120) == {"a": True, "b": True, "c": True}
    assert fitting(sizes, 5) == {"a": False, "b": False, "c": False}
