"""Declared types of the input tables."""
from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import line, make_sources, movement
from revaudit.sources.tables import SOURCE_TABLES, read_sources, schema_faults


def test_good_tables_have_no_faults(spark, scratch_dir):
    src = make_sources(spark, [movement()], [line()])
    assert schema_faults(src) == []
    assert schema_faults(replace(src, movements=src.movements.withColumn("operation_datetime", F.col("operation_datetime").cast("timestamp")),
                                 ledger=src.ledger.withColumn("amount_in_rub_without_vat", F.lit(5).cast("bigint")))) == []
    for name in SOURCE_TABLES:
        getattr(src, name).write.parquet(f"{scratch_dir}/{name}")
    assert read_sources(spark, scratch_dir).ledger.count() == 1


def test_every_fault_is_named(spark, scratch_dir):
    src = make_sources(spark, [movement()], [line()])
    bad = replace(src, movements=src.movements.drop("goods_etsng").withColumn("operation_datetime", F.lit("2020-01-01")),
                  ledger=src.ledger.withColumn("amount_in_rub_without_vat", F.lit(1.5)),
                  dict_location=src.dict_location.withColumn("id", F.col("id").cast("string")),
                  dict_stations=src.dict_stations.drop("station_name"))
    want = {"movements lacks goods_etsng", "movements.operation_datetime is string", "ledger.amount_in_rub_without_vat is double",
            "dict_location.id is string", "dict_stations lacks station_name"}
    assert set(schema_faults(bad)) == want
    for name in SOURCE_TABLES:
        getattr(bad, name).write.parquet(f"{scratch_dir}/{name}")
    with pytest.raises(ValueError, match="movements lacks goods_etsng"):
        read_sources(spark, scratch_dir)


def _base_tables(spark, folder):
    """A few base rows with repeated and null keys, and keys that meet nothing."""
    import datetime as dt
    day = [dt.datetime(2020, 1, 1 + i) for i in range(9)]
    tables = {
        "lineitem": ([(i % 6 if i % 7 else None, i % 5, i % 4, i % 7, float(5 + i), 100.5 + i, 0.01 * (i % 5), 0.01 * (i % 4), "NRA"[i % 3], "OF"[i % 2], day[i % 9])
                      for i in range(40)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                     "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "orders": ([(k, k % 4 if k != 3 else None, "OFP"[k % 3], day[k]) for k in (0, 1, 2, 2, 3, 4)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz"),
        "customer": ([(k, f"c{k}", k % 3 if k else None) for k in (0, 1, 2, 2, 3)], "c_custkey bigint, c_name string, c_nationkey int"),
        "part": ([(k, k + 1, f"t{k}", f"b{k}") for k in (0, 1, 2, 3, 3)], "p_partkey bigint, p_size int, p_type string, p_brand string"),
        "supplier": ([(k, f"s{k}", k % 2) for k in (0, 1, 1, 2)], "s_suppkey bigint, s_name string, s_nationkey int"),
        "nation": ([(k, f"n{k}", k % 2) for k in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(0, "r0"), (1, "r1")], "r_regionkey int, r_name string"),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(f"{folder}/{name}.parquet")
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(f"base_{name}")


def test_derived_tables_shuffle_narrow_lines_only(spark, scratch_dir, monkeypatch):
    import re

    from revaudit.sources import testdata
    _base_tables(spark, scratch_dir)
    want = spark.sql("""
        SELECT concat('"', ns.n_name, '"') station_from_name, rc.r_name railway_to_name, concat('W', l_suppkey) wagon, l_partkey part, p_type, p_brand, s_name, c_name,
               o_orderstatus, l_shipdate
        FROM base_lineitem JOIN base_orders ON l_orderkey = o_orderkey JOIN base_customer ON o_custkey = c_custkey JOIN base_part ON l_partkey = p_partkey
        JOIN base_supplier ON l_suppkey = s_suppkey JOIN base_nation ns ON s_nationkey = ns.n_nationkey JOIN base_nation nc ON c_nationkey = nc.n_nationkey
        JOIN base_region rs ON ns.n_regionkey = rs.r_regionkey JOIN base_region rc ON nc.n_regionkey = rc.r_regionkey""")
    for limit, exchanges in ((testdata.DEFAULT_BROADCAST_BYTES, 6), (0, 8)):
        monkeypatch.setattr(testdata, "DEFAULT_BROADCAST_BYTES", limit)
        mv = testdata.derive_movements(spark, scratch_dir)
        plan = mv._jdf.queryExecution().executedPlan().toString()
        # orders and customers, lines and orders, lines and parts: nothing else is shuffled unless the suppliers are too large
        assert len(re.findall(r"Exchange hashpartitioning", plan)) == exchanges
        got = mv.select("station_from_name", "railway_to_name", F.coalesce("vehicle_number", F.concat(F.lit("W"), F.substring("wagon_owner", 2, 9))),
                        F.substring("container_number", 2, 9).cast("long"), "goods_etsng", "wagon_owner_new", "wagon_owner", "container_owner",
                        "ownerships_type", "operation_datetime")
        assert got.count() == want.count() > 20
        assert got.exceptAll(want).count() == 0
    # The stored tables are written without a further exchange.
    stored = testdata.load(spark, scratch_dir)
    assert stored.movements.count() == want.count()
    ledger = spark.sql("SELECT 1 FROM base_lineitem JOIN base_orders ON l_orderkey = o_orderkey WHERE l_quantity > 10")
    assert stored.ledger.count() == ledger.count() > 20
