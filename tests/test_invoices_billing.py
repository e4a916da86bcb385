from __future__ import annotations

import random
from decimal import Decimal

import pytest as _pytest
from pyspark.sql import functions as F

from conftest import line, make_sources, movement, rows
from revaudit.operators.billing import billing_events
from revaudit.operators.invoices import invoice_match, ledger_by_document, with_document_fallback
from revaudit.operators.movements import normalise_movements


def _invoice(spark, movements, ledger, **kw):
    src = make_sources(spark, movements, ledger)
    return invoice_match(src.ledger, normalise_movements(src.movements), **kw)


def test_invoice_pivot_and_zero_groups(spark):
    mv = [movement(container="C1", shipment="S1"), movement(container="C2", shipment="S2"),
          movement(container="C3", shipment="S3"), movement(container="C4", shipment="S4")]
    ledger = [
        line("c1", "S1", "0.01.01.01", rub="10.00", cur="1.00"),
        line("c1", "S1", "2.01.01.01", rub="5.00", cur="0.00"),
        line("c1", "S1", "9.99", rub="100.00"),                    # code outside the list: ignored
        line("C2", "S2", "0.01.01.02", rub="5.00", cur="0.00"),
        line("C2", "S2", "0.01.01.02", rub="-5.00", cur="0.00"),   # sums to zero: dropped
        line("C3", "S3", "0.01.01.04", rub="0.00", cur="7.00"),    # only contract currency: kept
        line("C4", "S4", "0.02.01.01", rub="3.00", cur="3.00"),    # only the document code: no row
        line("C1", "OTHER", "0.01.01.01", rub="1.00"),             # no such shipment for C1
    ]
    for method in ("one_level", "two_level"):
        out = _invoice(spark, mv, ledger, method=method)
        got = {(r["invoice_document_no"], r["invoice_container_no"]): r for r in out.collect()}
        assert set(got) == {("S1", "C1"), ("S3", "C3")}, method
        r = got[("S1", "C1")]
        assert r["rub_0_01_01_01"] == Decimal("10.00") and r["cur_0_01_01_01"] == Decimal("1.00")
        assert r["rub_2_01_01_01"] == Decimal("5.00") and r["rub_0_01_01_02"] == 0   # missing code -> 0
        assert got[("S3", "C3")]["cur_0_01_01_04"] == Decimal("7.00")


def test_container_case_is_one_sided(spark):
    mv = [movement(container="c1", shipment="S1")]
    ledger = [line("c1", "S1", "0.01.01.01")]
    assert _invoice(spark, mv, ledger).count() == 0       # ledger side is upper-cased only
    src = make_sources(spark, mv, ledger)
    assert invoice_match(src.ledger, normalise_movements(src.movements, normalise_container=True)).count() == 1


def test_blank_document_and_fallback(spark):
    mv = [movement(container="C1", shipment="D7")]
    ledger = [line("C1", "", "0.01.01.01", when="2020-01-05 00:00:00", rub="4.00", order=1),
              line("C1", "D7", "0.02.01.01", when="2020-01-05 00:00:00", rub="1.00", order=2),
              line("C1", "", "0.02.01.01", when="2020-01-05 00:00:00", rub="1.00", order=3)]
    assert _invoice(spark, mv, ledger).count() == 0       # blank document dropped: no fallback
    out = _invoice(spark, mv, ledger, keep_blank_documents=True).collect()
    assert len(out) == 1 and out[0]["invoice_document_no"] == "D7"
    assert out[0]["rub_0_01_01_01"] == Decimal("4.00")
    src = make_sources(spark, mv, ledger)
    fb = with_document_fallback(ledger_by_document(src.ledger, normalise_movements(src.movements), True))
    # the blank 0.02.01.01 row also takes the non-blank number of its container + date
    assert sorted(r["document_no_processed"] for r in fb.collect()) == ["D7", "D7", "D7"]


def test_ledger_by_document_keeps_movement_containers_only(spark):
    mv = [movement(container="C1")]
    ledger = [line("c1", "S1", "0.01.01.01"), line("C9", "S1", "0.01.01.01"),
              line("C1", "S1", "0.01.01.01", rub="0.00", cur="0.00", order=5)]
    src = make_sources(spark, mv, ledger)
    out = ledger_by_document(src.ledger, normalise_movements(src.movements))
    assert rows(out, "container_no", "order_id") == [("C1", 1)]


def test_one_level_equals_two_level_random(spark):
    rnd = random.Random(7)
    mv = [movement(container=f"C{rnd.randint(1, 6)}", shipment=f"S{rnd.randint(1, 5)}") for _ in range(40)]
    codes = ["0.01.01.01", "0.01.01.02", "0.01.01.04", "2.01.01.01", "0.02.01.01", "9.99"]
    ledger = [line(f"{rnd.choice('cC')}{rnd.randint(1, 6)}", rnd.choice(["", f"S{rnd.randint(1, 5)}"]),
                   rnd.choice(codes), rub=rnd.choice([None, "0.00", "1.50", "-1.50", "3.25"]),
                   cur=rnd.choice([None, "0.00", "2.00"]), order=rnd.randint(1, 4))
              for _ in range(300)]
    a = _invoice(spark, mv, ledger, method="one_level")
    b = _invoice(spark, mv, ledger, method="two_level")
    assert rows(a) == rows(b) and a.count() > 0


def _brute_events(src_rows, dims):
    """Group raw lines by looked-up names (plain Python)."""
    cp, sv, loc, st = dims
    groups = {}
    for r in src_rows:
        if r["esu_id"] not in ("0.01.01.01", "0.01.01.02", "0.01.01.04", "2.01.01.01"):
            continue
        key = (r["service_details_order_id"], r["service_details_container_number"].upper(),
               cp.get(r["client_number_id"]), loc.get(r["service_details_points_from_catalog_id"]),
               loc.get(r["service_details_points_to_catalog_id"]),
               st.get(r["service_details_points_from_station_id"]),
               st.get(r["service_details_points_to_station_id"]), sv.get(r["esu_id"]))
        g = groups.setdefault(key, [None, None, None])
        d = r["date_end"]
        g[0] = d if g[0] is None or d < g[0] else g[0]
        for i, col in ((1, "amount_in_rub_without_vat"), (2, "amount_in_contract_currency_without_vat")):
            if r[col] is not None:
                g[i] = (g[i] or 0) + r[col]
    out = []
    for k, (d, rub, cur) in groups.items():
        if (rub is not None and rub != 0) or (cur is not None and cur != 0):
            out.append(k + (d, rub, cur))
    return out


def test_billing_events_against_brute_force(spark):
    rnd = random.Random(11)
    mv = [movement(container=f"C{i}") for i in range(1, 6)]
    codes = ["0.01.01.01", "0.01.01.02", "0.01.01.04", "2.01.01.01", "0.02.01.01"]
    ledger = [line(f"{rnd.choice('cC')}{rnd.randint(1, 7)}", "S1", rnd.choice(codes),
                   when=f"2020-01-{rnd.randint(1, 28):02d} 00:00:00",
                   rub=rnd.choice(["0.00", "1.00", "-1.00", "2.50"]), cur=rnd.choice(["0.00", "1.00"]),
                   order=rnd.randint(1, 3), client=rnd.randint(1, 3), p_from=rnd.randint(1, 3),
                   p_to=rnd.randint(1, 3), st_from=rnd.randint(1, 3), st_to=rnd.randint(1, 3))
              for _ in range(250)]
    # client 3, location 3 and station 3 are dimension misses; two locations share a name
    location = [(1, "same"), (2, "same")]
    src = make_sources(spark, mv, ledger, location=location)
    got = billing_events(src, normalise_movements(src.movements))
    dims = ({1: "client-1", 2: "client-2"}, {"0.01.01.01": "wagon", "0.01.01.02": "container",
                                              "2.01.01.01": "forwarding", "0.02.01.01": "guard"},
            dict(location), {1: "st-1", 2: "st-2"})
    containers = {f"C{i}" for i in range(1, 6)}
    expected = [r for r in _brute_events(ledger, dims) if r[1] in containers]
    cols = ("order_id", "container_no", "client_name", "points_from_name", "points_to_name",
            "station_name_from", "station_name_to", "service_name", "date_e", "rub_sum", "cur_sum")
    key = lambda t: tuple((x is None, str(x)) for x in t)
    assert sorted(rows(got, *cols), key=key) == sorted(expected, key=key)


def test_duplicate_dimension_key_multiplies_sums(spark):
    mv = [movement(container="C1")]
    ledger = [line("C1", "S1", "0.01.01.01", rub="10.00", cur="0.00", client=1)]
    src = make_sources(spark, mv, ledger, counterparty=[(1, "dup"), (1, "dup")])
    out = billing_events(src, normalise_movements(src.movements)).first()
    assert out["rub_sum"] == Decimal("20.00")   # as a plain left join before the sum does


def test_assert_unique_and_measured_bytes(spark):
    from revaudit.functions.joins import assert_unique, measured_bytes
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "id bigint, name string")
    with _pytest.raises(ValueError):
        assert_unique(dim, "id")
    assert_unique(dim.filter("id = 1"), "id")
    wide = dim.withColumn("name", F.repeat("name", 1000))
    got = measured_bytes({"d": dim, "none": dim.limit(0), "wide": wide})
    assert got["none"] == 0 and 3 * 8 < got["d"] < 1000 and got["wide"] - got["d"] == 3 * 999


def test_broadcast_limit_is_honoured(spark, capsys):
    """With a limit of one byte no lookup is hinted as a broadcast, whatever was measured before."""
    from dataclasses import replace
    src = make_sources(spark, [movement()], [line()])
    src = replace(src, dim_bytes={k: 100 for k in ("counterparty", "service", "location", "stations")})
    mv = normalise_movements(src.movements)
    hinted = []
    for limit in (1, 1 << 20):
        plan = billing_events(src, mv, max_broadcast_bytes=limit)._jdf.queryExecution().optimizedPlan().toString()
        hinted.append(plan.count("strategy=broadcast"))
    assert hinted == [0, 6]


def _ledger_of(spark, kind, values):
    return make_sources(spark, [movement(container="C1", shipment="S1")], [line()]).ledger.drop(
        "amount_in_rub_without_vat").crossJoin(spark.createDataFrame([(v,) for v in values], "a string")).withColumn(
        "amount_in_rub_without_vat", F.col("a").cast(kind)).drop("a")


MONEY = [("decimal(18,4)", ["0.0049"]), ("decimal(18,4)", ["0.00004", "0.0001"]), ("decimal(20,6)", ["9123456789012.345678"]),
         ("decimal(18,2)", ["9999999999999999.99"] * 3), ("decimal(18,6)", ["999999999999.999999", "-0.000001"]), ("decimal(18,0)", ["999999999999999999"]),
         ("decimal(38,2)", ["123456789012345678901234567890.12", "0.01"]), ("decimal(18,18)", ["0.123456789012345678", "0.000000000000000001"]), ("bigint", ["12345", "-5"])]


@_pytest.mark.parametrize("ansi", ["true", "false"])
def test_money_is_exact_at_every_scale(spark, ansi):
    from decimal import getcontext
    getcontext().prec = 60
    mv = normalise_movements(make_sources(spark, [movement(container="C1", shipment="S1")], []).movements)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for kind, values in MONEY:
            ledger = _ledger_of(spark, kind, values)
            scale = int(kind[:-1].split(",")[1]) if "," in kind else 0
            want = sum(Decimal(v).quantize(Decimal(1).scaleb(-scale), rounding="ROUND_HALF_UP") for v in values)
            for method in ("one_level", "two_level"):
                assert invoice_match(ledger, mv, method=method).first()["rub_0_01_01_01"] == want, (kind, method)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    # Sums beyond a long of minor units: an error under ANSI, exact without.
    many = _ledger_of(spark, "decimal(18,0)", ["999999999999999999"] * 12)
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        if ansi == "true":
            with _pytest.raises(Exception, match="overflow"):
                invoice_match(many, mv).collect()
        else:
            assert invoice_match(many, mv).first()["rub_0_01_01_01"] == 12 * Decimal("999999999999999999")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_floating_point_amounts_are_refused(spark):
    mv = normalise_movements(make_sources(spark, [movement()], []).movements)
    with _pytest.raises(TypeError, match="cast it to a decimal"):
        invoice_match(_ledger_of(spark, "double", ["0.004"]), mv)
