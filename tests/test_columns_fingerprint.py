from __future__ import annotations

import json

from pyspark.sql import functions as F

from conftest import make_sources, movement, rows, ts
from revaudit.functions.columns import (day_diff, null_to_blank, sorted_text, split_names,
                                        strip_quotes, ts_text, upper_utf8, with_defaults)
from revaudit.operators.fingerprint import (compare_fingerprints, fingerprint, processed_fingerprint,
                                            refresh_decision, source_fingerprint, validate)
from revaudit.operators.movements import normalise_movements, railway_list
from revaudit.plans.publish import status_record


def test_scalar_helpers(spark):
    df = spark.createDataFrame([('"A"b"', None, "cд", ts("2020-01-01 23:59:00"), ts("2020-01-02 00:01:00"))],
                               "s string, n string, u string, a timestamp_ntz, b timestamp_ntz")
    r = df.select(strip_quotes("s").alias("s"), null_to_blank("n").alias("n"), upper_utf8("u").alias("u"),
                  day_diff("a", "b").alias("d"), day_diff("b", "a").alias("back"),
                  ts_text("a").alias("t")).first()
    assert r["s"] == "Ab" and r["n"] == "" and r["u"] == "CД"
    assert r["d"] == 1 and r["back"] == -1          # midnights crossed, end minus start
    assert r["t"] == "2020-01-01 23:59:00"


def test_sorted_text_drops_null_keeps_blank_byte_order(spark):
    df = spark.createDataFrame([("b",), ("Я",), ("a",), (None,), ("",), ('"z',)], "x string")
    assert df.agg(sorted_text("x").alias("t")).first()["t"] == '|"z|a|b|Я'


def test_split_names(spark):
    df = spark.createDataFrame([("A|B|C",)], "s string")
    assert df.select(split_names("s").alias("a")).first()["a"] == ["A", "B", "C"]


def test_with_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None, None)],
                               "s string, n bigint, d decimal(18,2), t timestamp_ntz, keep bigint")
    r = with_defaults(df, keep_null=("keep",)).first()
    assert r["s"] == "" and r["n"] == 0 and r["d"] == 0 and r["t"] == ts("1970-01-01 00:00:00")
    assert r["keep"] is None


def _movements(spark, railways, stations=None, dates=None):
    stations = stations or ['"S"'] * len(railways)
    dates = dates or ["2020-01-01 00:00:00"] * len(railways)
    src = make_sources(spark, [movement(railway=r, station=s, when=d, container=f"C{i}")
                               for i, (r, s, d) in enumerate(zip(railways, stations, dates))], [])
    return src.movements


def test_fingerprint_quotes_before_and_after(spark):
    mv = _movements(spark, ['"B"', "A", '"A"'])
    before = source_fingerprint(mv).first()
    after = source_fingerprint(mv, strip="after").first()
    assert before["railway_names"] == "A|B"
    assert after["railway_names"] == "A|B|A"       # distinct + sort on raw names, then strip
    assert before["rows_qty"] == 3 and before["min_date"] == "2020-01-01 00:00:00"


def test_fingerprint_null_and_blank_railway(spark):
    mv = _movements(spark, [None, "", "X"])
    fp = source_fingerprint(mv).first()
    assert fp["rows_qty"] == 3                     # NULL railway still counted
    assert fp["railway_names"] == "|X"             # NULL not listed, '' listed first
    sl = railway_list(source_fingerprint(mv))
    assert rows(sl, "slice_no", "railway") == [(1, ""), (2, "X")]


def test_processed_fingerprint_equals_source_after_normalisation(spark):
    mv = _movements(spark, ['"B"', "A"], stations=['"S1"', "S2"],
                    dates=["2020-01-01 10:00:00", "2021-05-06 07:08:09"])
    assert validate(source_fingerprint(mv), processed_fingerprint(normalise_movements(mv))) == []


def _fp(spark, n, max_date="2020-01-02 00:00:00"):
    return spark.createDataFrame([(n, "2020-01-01 00:00:00", max_date, "A|B", "S")],
                                 "rows_qty bigint, min_date string, max_date string, railway_names string, station_names string")


def test_refresh_decision_reasons(spark):
    cases = [(_fp(spark, 10), _fp(spark, 9), "more_rows", True),
             (_fp(spark, 10), _fp(spark, 10, "2020-02-02 00:00:00"), "changed", True),
             (_fp(spark, 10), _fp(spark, 10), "up_to_date", False),
             (_fp(spark, 9), _fp(spark, 10), "source_shrank", False)]
    for src, tgt, reason, refresh in cases:
        r = refresh_decision(src, tgt).first()
        assert (r["reason"], r["refresh"]) == (reason, refresh)


def test_compare_fingerprints_report(spark):
    rep = compare_fingerprints(_fp(spark, 10), _fp(spark, 10, "2020-02-02 00:00:00"))
    got = {r["field"]: r["same"] for r in rep.collect()}
    assert got == {"rows_qty": True, "min_date": True, "max_date": False,
                   "railway_names": True, "station_names": True}
    assert validate(_fp(spark, 10), _fp(spark, 11)) == ["rows_qty"]


def test_status_record_json_escapes_apostrophe_and_quotes(spark):
    fp = spark.createDataFrame([(1, "a", "b", "O'Neil", 'x"y')],
                               "rows_qty bigint, min_date string, max_date string, railway_names string, station_names string")
    info = status_record(fp, "t").first()["table_info"]
    assert json.loads(info)["railway_names"] == "O'Neil"
    assert json.loads(info)["station_names"] == 'x"y'


def test_normalise_movements(spark):
    src = make_sources(spark, [movement(railway='"R1"', station='"S"', wagon=None, container="c1"),
                               movement(railway="R2", container="C2")], [])
    mv = normalise_movements(src.movements)
    assert rows(mv, "railway_from", "station_from", "wagon_no", "container_no") == [
        ("R1", "S", "", "c1"), ("R2", '"ST1"'.replace('"', ""), "W1", "C2")]
    assert normalise_movements(src.movements, railway='"R1"').count() == 1
    assert rows(normalise_movements(src.movements, normalise_container=True), "container_no") == [("C1",), ("C2",)]
    assert mv.filter(F.col("container_no") == "c1").count() == 1
