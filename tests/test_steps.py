"""Large tables are built in steps: each step's shuffle files go, and the driver's samples are bounded."""
from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from conftest import line, make_sources, movement, rows
from revaudit import session
from revaudit.operators.numbering import number_rows
from revaudit.plans import publish as publishing
from revaudit.plans.build import build_enriched
from revaudit.plans.publish import in_passes, publish
from revaudit.plans.refresh import refresh
from revaudit.session import bounded_sample, shuffles_removed, stored_step, work_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SAMPLE = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


def _sources(spark, n=120):
    moves = [movement(f"C{k % 30}", f"2020-01-{1 + k % 20:02d} 00:00:00", f"S{k % 7}") for k in range(n)] + [movement(None, None, None)] * 2
    lines = [line(f"c{k % 30}", f"S{k % 7}", "0.01.01.01", when=f"2020-01-{1 + k % 15:02d} 00:00:00", order=k) for k in range(n)]
    return make_sources(spark, moves, lines)


def _shuffle_files(spark) -> set[str]:
    """Shuffle files of a local session, below the block manager's folders."""
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_shuffle_files_of_a_step_are_removed(spark):
    """Every written step: inputs, snapshots, slices, buckets."""
    want = sorted((k, 10) for k in range(100))
    before = _shuffle_files(spark)
    table, path = stored_step(spark.range(1000).groupBy((F.col("id") % 100).alias("k")).count(), "tests")
    for _ in range(50):  # the files go in the background
        if _shuffle_files(spark) <= before:
            break
        import time
        time.sleep(0.1)
    assert _shuffle_files(spark) <= before
    assert rows(table) == sorted(want, key=str) and spark.conf.get(CLEANUP) == "false"
    assert all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in glob.glob(f"{path.removeprefix('file://')}/*.parquet"))


def test_settings_come_back_after_a_failure(spark):
    try:
        with shuffles_removed(spark), bounded_sample(spark, 10_000):
            assert spark.conf.get(CLEANUP) == "true" and spark.conf.get(SAMPLE) == "10"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(CLEANUP) == "false" and spark.conf.get(SAMPLE) == "100"
    with bounded_sample(spark, 5):
        assert spark.conf.get(SAMPLE) == "100"


def test_numbers_from_stored_rows_are_the_same(spark):
    """numbered_movements: also with repeated and null rows."""
    df = spark.createDataFrame([(k % 7 if k % 5 else None, f"t{k % 3}") for k in range(200)], "a int, b string")
    assert rows(number_rows(df, ["b"], partitions=6, stored=True)) == rows(number_rows(df, ["b"], partitions=6))
    plan = number_rows(df, ["b"], partitions=6, stored=True)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


def _placing(spark) -> list[str]:
    return os.listdir(work_path(spark, "placing").removeprefix("file:")) if os.path.isdir(work_path(spark, "placing").removeprefix("file:")) else []


def test_large_tables_are_placed_in_passes(spark, scratch_dir, monkeypatch):
    """published_presentation, published_snapshot, refresh_decision, table_status, fingerprint_diff."""
    src = _sources(spark)
    columns = ("rownumber", "container_no", "dispatch_ts", "invoice_document_no", "before_order_id", "after_order_id")
    want = rows(build_enriched(src, number=True), *columns)
    with in_passes(build_enriched(src, number=True), 122) as parts:
        assert len(parts) == 1 and not _placing(spark)  # small: one job
    monkeypatch.setattr(session, "STEP_ROWS", 50)
    monkeypatch.setattr(publishing, "PASS_ROWS", 50)
    for total in (122, 100):  # numbers beyond the total are kept, too
        with in_passes(build_enriched(src, number=True), total) as parts:
            assert len(parts) == -(-total // 50) and len(_placing(spark)) == 1
            path = publish(parts, f"{scratch_dir}/{total}", view_name=None)
        assert not _placing(spark)
        table = spark.read.parquet(path)
        assert rows(table, *columns) == want
        spans = sorted((r["lo"], r["hi"]) for r in table.groupBy(F.input_file_name()).agg(F.min("rownumber").alias("lo"), F.max("rownumber").alias("hi")).collect())
        assert len(spans) >= len(parts) and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_refresh_places_in_passes(spark, scratch_dir, monkeypatch):
    src = _sources(spark)
    for shown in (True,):
        whole = refresh(spark, src, f"{scratch_dir}/whole{shown}", presentation=shown)
        with monkeypatch.context() as m:
            m.setattr(session, "STEP_ROWS", 50)
            m.setattr(publishing, "PASS_ROWS", 50)
            parted = refresh(spark, src, f"{scratch_dir}/parted{shown}", presentation=shown)
        assert whole.refreshed and parted.refreshed
        a, b = spark.read.parquet(whole.snapshot), spark.read.parquet(parted.snapshot)
        assert a.columns == b.columns and a.count() == b.count() == 122
        assert a.exceptAll(b).count() == 0


def test_sliced_build_in_passes(spark, scratch_dir, monkeypatch):
    """sliced_build, sliced_refresh: the same rows, in files of disjoint times, whatever the number of passes; NULL times stay."""
    enriched = build_enriched(_sources(spark))
    want = rows(publishing.build_sliced(enriched, f"{scratch_dir}/one"), "container_no", "dispatch_ts", "before_order_id", "railway_from")
    monkeypatch.setattr(publishing, "PASS_ROWS", 30)
    out = publishing.build_sliced(enriched, f"{scratch_dir}/many", files=8)
    assert rows(out, "container_no", "dispatch_ts", "before_order_id", "railway_from") == want and len(want) == 122
    spans = sorted((r["lo"], r["hi"]) for r in out.groupBy(F.input_file_name()).agg(F.min("dispatch_ts").alias("lo"), F.max("dispatch_ts").alias("hi")).collect()
                   if r["lo"] is not None)
    assert len(spans) > 4 and all(x[1] < y[0] for x, y in zip(spans, spans[1:]))
    left = work_path(spark, "slicing").removeprefix("file:")
    assert not os.listdir(left)
    same_time = enriched.withColumn("dispatch_ts", F.lit("2020-01-01").cast("timestamp_ntz"))
    assert publishing.build_sliced(same_time, f"{scratch_dir}/same").count() == 122


def test_moved_lines_are_stored_and_come_back_to_their_buckets(spark, scratch_dir, monkeypatch):
    """enriched_from_buckets beyond the broadcast bound: no exchange of the movements; enriched_movements, nearest_before, nearest_after: same rows."""
    from revaudit.operators import billing
    from revaudit.plans.buckets import build_in_buckets, open_buckets, store_buckets
    src = _sources(spark)
    columns = ("container_no", "dispatch_ts", "invoice_document_no", "before_order_id", "before_client_name", "after_station_name_to")
    want = rows(build_enriched(src), *columns)
    store_buckets(spark, src, scratch_dir, buckets=4)
    stored = open_buckets(spark, scratch_dir)
    held = rows(build_in_buckets(stored, src), *columns)
    monkeypatch.setattr(billing, "fitting", lambda sizes, most: dict.fromkeys(sizes, False))
    monkeypatch.setattr(session, "STEP_ROWS", 50)
    steps = []
    real = session.stored_step
    monkeypatch.setattr(session, "stored_step", lambda table, kind: steps.append(kind) or real(table, kind))
    assert rows(build_enriched(src), *columns) == want and steps == ["named"]
    built = build_in_buckets(stored, src)
    assert rows(built, *columns) == held
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan  # the lines, back into the buckets


def test_broadcasts_stay_small():
    """enriched_movements, enriched_presentation, nearest_before, nearest_after: the driver builds no large relations."""
    from revaudit.functions.joins import DEFAULT_BROADCAST_BYTES, fitting
    stations = 2 * 90 * 360_000
    assert DEFAULT_BROADCAST_BYTES <= 16 << 20 and not fitting({"stations": stations}, DEFAULT_BROADCAST_BYTES)["stations"]


def test_days_joined_move_the_events_once(spark):
    """nearest_billing_join: days with events before and after, days without, times without a date; as the scan."""
    from revaudit.operators.billing import billing_events
    from revaudit.operators.movements import normalise_movements
    from revaudit.operators.nearest import nearest_billing
    moves = [movement(f"C{k % 5}", f"2020-01-{1 + k % 28:02d} 12:00:00") for k in range(60)] + [movement("C1", None), movement(None)]
    lines = [line(f"c{k % 6}", when=f"2020-01-{3 + k * 7 % 25:02d} {k % 24:02d}:00:00", order=k) for k in range(25)] + [line("c1", when=None)]
    src = make_sources(spark, moves, lines)
    mv = normalise_movements(src.movements)
    events = billing_events(src, mv, only_moved=False)
    got = nearest_billing(events, mv, "join")
    assert rows(got) == rows(nearest_billing(events, mv, "window")) and len(rows(got)) > 50
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 1 and "max(high" not in plan.split("Window")[0]
