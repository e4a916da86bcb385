"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the audit inputs derived from the test tables of ``sf_dir``
(``sources.testdata.load``) and runs over the whole tables.  Decimal sums are
returned as double so that results compare across engines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import replace
from functools import cache, reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import decimals_to_double, strip_quotes
from ..functions.key_filter import key_filter
from ..operators.billing import billing_events
from ..operators.content import merged_fingerprint, movement_states
from ..operators.enrich import (enriched_with_defaults, heavy_pairs, movements_with_invoices, presentation_names,
                                published_table)
from ..operators.fingerprint import (compare_fingerprints, fingerprint, processed_fingerprint,
                                     refresh_decision, source_fingerprint)
from ..operators.invoices import invoice_match, ledger_by_document, with_document_fallback
from ..operators.movements import normalise_movements, railway_list
from ..operators.nearest import nearest_after, nearest_before, nearest_billing, split_points
from ..session import partitions_of, work_path
from ..sources import testdata
from .buckets import build_from_buckets, open_buckets, store_buckets
from .build import build_enriched
from .commits import commit_history
from .file_states import folder_fingerprint
from .oracle import ADDED_RAILWAY, COPIED_RAILWAY, LEDGER_CONTAINER, ONE_RAILWAY, REMOVED_RAILWAY, TRACKED
from .publish import (activate, append_status, build_sliced, compact_status, in_passes, latest_status, missing_status, publish, read_live,
                      status_record, write_snapshot)
from .refresh import TABLE_NAME
from .slices import changed_slices, read_slices, refresh_slices, slice_fingerprints

Query = Callable[[SparkSession, str], DataFrame]


def _src(spark: SparkSession, sf_dir: str):
    return testdata.load(spark, sf_dir)


def _mv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise_movements(_src(spark, sf_dir).movements)


def q_source_fingerprint(spark, sf_dir):
    return source_fingerprint(_src(spark, sf_dir).movements)


def q_fingerprint_strip_after(spark, sf_dir):
    return source_fingerprint(_src(spark, sf_dir).movements, strip="after")


def q_processed_fingerprint(spark, sf_dir):
    return processed_fingerprint(_mv(spark, sf_dir))


@cache
def _code_print() -> str:
    """Hash of the package's sources (without the optional subpackage), so that a stored build never outlives its code."""
    root = Path(__file__).parents[1]
    files = sorted(f for f in root.rglob("*.py") if "llm" not in f.relative_to(root).parts)
    return hashlib.sha1(b"".join(f.read_bytes() for f in files)).hexdigest()[:12]


def _published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published table (numbers, engine names) of these inputs, built and published once per input snapshot and code."""
    root = work_path(spark, "published", f"{testdata.signature(spark, sf_dir)}-{_code_print()}")
    live = read_live(spark, root)
    if live is None:
        src = _src(spark, sf_dir)
        with in_passes(build_enriched(src, number=True), src.movements.count()) as placed:
            publish(placed, root, view_name=None)
        live = read_live(spark, root)
    return live


def q_refresh_decision(spark, sf_dir):
    """The decision in four cases, one for each reason."""
    src, live = _src(spark, sf_dir), _published(spark, sf_dir)
    one = ONE_RAILWAY.replace('"', "")
    source, target = source_fingerprint(src.movements), processed_fingerprint(live)
    a_slice = processed_fingerprint(live.filter(F.col("railway_from") == one))
    later = source_fingerprint(src.movements.withColumn(
        "datetime_move_started", F.col("datetime_move_started") + F.expr("INTERVAL 1 DAY")))
    cases = {"same": (source, target), "one_slice_published": (source, a_slice),
             "source_of_one_slice": (a_slice, target), "a_day_later": (later, target)}
    return reduce(DataFrame.unionByName, [
        refresh_decision(s, t).select(F.lit(name).alias("case_name"), "*") for name, (s, t) in cases.items()])


def q_fingerprint_diff(spark, sf_dir):
    src = _src(spark, sf_dir)
    return compare_fingerprints(source_fingerprint(src.movements), processed_fingerprint(_published(spark, sf_dir)))


def q_normalised_movements(spark, sf_dir):
    return _mv(spark, sf_dir)


def q_movements_one_railway(spark, sf_dir):
    return normalise_movements(_src(spark, sf_dir).movements, railway=ONE_RAILWAY)


def q_railway_list(spark, sf_dir):
    return railway_list(source_fingerprint(_src(spark, sf_dir).movements))


def q_ledger_by_document(spark, sf_dir):
    src = _src(spark, sf_dir)
    mv = normalise_movements(src.movements)
    return decimals_to_double(ledger_by_document(src.ledger, mv, moved=key_filter(mv, "container_no")))


def q_document_fallback(spark, sf_dir):
    src = _src(spark, sf_dir)
    mv = normalise_movements(src.movements)
    grouped = ledger_by_document(src.ledger, mv, keep_blank_documents=True, moved=key_filter(mv, "container_no"))
    return decimals_to_double(with_document_fallback(grouped))


def q_invoice_match(spark, sf_dir):
    src = _src(spark, sf_dir)
    return decimals_to_double(invoice_match(src.ledger, normalise_movements(src.movements)))


def q_invoice_match_two_level(spark, sf_dir):
    src = _src(spark, sf_dir)
    return decimals_to_double(invoice_match(src.ledger, normalise_movements(src.movements), method="two_level"))


def q_invoice_match_fallback(spark, sf_dir):
    src = _src(spark, sf_dir)
    return decimals_to_double(invoice_match(src.ledger, normalise_movements(src.movements),
                                            keep_blank_documents=True))


def q_billing_events(spark, sf_dir):
    src = _src(spark, sf_dir)
    return decimals_to_double(billing_events(src, normalise_movements(src.movements)))


def q_billing_events_filtered(spark, sf_dir):
    """The same; lines of containers that never moved are dropped before the first shuffle."""
    src = _src(spark, sf_dir)
    mv = normalise_movements(src.movements)
    return decimals_to_double(billing_events(src, mv, moved=key_filter(mv, "container_no")))


#: Chunks of the queries that show the split path: many more than the tables need, so that most containers are split.
SKEW_CHUNKS = 4000


def _nearest(method: str, side: str | None = None, chunks: int | None = None) -> Query:
    def run(spark, sf_dir):
        src = _src(spark, sf_dir)
        mv = normalise_movements(src.movements)
        events = billing_events(src, mv, only_moved=False)  # the scan ignores other containers
        splits = split_points(mv, src.ledger, chunks) if method == "scan" else None
        fn = {None: nearest_billing, "before": nearest_before, "after": nearest_after}[side]
        return decimals_to_double(fn(events, mv, method, splits))
    return run


def q_movements_with_invoices(spark, sf_dir):
    src = _src(spark, sf_dir)
    mv = normalise_movements(src.movements)
    return decimals_to_double(movements_with_invoices(mv, invoice_match(src.ledger, mv)))


def q_invoices_of_heavy_pair(spark, sf_dir):
    """About half of the movements moved to one pair that has an invoice: its rows are dealt out over pieces."""
    src = _src(spark, sf_dir)
    mv = normalise_movements(src.movements)
    invoices = invoice_match(src.ledger, mv, only_shipped=False)
    first = invoices.agg(F.min(F.struct("invoice_document_no", "invoice_container_no")).alias("p")).first()["p"]
    moved = F.col("ownerships") == "N"
    skewed = mv.withColumns({
        "container_no": F.when(moved, F.lit(first["invoice_container_no"])).otherwise(F.col("container_no")),
        "shipment_no": F.when(moved, F.lit(first["invoice_document_no"])).otherwise(F.col("shipment_no"))})
    partitions = partitions_of(spark, src.movements.count())
    return decimals_to_double(movements_with_invoices(skewed, invoices, heavy_pairs(skewed, table_rows=0), partitions))


def q_enriched_movements(spark, sf_dir):
    return decimals_to_double(build_enriched(_src(spark, sf_dir)))


def q_enriched_skew_path(spark, sf_dir):
    # Every container that a split point falls in is cut into chunks, end to end; in small tables most are.
    return decimals_to_double(build_enriched(_src(spark, sf_dir), chunks=SKEW_CHUNKS, rest_whole=True))


def q_enriched_with_defaults(spark, sf_dir):
    return decimals_to_double(enriched_with_defaults(build_enriched(_src(spark, sf_dir))))


def q_enriched_presentation(spark, sf_dir):
    return decimals_to_double(presentation_names(build_enriched(_src(spark, sf_dir))))


def q_enriched_from_buckets(spark, sf_dir):
    """From the fact tables stored by container, once per input snapshot and code."""
    src = _src(spark, sf_dir)
    root = work_path(spark, "stored", f"{testdata.signature(spark, sf_dir)}-{_code_print()}")
    stored = open_buckets(spark, root)
    if stored is None:
        store_buckets(spark, src, root)
        stored = open_buckets(spark, root)
    return decimals_to_double(build_from_buckets(stored, src))


def _run_folder(spark: SparkSession, kind: str) -> str:
    import uuid
    return work_path(spark, "runs", f"{kind}-{uuid.uuid4().hex[:12]}")


def q_sliced_build(spark, sf_dir):
    src = _src(spark, sf_dir)
    out = build_sliced(build_enriched(src), _run_folder(spark, "staging"), files=partitions_of(spark, src.movements.count()))
    return decimals_to_double(out)


def q_numbered_movements(spark, sf_dir):
    return decimals_to_double(build_enriched(_src(spark, sf_dir), number=True))


def q_published_snapshot(spark, sf_dir):
    return decimals_to_double(_published(spark, sf_dir))


def q_published_presentation(spark, sf_dir):
    root = _run_folder(spark, "publish")
    src = _src(spark, sf_dir)
    # Defaults, labels and markers are added after the rows are placed, so they are not shuffled.
    with in_passes(build_enriched(src, number=True), src.movements.count()) as placed:
        publish([published_table(part) for part in placed], root, view_name=None)
    return decimals_to_double(read_live(spark, root))


def q_table_status(spark, sf_dir):
    return status_record(processed_fingerprint(_published(spark, sf_dir)), TABLE_NAME)


def _day_before(src):
    """The sources as they may have been before: one railway missing, one updated without a change of count, dates or
    names, and one that is gone today."""
    name, mv = strip_quotes("railway_from_name"), src.movements
    changed = (name == ONE_RAILWAY.replace('"', "")) & F.col("goods_etsng").startswith("PROMO")
    kept = mv.filter(name != ADDED_RAILWAY).withColumn("ownerships_type", F.when(changed, F.lit("before")).otherwise(F.col("ownerships_type")))
    gone = mv.filter(name == COPIED_RAILWAY).withColumn("railway_from_name", F.lit(f'"{REMOVED_RAILWAY}"'))
    return replace(src, movements=kept.unionByName(gone))


def _without_container(src):
    return replace(src, ledger=src.ledger.filter(F.upper("service_details_container_number") != LEDGER_CONTAINER))


def q_changed_slices(spark, sf_dir):
    src = _src(spark, sf_dir)
    now = slice_fingerprints(src)
    cases = {"movements": _day_before(src), "ledger": _without_container(src), "same": src}
    return reduce(DataFrame.unionByName, [
        changed_slices(now, slice_fingerprints(before)).select(F.lit(name).alias("case_name"), "railway", "status")
        for name, before in cases.items()])


def q_sliced_refresh(spark, sf_dir):
    """The table after a first build and a rebuild of what changed since."""
    src, root = _src(spark, sf_dir), _run_folder(spark, "slices")
    refresh_slices(spark, _day_before(src), root)
    refresh_slices(spark, src, root)
    return decimals_to_double(read_slices(spark, root))


def q_commit_history(spark, sf_dir):
    """A table published once, then by two writers that both saw the first version."""
    mv, root = _mv(spark, sf_dir), _run_folder(spark, "commits")
    one = mv.filter(F.col("railway_from") == ONE_RAILWAY.replace('"', ""))
    activate(spark, root, *write_snapshot(one, root), view_name=None)
    slow, fast = write_snapshot(one, root), write_snapshot(mv, root)
    activate(spark, root, *fast, view_name=None)
    activate(spark, root, *slow, view_name=None)
    history = commit_history(spark, root)
    rows = reduce(DataFrame.unionByName, [spark.read.parquet(r["path"]).agg(F.lit(r["version"]).alias("version"), F.count(F.lit(1)).alias("rows_qty"))
                                          for r in history.collect()])
    return history.drop("path").join(rows, "version")


def q_content_fingerprint(spark, sf_dir):
    """States of half of the files, then of all: only the other half is read, and the merged states equal one pass."""
    src, root = _src(spark, sf_dir), _run_folder(spark, "states")
    files = sorted(src.movements.inputFiles())
    first = folder_fingerprint(spark, files[:len(files) // 2] or files, root)
    merged = folder_fingerprint(spark, files, root)
    content = merged_fingerprint(movement_states(src.movements)).first()["content"]
    update = F.when(F.col("goods_etsng").startswith("PROMO"), F.lit("before")).otherwise(F.col("ownerships_type"))
    updated = merged_fingerprint(movement_states(src.movements.withColumn("ownerships_type", update))).first()["content"]
    return merged.fingerprint.select(
        "rows_qty", "min_date", "max_date", "railway_names", "station_names", (F.col("content") == content).alias("same_as_one_pass"),
        (F.col("content") != updated).alias("sees_updates"), F.lit(len(first.read) + len(merged.read) == len(files)).alias("each_file_read_once"))


def _status_log(spark, sf_dir) -> tuple[DataFrame, str]:
    """The movements, and a log with two states each of two railways."""
    mv, root = _mv(spark, sf_dir), _run_folder(spark, "status")
    for returned in (True, False):
        for railway in TRACKED:
            own = mv.filter(F.col("railway_from") == railway)
            append_status(status_record(processed_fingerprint(own.filter("ownerships = 'R'") if returned else own), railway), root)
        if returned:
            compact_status(spark, root)  # the later states are read from the log, over the checkpoint
    return mv, root


def q_latest_status(spark, sf_dir):
    _, root = _status_log(spark, sf_dir)
    return latest_status(spark, root).select("table_name", "table_info")


def q_missing_status(spark, sf_dir):
    mv, root = _status_log(spark, sf_dir)
    return missing_status(mv.select(F.col("railway_from").alias("table_name")), root)


QUERIES: dict[str, Query] = {
    "source_fingerprint": q_source_fingerprint,
    "fingerprint_strip_after": q_fingerprint_strip_after,
    "processed_fingerprint": q_processed_fingerprint,
    "refresh_decision": q_refresh_decision,
    "fingerprint_diff": q_fingerprint_diff,
    "normalised_movements": q_normalised_movements,
    "movements_one_railway": q_movements_one_railway,
    "railway_list": q_railway_list,
    "ledger_by_document": q_ledger_by_document,
    "document_fallback": q_document_fallback,
    "invoice_match": q_invoice_match,
    "invoice_match_two_level": q_invoice_match_two_level,
    "invoice_match_fallback": q_invoice_match_fallback,
    "billing_events": q_billing_events,
    "billing_events_filtered": q_billing_events_filtered,
    "nearest_billing": _nearest("scan"),
    "nearest_billing_window": _nearest("window"),
    # Most containers split over several chunks: carries over the edges, end to end.
    "nearest_billing_skew_path": _nearest("scan", chunks=SKEW_CHUNKS),
    "nearest_billing_join": _nearest("join"),
    "nearest_before": _nearest("scan", "before"),
    "nearest_after": _nearest("scan", "after"),
    "movements_with_invoices": q_movements_with_invoices,
    "invoices_of_heavy_pair": q_invoices_of_heavy_pair,
    "enriched_movements": q_enriched_movements,
    "enriched_skew_path": q_enriched_skew_path,
    "enriched_from_buckets": q_enriched_from_buckets,
    "enriched_with_defaults": q_enriched_with_defaults,
    "enriched_presentation": q_enriched_presentation,
    "sliced_build": q_sliced_build,
    "numbered_movements": q_numbered_movements,
    "published_snapshot": q_published_snapshot,
    "published_presentation": q_published_presentation,
    "table_status": q_table_status,
    "changed_slices": q_changed_slices,
    "sliced_refresh": q_sliced_refresh,
    "commit_history": q_commit_history,
    "content_fingerprint": q_content_fingerprint,
    "latest_status": q_latest_status,
    "missing_status": q_missing_status,
}
