"""Invoice match: what was billed per service code for a container + shipment document.

Two forms with equal results when blank document numbers are dropped (the
audited job's behaviour):

* ``one_level`` (default): one map-side-combined aggregation of the ledger by
  (document, container) with eight conditional sums, then a semi-join with the
  movement (container, shipment) pairs.  One shuffle of the ledger, and a hot
  key is collapsed before it is shuffled.
* ``two_level``: the audited job's shape.  Group by (document, order, container,
  service), keep non-zero groups, take the document-number fallback, join the
  movement pairs and pivot the sums.  Needed for ``keep_blank_documents=True``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_nonzero, upper_utf8
from ..functions.key_filter import KeyFilter
from ..functions.money import from_units, money_scale, to_units, unit_sum
from ..schemas import (DOCUMENT_CODE, INVOICE_AMOUNT_COLUMNS, INVOICE_CODES, INVOICE_FILTER_CODES,
                       cur_column, rub_column)
from .movements import containers, shipment_keys

RUB = "amount_in_rub_without_vat"
CUR = "amount_in_contract_currency_without_vat"


def ledger_container(ledger: DataFrame) -> Column:
    """The upper-cased container; a stored ledger (``plans.buckets``) has it already, as ``container_no``."""
    return F.col("container_no") if "container_no" in ledger.columns else upper_utf8("service_details_container_number")


def ledger_lines(ledger: DataFrame, codes: tuple[str, ...]) -> DataFrame:
    """Ledger rows of the given service codes, with the container upper-cased and
    the amounts as long minor units (``rub``, ``cur``; see ``functions.money``)."""
    return (ledger
            .filter(F.col("esu_id").isin(*codes))
            .select(F.col("document_reasons_number").alias("document_no"),
                    F.col("service_details_order_id").alias("order_id"),
                    ledger_container(ledger).alias("container_no"),
                    "esu_id",
                    F.col("date_end"),
                    to_units(RUB, money_scale(ledger, RUB)).alias("rub"),
                    to_units(CUR, money_scale(ledger, CUR)).alias("cur")))


def _ledger_groups(ledger: DataFrame, movements_n: DataFrame, keep_blank_documents: bool,
                   moved: KeyFilter | None = None) -> DataFrame:
    """Level one in minor units (``rub_sum``, ``cur_sum`` are longs)."""
    lines = ledger_lines(ledger, INVOICE_FILTER_CODES)
    if moved is not None:
        lines = moved(lines, "container_no")
    if not keep_blank_documents:
        lines = lines.filter(F.col("document_no") != "")
    grouped = (lines.groupBy("document_no", "order_id", "container_no", "esu_id")
               .agg(F.min("date_end").alias("date_e"),
                    unit_sum("rub", money_scale(ledger, RUB)).alias("rub_sum"),
                    unit_sum("cur", money_scale(ledger, CUR)).alias("cur_sum"))
               .filter(any_nonzero("rub_sum", "cur_sum")))
    return grouped.join(containers(movements_n), "container_no", "left_semi")


def _as_money(df: DataFrame, ledger: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Turn the named minor-unit columns back into decimal amounts (in place)."""
    for name, source in pairs:
        df = df.withColumn(name, from_units(name, money_scale(ledger, source)))
    return df


def ledger_by_document(ledger: DataFrame, movements_n: DataFrame,
                       keep_blank_documents: bool = False, moved: KeyFilter | None = None) -> DataFrame:
    """Ledger grouped by (document, order, container, service) for movement containers.

    ``date_e`` is the earliest ``date_end``; groups whose two sums are both zero
    (or NULL) are dropped.  ``moved``, a filter of the moved containers (``functions.key_filter``), drops most lines of
    other containers before the shuffle; the exact container test comes after the map-side combined aggregation: it
    depends on a group key only, so the result is the same.
    """
    grouped = _ledger_groups(ledger, movements_n, keep_blank_documents, moved)
    return _as_money(grouped, ledger, [("rub_sum", RUB), ("cur_sum", CUR)])


def with_document_fallback(grouped: DataFrame) -> DataFrame:
    """Add ``document_no_processed``: a blank document number is replaced by the
    smallest non-blank document number of a ``0.02.01.01`` group of the same
    container and ``date_e``; rows still without a number are dropped.

    The fallback is a grouped aggregate joined back (null-safe, as a window
    partition would group NULLs), not a window: a hot container + date is then
    combined map-side instead of landing in one window task.
    """
    fallback = (grouped
                .filter((F.col("esu_id") == DOCUMENT_CODE) & (F.col("document_no") != ""))
                .groupBy("container_no", "date_e")
                .agg(F.min("document_no").alias("fallback_document_no")))
    g, fb = grouped.alias("g"), fallback.alias("fb")
    joined = g.join(fb, F.col("g.container_no").eqNullSafe(F.col("fb.container_no"))
                    & F.col("g.date_e").eqNullSafe(F.col("fb.date_e")), "left")
    processed = (F.when(F.col("g.document_no") == "", F.col("fb.fallback_document_no"))
                  .otherwise(F.col("g.document_no")))
    return (joined.select("g.*", processed.alias("document_no_processed"))
                  .filter(F.col("document_no_processed") != ""))


def _pivot_sums(ledger: DataFrame, rub: str, cur: str) -> list:
    """Eight conditional sums in minor units (0 where a code has no rows)."""
    aggs = []
    for code in INVOICE_CODES:
        hit = F.col("esu_id") == code
        for name, source, out in ((rub, RUB, rub_column(code)), (cur, CUR, cur_column(code))):
            total = unit_sum(F.when(hit, F.col(name)), money_scale(ledger, source))
            aggs.append(F.coalesce(total, F.lit(0).cast("long")).alias(out))
    return aggs


def _pivot_as_money(df: DataFrame, ledger: DataFrame) -> DataFrame:
    return _as_money(df, ledger, [(rub_column(c), RUB) for c in INVOICE_CODES] +
                     [(cur_column(c), CUR) for c in INVOICE_CODES])


def invoice_match(ledger: DataFrame, movements_n: DataFrame, keep_blank_documents: bool = False,
                  method: str = "one_level", only_shipped: bool = True) -> DataFrame:
    """Per (document, container) billed sums for the four invoice codes.

    Output: ``invoice_document_no, invoice_container_no`` and eight sums
    ``rub_<code>, cur_<code>`` (0 where a code has no rows); only pairs that
    occur as (container, shipment) in the movements and have a non-zero sum.
    ``only_shipped=False`` leaves the pair test out, for callers that join the
    result to the movements anyway (``one_level`` only).
    """
    if keep_blank_documents and method == "one_level":
        method = "two_level"
    pairs = shipment_keys(movements_n)
    if method == "one_level":
        lines = ledger_lines(ledger, INVOICE_CODES).filter(F.col("document_no") != "")
        pivot = (lines.groupBy("container_no", "document_no")
                 .agg(*_pivot_sums(ledger, "rub", "cur"))
                 .filter(any_nonzero(*INVOICE_AMOUNT_COLUMNS)))
        # Keys in the order of the pairs' own grouping, so their exchange serves the join too.
        matched = pivot if not only_shipped else pivot.join(
            pairs, (pivot.container_no == pairs.container_no) & (pivot.document_no == pairs.shipment_no), "left_semi")
        return _pivot_as_money(matched.select(F.col("document_no").alias("invoice_document_no"),
                                              F.col("container_no").alias("invoice_container_no"),
                                              *INVOICE_AMOUNT_COLUMNS), ledger)
    if method != "two_level":
        raise ValueError("method must be 'one_level' or 'two_level'")
    grouped = _ledger_groups(ledger, movements_n, keep_blank_documents)
    if keep_blank_documents:
        grouped = with_document_fallback(grouped)
    else:
        grouped = grouped.withColumn("document_no_processed", F.col("document_no"))
    matched = grouped.join(pairs, (grouped.container_no == pairs.container_no)
                           & (grouped.document_no_processed == pairs.shipment_no), "left_semi")
    pivot = (matched.groupBy(F.col("document_no_processed").alias("invoice_document_no"),
                             F.col("container_no").alias("invoice_container_no"))
             .agg(*_pivot_sums(ledger, "rub_sum", "cur_sum"))
             .filter(any_nonzero(*INVOICE_AMOUNT_COLUMNS)))
    return _pivot_as_money(pivot, ledger)
