"""Billing events: ledger lines per order, container, service and route, with names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session
from ..functions.columns import any_nonzero
from ..functions.joins import DEFAULT_BROADCAST_BYTES, fitting, lookup, measured_bytes
from ..functions.key_filter import KeyFilter
from ..functions.money import from_units, money_scale, to_units, unit_sum
from ..schemas import EVENT_COLUMNS, EVENT_NAME_COLUMNS, INVOICE_CODES
from ..sources.tables import Sources
from .invoices import ledger_container
from .movements import containers

#: How often each dimension is looked up.
_ROLES = {"counterparty": 1, "service": 1, "location": 2, "stations": 2}

#: The six lookups: dimension, id column of the lines, key and name of the dimension, output column.
_LOOKUPS = (
    ("counterparty", "client_id", "id", "name", "client_name"),
    ("service", "service_id", "id", "name", "service_name"),
    ("location", "from_point_id", "id", "name", "points_from_name"),
    ("location", "to_point_id", "id", "name", "points_to_name"),
    ("stations", "from_station_id", "station_code", "station_name", "station_name_from"),
    ("stations", "to_station_id", "station_code", "station_name", "station_name_to"),
)


def billing_events(sources: Sources, movements_n: DataFrame, only_moved: bool = True,
                   max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, moved: KeyFilter | None = None,
                   place: Callable[[DataFrame], DataFrame] | None = None, stay: bool = False) -> DataFrame:
    """Events of the four invoice codes for movement containers.

    Grouped by (order, container, client, service, points from/to, stations
    from/to) *names*: ``date_e`` = earliest ``date_end``, summed amounts; groups
    with both sums zero (or NULL) are dropped.

    Plan: the lines look their names up (first in the dimensions that are too large to be broadcast, by shuffle joins of the
    narrow lines) and are grouped once, by names, combined map-side (including the effect of a repeated
    dimension key).  The grouping has the order in its key, so a hot
    container is spread over all tasks.  ``moved``, a filter of the moved containers
    (``functions.key_filter``), drops most lines of other containers before the first shuffle; the exact
    container test comes last, as a semi-join whose skewed partitions AQE may split.
    ``only_moved=False`` leaves the test out for callers that join the events to the movements anyway.
    ``place`` may lay the lines out (by ``container_no``, say) before the broadcast lookups and the grouping;
    ``stay=True``: only if shuffle joins have moved them.  More than ``session.STEP_ROWS`` lines that shuffle joins have moved are
    stored, so that the files of those exchanges are gone before the next ones.
    The dimensions that are broadcast hold at most ``max_broadcast_bytes`` together, counted once for each role.
    """
    rub_scale = money_scale(sources.ledger, "amount_in_rub_without_vat")
    cur_scale = money_scale(sources.ledger, "amount_in_contract_currency_without_vat")
    # Amounts are summed as long minor units (exact; see functions.money).
    lines = (sources.ledger
             .filter(F.col("esu_id").isin(*INVOICE_CODES))
             .select(F.col("service_details_order_id").alias("order_id"),
                     ledger_container(sources.ledger).alias("container_no"),
                     F.col("client_number_id").alias("client_id"),
                     F.col("esu_id").alias("service_id"),
                     F.col("service_details_points_from_catalog_id").alias("from_point_id"),
                     F.col("service_details_points_to_catalog_id").alias("to_point_id"),
                     F.col("service_details_points_from_station_id").alias("from_station_id"),
                     F.col("service_details_points_to_station_id").alias("to_station_id"),
                     "date_end",
                     to_units("amount_in_rub_without_vat", rub_scale).alias("rub"),
                     to_units("amount_in_contract_currency_without_vat", cur_scale).alias("cur")))
    if moved is not None:
        lines = moved(lines, "container_no")
    size = sources.dim_bytes or measured_bytes(
        {"counterparty": sources.dict_counterparty, "service": sources.dict_service,
         "location": sources.dict_location, "stations": sources.dict_stations})
    small = fitting({name: n * _ROLES[name] for name, n in size.items()}, max_broadcast_bytes)
    dims = {"counterparty": sources.dict_counterparty, "service": sources.dict_service,
            "location": sources.dict_location, "stations": sources.dict_stations}
    # Shuffle joins come first, while the lines carry ids only.
    named = lines
    for hinted in (False, True):
        for dim, id_column, key, name, output in _LOOKUPS:
            if small[dim] == hinted:
                named = lookup(named, dims[dim], id_column, key, {name: output}, broadcast=hinted).drop(id_column)
        if hinted:
            continue
        moving = not all(small.values())
        if moving and sources.ledger.count() > session.STEP_ROWS:
            named, _ = session.stored_step(named, "named")
        if place is not None and (moving or not stay):
            named = place(named)
    events = (named.groupBy("order_id", "container_no", *EVENT_NAME_COLUMNS)
              .agg(F.min("date_end").alias("date_e"), unit_sum("rub", rub_scale).alias("rub_sum"),
                   unit_sum("cur", cur_scale).alias("cur_sum"))
              .filter(any_nonzero("rub_sum", "cur_sum"))
              .withColumn("rub_sum", from_units("rub_sum", rub_scale))
              .withColumn("cur_sum", from_units("cur_sum", cur_scale)))
    if only_moved:
        events = events.join(containers(movements_n), "container_no", "left_semi")
    return events.select(*EVENT_COLUMNS)
