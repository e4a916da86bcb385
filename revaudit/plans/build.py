"""The enrichment plan: movements + invoice match + nearest billing."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.billing import billing_events
from ..operators.enrich import enrich, heavy_pairs, invoices_in_place, movements_with_invoices
from ..operators.invoices import invoice_match, ledger_container
from ..operators.movements import normalise_movements
from ..operators.nearest import Splits, attach_nearest, nearest_billing, split_points
from ..schemas import ENRICHED_COLUMNS, MOVEMENT_COLUMNS
from ..operators.numbering import number_rows
from .. import session
from ..sources.tables import Sources


# Order of the published row numbers: dispatch time first, then every other column.
STORAGE_ORDER = ["dispatch_ts", "railway_from", "container_no", "shipment_no"]


def build_enriched(sources: Sources, railway: str | None = None, nearest_method: str = "scan",
                   invoice_method: str = "one_level", keep_blank_documents: bool = False,
                   normalise_container: bool = False, chunks: int | None = None,
                   number: bool = False, rest_whole: bool | None = None) -> DataFrame:
    """Every movement (optionally of one railway) with its invoice and nearest-billing blocks.

    One lazy plan; Catalyst prunes the columns each branch reads from the
    movement and ledger scans, and movements and lines are exchanged once, by container.  Containers that hold more than a chunk
    (two or more of the bounded sample's split points, see ``operators.nearest``) are built apart, by the parallel prefix scan.
    With another method, or ``chunks`` given, all rows go that way; ``rest_whole=True`` with ``chunks`` sends only the containers that
    these split there.  The only actions while
    planning are the count and the bounded sample of the two base tables that give the split points,
    and before a scan of tables beyond ``HEAVY_TABLE_ROWS`` rows the sketch of heavy pairs; numbered movements beyond
    ``session.STEP_ROWS`` rows are stored first.

    ``number=True`` prepends ``rownumber`` by ``STORAGE_ORDER`` and then all
    columns.  The movements are numbered *before* the joins: every added column
    is a function of (container, shipment, dispatch time), because both joined
    sides are unique on their keys, so ordering by the movement columns orders
    the enriched rows identically, and only the narrow movement rows go through
    the range shuffle (its sampling pass reads the movement scan, not the joins).
    """
    movements_n = normalise_movements(sources.movements, railway, normalise_container)
    return enrich_movements(movements_n, sources, nearest_method, invoice_method, keep_blank_documents, chunks, number, rest_whole)


def enrich_movements(movements_n: DataFrame, sources: Sources, nearest_method: str = "scan", invoice_method: str = "one_level",
                     keep_blank_documents: bool = False, chunks: int | None = None, number: bool = False,
                     rest_whole: bool | None = None) -> DataFrame:
    """``build_enriched`` of movements that are normalised already; of ``sources`` only the ledger and the dimensions are read."""
    splits = split_points(movements_n, sources.ledger, chunks) if nearest_method == "scan" else None
    left = movements_n
    if number:
        left = number_rows(movements_n, order=STORAGE_ORDER, partitions=splits.partitions if splits else None,
                           stored=movements_n.count() > session.STEP_ROWS)
    options = (invoice_method, keep_blank_documents)
    rest_whole = chunks is None if rest_whole is None else rest_whole
    if nearest_method != "scan" or not rest_whole or options != ("one_level", False):
        return _enrich_split(left, movements_n, sources, nearest_method, *options, splits)
    # A container with one point of the default splits is less than two chunks; at most one container for each point.
    hot = sorted(c for c, points in splits.points.items() if len(points) > 1 or chunks is not None)
    known = F.col("container_no").isNotNull()
    cool = known & ~F.col("container_no").isin(hot) if hot else known
    out = _enrich_whole(left.filter(cool), sources, cool, splits.partitions)
    if not hot:
        return out.unionByName(_without_container(left.filter(~known), out))
    of_hot = replace(sources, ledger=sources.ledger.filter(ledger_container(sources.ledger).isin(hot)))
    apart, keys = (t.filter(~known | F.col("container_no").isin(hot)) for t in (left, movements_n))
    points = Splits({c: splits.points[c] for c in hot}, splits.partitions)
    return out.unionByName(_enrich_split(apart, keys, of_hot, nearest_method, *options, points))


def _enrich_whole(left: DataFrame, sources: Sources, wanted: Column, partitions: int) -> DataFrame:
    """Blocks of movements whose containers are small enough to be one window each.

    The movements, the invoices' lines and the events' lines (``wanted``: of these containers) are exchanged once each, by
    container; grouping, pair window and time window all begin with the container and work where the rows then lie.
    """
    def placed(rows: DataFrame) -> DataFrame:
        # Under a name of its own, read again under its own name, the partitioning outlives the unions (as in ``plans.buckets``).
        rows = rows.filter(wanted).withColumnRenamed("container_no", "container").repartition(partitions, "container")
        return rows.withColumnRenamed("container", "container_no")

    ledger = placed(sources.ledger.withColumn("container_no", ledger_container(sources.ledger)))
    movements_n = placed(left)
    invoices = invoice_match(ledger, movements_n, only_shipped=False)
    events = billing_events(sources, movements_n, only_moved=False, place=placed)
    out = attach_nearest(events, invoices_in_place(movements_n, invoices), "window")
    return out.select(*[c for c in left.columns if c not in MOVEMENT_COLUMNS], *ENRICHED_COLUMNS)


def _without_container(rows: DataFrame, like: DataFrame) -> DataFrame:
    """Movements without a container meet no invoice and no event."""
    return rows.select(*[F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast(like.schema[c].dataType).alias(c) for c in like.columns])


def _enrich_split(left: DataFrame, movements_n: DataFrame, sources: Sources, nearest_method: str, invoice_method: str,
                  keep_blank_documents: bool, splits: Splits | None) -> DataFrame:
    """Blocks of movements of which single containers may hold any share: pairs are joined, containers cut into chunks."""
    # The left joins below ignore invoices and events of other containers, so neither
    # side is tested against the movements first.
    invoices = invoice_match(sources.ledger, movements_n, keep_blank_documents, invoice_method, only_shipped=False)
    events = billing_events(sources, movements_n, only_moved=False)
    extra = [c for c in left.columns if c not in movements_n.columns]
    if nearest_method == "join":
        return enrich(left, invoices, nearest_billing(events, movements_n, "join"))
    # The nearest blocks are attached to the (movement + invoice) rows in the
    # scan itself: no second join of the wide rows.  A movement without a container
    # is set aside before the joins (a cheap filter), so NULL never becomes a join or
    # window key.
    has_container = F.col("container_no").isNotNull()
    moved = movements_with_invoices(left.filter(has_container), invoices, heavy_pairs(movements_n), splits.partitions if splits else None)
    out = attach_nearest(events, moved, nearest_method, splits).select(*extra, *ENRICHED_COLUMNS)
    return out.unionByName(_without_container(left.filter(~has_container), out))
