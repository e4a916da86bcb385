"""Movement normalisation: the dispatch rows every output row starts from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import null_to_blank, split_names, strip_quotes, upper_utf8


#: Spellings of one railway that become a list in the scan's filter; beyond, its stripped name is compared.
MAX_SPELLINGS = 1000


def railway_spellings(movements: DataFrame) -> DataFrame:
    """The dictionary of raw railway names: spelling (as stored), railway (stripped).  One column is read, combined map-side."""
    return (movements.select(F.col("railway_from_name").alias("spelling")).distinct()
            .select("spelling", strip_quotes("spelling").alias("railway")))


def of_railways(movements: DataFrame, railways: list[str | None]) -> DataFrame:
    """The raw movements of some railways (None: rows without one).

    The stored spellings of the names, looked up once, turn the test into an ``In`` on the stored column, which the Parquet scan
    checks against its row groups' statistics and dictionaries; a stripped name is an expression that it cannot check.
    """
    names = [r.replace('"', "") for r in railways if r is not None]
    raw = F.col("railway_from_name")
    found = [r["spelling"] for r in railway_spellings(movements).filter(F.col("railway").isin(names)).limit(MAX_SPELLINGS + 1).collect()]
    wanted = raw.isin(found) if len(found) <= MAX_SPELLINGS else strip_quotes("railway_from_name").isin(names)
    return movements.filter(wanted | raw.isNull() if None in railways else wanted)


def normalise_movements(movements: DataFrame, railway: str | None = None,
                        normalise_container: bool = False) -> DataFrame:
    """Rename to engine names, strip quotes from the origin names, NULL wagon -> ''.

    ``railway`` keeps one slice (quotes in the given name are ignored, as in the
    stored names; see ``of_railways``).  The container keeps its case unless ``normalise_container``:
    the ledger side is upper-cased, so a lower-case movement container never
    matches, exactly as in the audited job.
    """
    if railway is not None:
        movements = of_railways(movements, [railway])
    container: Column = F.col("container_number")
    if normalise_container:
        container = upper_utf8(container)
    return movements.select(
        strip_quotes("station_from_name").alias("station_from"),
        strip_quotes("railway_from_name").alias("railway_from"),
        F.col("station_to_name").alias("station_to"),
        F.col("railway_to_name").alias("railway_to"),
        null_to_blank("vehicle_number").alias("wagon_no"),
        container.alias("container_no"),
        F.col("container_foot").alias("container_type"),
        F.col("shipment_document__number").alias("shipment_no"),
        F.col("goods_etsng").alias("goods"),
        F.col("operation_datetime").alias("dispatch_ts"),
        "ownerships",
        F.col("Owner_ev").alias("owner_ev"),
        "ownerships_new", "ownerships_short", "ownerships_type",
        "wagon_owner", "container_owner", "wagon_owner_new",
    )


def railway_list(fingerprint_df: DataFrame) -> DataFrame:
    """Slices of a build: the fingerprint's ``|``-joined railway list, one row each."""
    return (fingerprint_df
            .select(F.posexplode(split_names("railway_names")).alias("pos", "railway"))
            .select((F.col("pos") + 1).cast("bigint").alias("slice_no"), "railway"))


def movement_keys(movements_n: DataFrame) -> DataFrame:
    """Distinct (container, dispatch time) of normalised movements; NULLs removed."""
    return (movements_n.select("container_no", "dispatch_ts")
            .filter(F.col("container_no").isNotNull() & F.col("dispatch_ts").isNotNull())
            .distinct())


def shipment_keys(movements_n: DataFrame) -> DataFrame:
    """Distinct (container, shipment document) of normalised movements."""
    return (movements_n.select("container_no", "shipment_no")
            .filter(F.col("container_no").isNotNull() & F.col("shipment_no").isNotNull())
            .distinct())


def containers(movements_n: DataFrame) -> DataFrame:
    """Distinct non-NULL containers of normalised movements."""
    return movements_n.select("container_no").filter(F.col("container_no").isNotNull()).distinct()
