"""Input tables of the audit: movements, billing ledger and four dimensions."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schemas import LEDGER_SOURCE_COLUMNS, MOVEMENT_SOURCE_COLUMNS

SOURCE_TABLES = ("movements", "ledger", "dict_counterparty", "dict_service",
                 "dict_location", "dict_stations")


@dataclass(frozen=True)
class Sources:
    movements: DataFrame
    ledger: DataFrame
    dict_counterparty: DataFrame   # id, name
    dict_service: DataFrame        # id, name
    dict_location: DataFrame       # id, name
    dict_stations: DataFrame       # station_code, station_name
    # Measured bytes of the dimensions, when known for this immutable snapshot of
    # the inputs; None = measure when used.
    dim_bytes: dict[str, int] | None = field(default=None, compare=False)

    def as_dict(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in SOURCE_TABLES}


_TIME = (T.TimestampNTZType, T.TimestampType, T.DateType)
_AMOUNT = (T.DecimalType, T.IntegralType)   # exact; floating-point amounts are refused
_ID = (T.IntegralType, T.StringType)
_TEXT = (T.StringType,)
#: Types of the fact columns that are not text.
DECLARED = {
    "operation_datetime": _TIME, "datetime_move_started": _TIME, "date_end": _TIME,
    "amount_in_rub_without_vat": _AMOUNT, "amount_in_contract_currency_without_vat": _AMOUNT,
    "service_details_order_id": _ID, "client_number_id": _ID,
    "service_details_points_from_catalog_id": _ID, "service_details_points_to_catalog_id": _ID,
    "service_details_points_from_station_id": _ID, "service_details_points_to_station_id": _ID,
}
#: Each dimension's key and name, and the ledger columns that are looked up in it.
DIMENSIONS = {
    "dict_counterparty": ("id", "name", ("client_number_id",)),
    "dict_service": ("id", "name", ("esu_id",)),
    "dict_location": ("id", "name", ("service_details_points_from_catalog_id", "service_details_points_to_catalog_id")),
    "dict_stations": ("station_code", "station_name", ("service_details_points_from_station_id", "service_details_points_to_station_id")),
}


def schema_faults(sources: Sources) -> list[str]:
    """What keeps the tables from being audited: missing columns and columns of another type than declared.

    Only schemas are read.  A key that is text on one side and a number on the other is a fault as well: the join would
    cast each row.
    """
    faults = []

    def check(table: str, column: str, kinds: tuple) -> None:
        types = {f.name: f.dataType for f in getattr(sources, table).schema.fields}
        if column not in types:
            faults.append(f"{table} lacks {column}")
        elif not isinstance(types[column], kinds):
            faults.append(f"{table}.{column} is {types[column].simpleString()}")

    for table, columns in (("movements", MOVEMENT_SOURCE_COLUMNS), ("ledger", LEDGER_SOURCE_COLUMNS)):
        for column in columns:
            check(table, column, DECLARED.get(column, _TEXT))
    ledger = {f.name: f.dataType for f in sources.ledger.schema.fields}
    for table, (key, name, used_by) in DIMENSIONS.items():
        check(table, name, _TEXT)
        kinds = {T.StringType if isinstance(ledger[c], T.StringType) else T.IntegralType for c in used_by if c in ledger}
        check(table, key, tuple(kinds) if len(kinds) == 1 else _ID)
    return faults


def read_sources(spark: SparkSession, root: str) -> Sources:
    """Read the six input tables stored as Parquet folders ``<root>/<table>``.

    Their columns must be those of ``schemas`` with the declared types; every fault is named (``schema_faults``).
    """
    sources = Sources(**{name: spark.read.parquet(f"{root.rstrip('/')}/{name}") for name in SOURCE_TABLES})
    faults = schema_faults(sources)
    if faults:
        raise ValueError("; ".join(faults))
    return sources
