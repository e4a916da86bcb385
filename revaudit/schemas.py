"""Column names, service codes and presentation labels.

The engine works with short ASCII snake_case names.  ``presentation_names``
(in ``operators.enrich``) maps them back to the labels of the audited
warehouse table.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must equal the audited warehouse job's for identical
# results (service codes, source column names, output labels, markers).
# ---------------------------------------------------------------------------

# Service codes whose amounts are pivoted into the invoice block, in column order.
INVOICE_CODES = ("0.01.01.01", "0.01.01.02", "0.01.01.04", "2.01.01.01")
# Service code whose rows carry the shipment document number (fallback source).
DOCUMENT_CODE = "0.02.01.01"
# Codes read for the invoice block; the nearest-billing events use INVOICE_CODES only.
INVOICE_FILTER_CODES = INVOICE_CODES + (DOCUMENT_CODE,)

# Source table: container movements (one row per dispatch).
MOVEMENT_SOURCE_COLUMNS = (
    "station_from_name", "railway_from_name", "station_to_name", "railway_to_name",
    "vehicle_number", "container_number", "container_foot", "shipment_document__number",
    "goods_etsng", "operation_datetime", "datetime_move_started",
    "ownerships", "Owner_ev", "ownerships_new", "ownerships_short", "ownerships_type",
    "wagon_owner", "container_owner", "wagon_owner_new",
)
# Source table: billing ledger (one row per billed service line).
LEDGER_SOURCE_COLUMNS = (
    "document_reasons_number", "service_details_order_id", "service_details_container_number",
    "esu_id", "date_end", "amount_in_rub_without_vat", "amount_in_contract_currency_without_vat",
    "client_number_id", "service_details_points_from_catalog_id",
    "service_details_points_to_catalog_id", "service_details_points_from_station_id",
    "service_details_points_to_station_id",
)

# Marker columns that separate the blocks of the presentation table.
MARKER_BEFORE = "BEFORE-->"
MARKER_BETWEEN = "<--BEFORE AFTER-->"
MARKER_AFTER = "<--AFTER"

# Presentation labels of the movement block, in output order (engine name, label).
MOVEMENT_LABELS = (
    ("station_from", "Ст. Отправления"),
    ("railway_from", "Дор. Отправления"),
    ("station_to", "Ст. Назначения"),
    ("railway_to", "Дор. Назначения"),
    ("wagon_no", "№ Вагона"),
    ("container_no", "Контейнер"),
    ("container_type", "Тип контейнера"),
    ("shipment_no", "Отправка"),
    ("goods", "Наименование груза"),
    ("dispatch_ts", "SVOD.Дата отправки"),
    ("ownerships", "ownerships"),
    ("owner_ev", "Owner_ev"),
    ("ownerships_new", "ownerships_new"),
    ("ownerships_short", "ownerships_short"),
    ("ownerships_type", "ownerships_type"),
    ("wagon_owner", "wagon_owner"),
    ("container_owner", "container_owner"),
    ("wagon_owner_new", "wagon_owner_new"),
)
# Presentation labels of the invoice-block keys.
INVOICE_KEY_LABELS = (
    ("invoice_document_no", "document_reasons_number_processed"),
    ("invoice_container_no", "container_number"),
)
# Label stems of the two amount measures (rub, contract currency).
RUB_LABEL = "amount_in_rub_without_vat_sum"
CUR_LABEL = "amount_in_contract_currency_without_vat_sum"
# Label suffixes of the nearest-billing block (engine field, label field).
NEAREST_LABELS = (
    ("date_diff", "date_diff"),
    ("order_id", "order_id"),
    ("container_no", "container_number"),
    ("client_name", "client_name"),
    ("points_from_name", "points_from_catalog_name"),
    ("points_to_name", "points_to_catalog_namer"),
    ("station_name_from", "station_name_from"),
    ("station_name_to", "station_name_to"),
    ("service_name", "service_name"),
    ("date_e", "Date_E"),
    ("rub_sum", RUB_LABEL),
    ("cur_sum", CUR_LABEL),
)

# ---------------------------------------------------------------------------
# Engine names derived from the fixed values above.
# ---------------------------------------------------------------------------

MOVEMENT_COLUMNS = tuple(name for name, _ in MOVEMENT_LABELS)


def code_suffix(code: str) -> str:
    """``'0.01.01.01'`` -> ``'0_01_01_01'`` (safe inside a column name)."""
    return code.replace(".", "_")


def rub_column(code: str) -> str:
    return f"rub_{code_suffix(code)}"


def cur_column(code: str) -> str:
    return f"cur_{code_suffix(code)}"


INVOICE_AMOUNT_COLUMNS = tuple(
    name for code in INVOICE_CODES for name in (rub_column(code), cur_column(code))
)
INVOICE_COLUMNS = ("invoice_document_no", "invoice_container_no") + INVOICE_AMOUNT_COLUMNS

# Billing event = ledger lines of one order, container, service and route, with names.
EVENT_NAME_COLUMNS = (
    "client_name", "points_from_name", "points_to_name",
    "station_name_from", "station_name_to", "service_name",
)
EVENT_COLUMNS = ("order_id", "container_no") + EVENT_NAME_COLUMNS + ("date_e", "rub_sum", "cur_sum")

NEAREST_FIELDS = tuple(field for field, _ in NEAREST_LABELS)
BEFORE_COLUMNS = tuple(f"before_{f}" for f in NEAREST_FIELDS)
AFTER_COLUMNS = tuple(f"after_{f}" for f in NEAREST_FIELDS)
NEAREST_COLUMNS = ("container_no", "dispatch_ts") + BEFORE_COLUMNS + AFTER_COLUMNS

ENRICHED_COLUMNS = MOVEMENT_COLUMNS + INVOICE_COLUMNS + BEFORE_COLUMNS + AFTER_COLUMNS

FINGERPRINT_FIELDS = ("rows_qty", "min_date", "max_date", "railway_names", "station_names")
