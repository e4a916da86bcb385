from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from revaudit.session import build_session  # noqa: E402
from revaudit.sources.tables import Sources  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="revaudit-tests-")
    session = build_session("local[4]", app_name="revaudit-tests", shuffle_partitions=8,
                            extra={"spark.checkpoint.dir": os.path.join(scratch, "checkpoints"),
                                   "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="revaudit-run-")


MOVEMENT_SCHEMA = (
    "station_from_name string, railway_from_name string, station_to_name string, railway_to_name string, "
    "vehicle_number string, container_number string, container_foot string, shipment_document__number string, "
    "goods_etsng string, operation_datetime timestamp_ntz, datetime_move_started timestamp_ntz, "
    "ownerships string, Owner_ev string, ownerships_new string, ownerships_short string, ownerships_type string, "
    "wagon_owner string, container_owner string, wagon_owner_new string")

LEDGER_SCHEMA = (
    "document_reasons_number string, service_details_order_id bigint, service_details_container_number string, "
    "esu_id string, date_end timestamp_ntz, amount_in_rub_without_vat decimal(18,2), "
    "amount_in_contract_currency_without_vat decimal(18,2), client_number_id bigint, "
    "service_details_points_from_catalog_id bigint, service_details_points_to_catalog_id bigint, "
    "service_details_points_from_station_id bigint, service_details_points_to_station_id bigint")


def ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def movement(container="C1", when="2020-01-10 00:00:00", shipment="S1", railway='"R1"', station='"ST1"',
             wagon="W1", **extra):
    row = dict(station_from_name=station, railway_from_name=railway, station_to_name="TO",
               railway_to_name="RT", vehicle_number=wagon, container_number=container, container_foot="40",
               shipment_document__number=shipment, goods_etsng="goods",
               operation_datetime=ts(when) if when else None, datetime_move_started=ts(when) if when else None,
               ownerships="o1", Owner_ev="o2", ownerships_new="o3", ownerships_short="o4",
               ownerships_type="o5", wagon_owner="o6", container_owner="o7", wagon_owner_new="o8")
    row.update(extra)
    return row


def line(container="C1", doc="S1", code="0.01.01.01", when="2020-01-05 00:00:00", rub="10.00", cur="1.00",
         order=1, client=1, p_from=1, p_to=2, st_from=1, st_to=2):
    return dict(document_reasons_number=doc, service_details_order_id=order,
                service_details_container_number=container, esu_id=code,
                date_end=ts(when) if when else None,
                amount_in_rub_without_vat=None if rub is None else Decimal(rub),
                amount_in_contract_currency_without_vat=None if cur is None else Decimal(cur),
                client_number_id=client, service_details_points_from_catalog_id=p_from,
                service_details_points_to_catalog_id=p_to, service_details_points_from_station_id=st_from,
                service_details_points_to_station_id=st_to)


def make_sources(spark, movements, ledger, counterparty=None, service=None, location=None, stations=None):
    counterparty = counterparty if counterparty is not None else [(1, "client-1"), (2, "client-2")]
    service = service if service is not None else [("0.01.01.01", "wagon"), ("0.01.01.02", "container"),
                                                   ("2.01.01.01", "forwarding"), ("0.02.01.01", "guard")]
    location = location if location is not None else [(1, "loc-1"), (2, "loc-2")]
    stations = stations if stations is not None else [(1, "st-1"), (2, "st-2")]
    cols_m = [c.split()[0] for c in MOVEMENT_SCHEMA.split(", ")]
    cols_l = [c.split()[0] for c in LEDGER_SCHEMA.split(", ")]
    return Sources(
        movements=spark.createDataFrame([tuple(r[c] for c in cols_m) for r in movements], MOVEMENT_SCHEMA),
        ledger=spark.createDataFrame([tuple(r[c] for c in cols_l) for r in ledger], LEDGER_SCHEMA),
        dict_counterparty=spark.createDataFrame(counterparty, "id bigint, name string"),
        dict_service=spark.createDataFrame(service, "id string, name string"),
        dict_location=spark.createDataFrame(location, "id bigint, name string"),
        dict_stations=spark.createDataFrame(stations, "station_code bigint, station_name string"),
    )


def rows(df, *cols):
    """Rows as sorted tuples of the given (or all) columns."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))
