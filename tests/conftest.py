"""One session for all tests; fixtures always carry a schema."""

import pytest
from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T

from tierflow.schemas import SHIPMENT
from tierflow.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    session = build_session("tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


BASE_EVENT = {
    "shipment_id": "SHP-TEST001", "event_type": "IN_TRANSIT", "carrier_code": "FEDEX",
    "service_type": "STANDARD", "origin_wh": "WH-LAX", "dest_city": "Chicago",
    "dest_country": "US", "weight_kg": 5.0, "promised_eta": "2024-01-03T00:00:00",
    "event_ts": "2024-01-01T00:00:00", "latitude": 34.05, "longitude": -118.24,
    "delay_minutes": 0, "notes": "",
}


@pytest.fixture(scope="session")
def events(spark):
    """Raw events from per-row changes of the base event."""
    def build(*changes: dict):
        rows = [Row(**{**BASE_EVENT, **change}) for change in changes]
        return spark.createDataFrame([tuple(r[f] for f in SHIPMENT.fieldNames()) for r in rows],
                                     SHIPMENT)

    return build


@pytest.fixture(scope="session")
def frame(spark):
    """A table from rows and a schema text."""
    def build(schema: str, *rows: tuple):
        return spark.createDataFrame(list(rows), T._parse_datatype_string(schema))

    return build
