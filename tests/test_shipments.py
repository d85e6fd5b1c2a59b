from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE_EVENT
from tierflow.functions.shipment_rules import geo_region, severity
from tierflow.operators.quality import dedup, split_corrupt
from tierflow.operators.serving import (fetch_alerts, fetch_carrier_kpis, newest_alerts,
                                        recent_kpis)
from tierflow.operators.shipments import (active_alerts, alert_summary, carrier_kpis,
                                          parse_envelope, silver_shipments)
from tierflow.schemas import CORRUPT, SHIPMENT


def test_no_delay_is_neither_breach_nor_severity(events):
    row = silver_shipments(events({})).first()
    assert (row.sla_breached, row.delay_severity) == (False, "NONE")


@pytest.mark.parametrize("tier, delay, breached", [
    ("STANDARD", 3000, True), ("EXPRESS", 1500, True), ("OVERNIGHT", 720, False),
    ("OVERNIGHT", 721, True), ("EXPRESS", 1440, False), ("EXPRESS", 1441, True),
    ("STANDARD", 2880, False), ("STANDARD", 2881, True), ("PIGEON", 2880, False),
    (None, 2881, True), ("STANDARD", None, None)])
def test_breach_limits(events, tier, delay, breached):
    row = silver_shipments(events({"service_type": tier, "delay_minutes": delay})).first()
    assert row.sla_breached is breached


def test_breach_limits_can_be_changed(events):
    event = events({"service_type": "EXPRESS", "delay_minutes": 90})
    assert silver_shipments(event, {"EXPRESS": 1}).first().sla_breached is True


def test_severity_borders(frame):
    cases = {-1: "LOW", 0: "NONE", 59: "LOW", 60: "MEDIUM", 90: "MEDIUM", 239: "MEDIUM",
             240: "HIGH", 3000: "HIGH", None: "HIGH"}
    df = frame("d int", *[(d,) for d in cases])
    assert {r.d: r.s for r in df.select("d", severity(F.col("d")).alias("s")).collect()} == cases
    strict = df.select("d", severity(F.col("d"), True).alias("s")).filter("d IS NULL").first()
    assert strict.s == "UNKNOWN"


def test_region_borders(frame):
    cases = {-120.0: "West", -115.0: "Mountain", -100.0: "Central", -85.0: "East", -75.0: "East",
             None: "East"}
    df = frame("x double", *[(x,) for x in cases])
    assert {r.x: r.g for r in df.select("x", geo_region(F.col("x")).alias("g")).collect()} == cases


def test_repeats_and_missing_ids(events):
    assert silver_shipments(events({}, {})).count() == 1
    assert silver_shipments(events({"shipment_id": None})).count() == 0
    assert silver_shipments(events({"event_ts": "soon"}, {"event_ts": "later"})).count() == 1


def test_dedup_keeps_first_arrival(frame):
    df = frame("k int, offset int, v string", (1, 5, "late"), (1, 2, "first"), (None, 1, "x"),
               (None, 0, "y"))
    kept = {(r.k, r.v) for r in dedup(df, ["k"], ["offset"]).collect()}
    assert kept == {(1, "first"), (None, "y")}


def test_bad_times_become_null_and_offsets_are_read(events):
    rows = silver_shipments(events({"shipment_id": "a", "event_ts": "garbage"},
                                   {"shipment_id": "b", "event_ts": "2024-01-01T02:00:00+02:00"}))
    times = {r.shipment_id: r.t for r in rows.selectExpr(
        "shipment_id", "CAST(event_ts AS STRING) AS t").collect()}
    assert times == {"a": None, "b": "2024-01-01 00:00:00"}


def test_malformed_messages_are_kept_aside(frame):
    raw = frame("value string, timestamp timestamp, partition int, offset bigint",
                ('{"shipment_id":"S1","delay_minutes":3}', datetime(2024, 1, 1), 0, 1),
                ("not json", datetime(2024, 1, 1), 0, 2),
                ('{"shipment_id":"S3","delay_minutes":"xx"}', datetime(2024, 1, 1), 0, 3),
                (None, datetime(2024, 1, 1), 0, 4))
    for value in (F.col("value"), F.col("value").cast("binary")):
        parsed = parse_envelope(raw.withColumn("value", value), SHIPMENT, ("partition", "offset"))
        good, bad = split_corrupt(parsed)
        assert {r.offset for r in good.collect()} == {1, 4}
        assert {r[CORRUPT] for r in bad.collect()} == {
            "not json", '{"shipment_id":"S3","delay_minutes":"xx"}'}
        silver = {r.shipment_id: r.delay_minutes for r in silver_shipments(parsed).collect()}
        assert silver == {"S1": 3, "S3": None}


def test_alert_rule(events):
    def alerts(**change):
        return active_alerts(silver_shipments(events(change))).count()

    assert alerts(event_type="EXCEPTION") == 1
    assert alerts(delay_minutes=500) == 1
    assert alerts(delay_minutes=30) == 0
    assert alerts(delay_minutes=None) == 1  # an unknown delay counts as HIGH
    assert alerts(service_type="OVERNIGHT", delay_minutes=200) == 0


def test_alert_summary(events):
    alerts = active_alerts(silver_shipments(events(
        {"shipment_id": "a", "delay_minutes": 500}, {"shipment_id": "b", "delay_minutes": 600})))
    assert alert_summary(alerts).first().alert_count == 2
    assert alert_summary(alerts, "carrier_code").first().asDict() == {
        "carrier_code": "FEDEX", "alert_count": 2}


def test_kpi_values(events):
    changes = [{"shipment_id": str(i), "delay_minutes": d, "event_ts": "2024-01-01T00:04:59"}
               for i, d in enumerate([0, 0, 10, 3000, None])]
    row = carrier_kpis(silver_shipments(events(*changes))).first()
    assert row.total_events == 5 and row.delayed_events == 2
    assert row.avg_delay_minutes == 752.5
    assert row.sla_breach_rate == 0.2  # the unknown one counts as an event
    assert row.p95_delay_minutes == 3000
    assert (row.window_end - row.window_start).total_seconds() == 300
    approx = carrier_kpis(silver_shipments(events(*changes)), p95_accuracy=10000).first()
    assert approx.p95_delay_minutes == 3000


def test_kpi_of_unknown_delays_only(events):
    row = carrier_kpis(silver_shipments(events({"delay_minutes": None}))).first()
    assert (row.total_events, row.delayed_events) == (1, 0)
    assert row.avg_delay_minutes is None and row.sla_breach_rate is None
    assert row.p95_delay_minutes is None


def test_alert_lookup(events):
    changes = [{"shipment_id": f"s{i}", "delay_minutes": 300 + i, "notes": None,
                "event_ts": f"2024-01-01T00:00:{i:02d}"} for i in range(10)]
    alerts = active_alerts(silver_shipments(events(*changes, {"carrier_code": "UPS",
                                                              "event_type": "EXCEPTION"})))
    found = newest_alerts(alerts, "fedex", "high", 3, newest_by="event_ts").collect()
    assert [r.shipment_id for r in found] == ["s9", "s8", "s7"]
    assert found[0].notes == "" and isinstance(found[0].event_ts, str)
    assert newest_alerts(alerts, carrier="ups").count() == 1
    for limit in (0, 501):
        with pytest.raises(ValueError):
            newest_alerts(alerts, limit=limit)


def test_kpi_lookup(events):
    changes = [{"shipment_id": f"s{i}", "event_ts": f"2024-01-01T{i:02d}:00:00"} for i in range(6)]
    kpis = carrier_kpis(silver_shipments(events(*changes)))
    found = recent_kpis(kpis, "fedex", 120, as_of=datetime(2024, 1, 1, 5)).collect()
    assert [r.window_start for r in found] == [f"2024-01-01 0{h}:00:00" for h in (5, 4, 3)]
    assert recent_kpis(kpis, "dhl", 120, as_of=datetime(2024, 1, 1, 5)).count() == 0
    for minutes in (4, 1441):
        with pytest.raises(ValueError):
            recent_kpis(kpis, minutes=minutes)


def test_lookups_without_table_are_empty(spark, tmp_path):
    assert fetch_alerts(spark, str(tmp_path / "none")).count() == 0
    assert fetch_carrier_kpis(spark, str(tmp_path / "none")).count() == 0


def test_lookup_of_stored_table(spark, events, tmp_path):
    active_alerts(silver_shipments(events({"delay_minutes": 500}))).write.parquet(
        str(tmp_path / "alerts"))
    row = fetch_alerts(spark, str(tmp_path / "alerts"), severity="high").first()
    assert row.shipment_id == BASE_EVENT["shipment_id"] and row.alert_generated_at
