from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import BASE_EVENT
from tierflow.operators.shipments import carrier_kpis, parse_envelope, silver_shipments
from tierflow.schemas import CARRIER_UPDATE, SHIPMENT
from tierflow.sources.envelopes import envelope_stream, kafka_options
from tierflow.streaming.shipments import (read_table_stream, run_stream_medallion, silver_stream,
                                          stream_dedup)
from tierflow.streaming.sink import (AVAILABLE_NOW, read_newest_version, stream_metrics,
                                     stream_sink)

FAR_FUTURE = "2030-01-01T00:00:00"


def test_kafka_options():
    assert kafka_options("host:9092", "shipment-events", 500) == {
        "kafka.bootstrap.servers": "host:9092", "subscribe": "shipment-events",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": "500", "failOnDataLoss": "false"}


@pytest.fixture
def send(spark, events, tmp_path):
    """Append messages with the given event times (or changes) to the topic."""
    sent = []

    def build(*changes):
        changes = [c if isinstance(c, dict) else {"shipment_id": f"s{len(sent) + i}", "event_ts": c}
                   for i, c in enumerate(changes)]
        sent.extend(changes)
        message = F.to_json(F.struct(*[F.col(f) for f in SHIPMENT.fieldNames()]))
        (events(*changes).select(
            message.alias("value"), F.lit(datetime(2024, 1, 1)).alias("timestamp"),
            F.lit(0).alias("partition"), F.monotonically_increasing_id().alias("offset"))
         .coalesce(1).write.mode("append").parquet(str(tmp_path / "topic")))
        return envelope_stream(spark, str(tmp_path / "topic"), max_files=1)

    return build


def silver_of(stream):
    return silver_stream(parse_envelope(stream, SHIPMENT, ("partition", "offset")))


def run(df, tmp_path, mode="append"):
    query = stream_sink(df, str(tmp_path / "out"), str(tmp_path / "checkpoint"), mode,
                        AVAILABLE_NOW, partitions=2)
    query.awaitTermination()
    return query


def test_late_events_are_dropped_and_counted(spark, send, tmp_path):
    """Times 00:01, 00:30; then 00:02 (late) and 00:25 (in time); then far ahead."""
    for times in (("2024-01-01T00:01:00", "2024-01-01T00:30:00"),
                  ("2024-01-01T00:02:00", "2024-01-01T00:25:00"), (FAR_FUTURE,)):
        stream = send(*times)
        events = parse_envelope(stream, SHIPMENT).withColumn(
            "event_ts", F.col("event_ts").cast("timestamp")).withColumn(
            "sla_breached", F.lit(False))
        metrics = stream_metrics(run(carrier_kpis(events), tmp_path))
        if times[0].endswith("00:02:00"):
            assert metrics["dropped_late"] == 1
    windows = {r.w: r.total_events for r in spark.read.parquet(str(tmp_path / "out")).selectExpr(
        "date_format(window_start, 'HH:mm') AS w", "total_events").collect()}
    assert windows == {"00:00": 1, "00:25": 1, "00:30": 1}


def test_repeats_are_dropped_across_restarts_and_state_is_released(spark, send, tmp_path):
    repeat = {"shipment_id": "x", "event_ts": "2024-01-01T00:00:00"}
    run(silver_of(send(repeat, repeat)), tmp_path)
    run(silver_of(send(repeat, {**repeat, "event_ts": "2024-01-02T00:00:00"})), tmp_path)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    query = run(silver_of(send({**repeat, "event_ts": FAR_FUTURE})), tmp_path)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert stream_metrics(query)["state_rows"] == 2  # the new event, once per pass


def test_dedup_without_event_time_in_the_key(spark, send, tmp_path):
    bronze = parse_envelope(send(
        {"shipment_id": "a", "event_ts": "2024-01-01T00:00:00"},
        {"shipment_id": "a", "event_ts": "2024-01-01T00:00:05"},
        {"shipment_id": "b", "event_ts": "2024-01-01T00:00:09"}), SHIPMENT)
    typed = bronze.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
    run(stream_dedup(typed, ["shipment_id"], "event_ts", "1 hour"), tmp_path)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_chained_stateful_steps_in_one_query(spark, send, tmp_path):
    event = {"shipment_id": "a", "event_ts": "2024-01-01T00:00:00", "delay_minutes": 5}
    stream = send(event, event, {**event, "shipment_id": "b"}, {"event_ts": FAR_FUTURE})
    silver = silver_stream(parse_envelope(stream, SHIPMENT, ("partition", "offset")), "1 hour")
    run(carrier_kpis(silver, watermark=None), tmp_path)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [r.total_events for r in rows] == [2]


def test_complete_mode_keeps_the_newest_result(spark, send, tmp_path):
    def counts(stream):
        return parse_envelope(stream, SHIPMENT).groupBy("carrier_code").count()

    run(counts(send("2024-01-01T00:00:00", "2024-01-01T00:01:00")), tmp_path, "complete")
    run(counts(send("2024-01-01T00:02:00")), tmp_path, "complete")
    newest = read_newest_version(spark, str(tmp_path / "out"))
    assert [(r.carrier_code, r["count"]) for r in newest.collect()] == [("FEDEX", 3)]


def test_six_queries_together(spark, send, tmp_path):
    """Running streams give what the batch operators give."""
    times = [f"2024-01-01T00:{m:02d}:00" for m in range(0, 40, 3)]
    late = [{"shipment_id": f"h{m}", "event_ts": t, "delay_minutes": 4000}
            for m, t in enumerate(times)]
    shipments = send(*times, *late, *late)
    other = str(tmp_path / "carriers")
    (spark.createDataFrame([('{"carrier_code":"UPS","active_shipments":3}', datetime(2024, 1, 1),
                             0, 0)], "value string, timestamp timestamp, partition int, offset bigint")
     .write.parquet(other))
    sources = {"shipments": shipments, "carriers": envelope_stream(spark, other),
               "warehouses": envelope_stream(spark, other)}
    base = str(tmp_path / "tables")
    queries = run_stream_medallion(spark, sources, base, str(tmp_path / "cp"), trigger=1,
                                   partitions=2)
    try:
        assert len(queries) == 6
        # Three hand-overs: each step sees the rows its predecessor has written.
        for name in ("bronze/shipments", "bronze/carriers", "bronze/warehouses",
                     "silver/shipments", "gold/alerts", "gold/carrier_kpis"):
            queries[name].processAllAvailable()
        assert all(q.isActive for q in queries.values())
    finally:
        for query in queries.values():
            query.stop()
    expected = silver_shipments(spark.read.parquet(f"{base}/bronze/shipments"))
    silver = spark.read.parquet(f"{base}/silver/shipments")
    keys = ["shipment_id", "event_ts", "delay_severity"]
    assert sorted(silver.select(*keys).collect()) == sorted(expected.select(*keys).collect())
    assert spark.read.parquet(f"{base}/gold/alerts").count() == len(late)
    closed = spark.read.parquet(f"{base}/gold/carrier_kpis")
    batch = {r.window_start: r for r in carrier_kpis(expected).collect()}
    rows = closed.collect()
    assert rows and all(batch[r.window_start] == r for r in rows)
    assert spark.read.parquet(f"{base}/bronze/carriers").first().active_shipments == 3


def test_table_stream_reads_only_new_rows(spark, frame, tmp_path):
    rows = frame("a int", (1,), (2,))
    rows.write.parquet(str(tmp_path / "in"))
    for expected in (2, 4):
        run(read_table_stream(spark, str(tmp_path / "in"), rows), tmp_path)
        assert spark.read.parquet(str(tmp_path / "out")).count() == expected
        rows.write.mode("append").parquet(str(tmp_path / "in"))


def test_carrier_fields(frame):
    raw = frame("value string, timestamp timestamp",
                ('{"carrier_code":"DHL","on_time_rate":0.9,"report_ts":"t"}', datetime(2024, 1, 1)))
    row = parse_envelope(raw, CARRIER_UPDATE).first()
    assert (row.carrier_code, row.on_time_rate, row.region) == ("DHL", 0.9, None)
    assert BASE_EVENT["carrier_code"] == "FEDEX"
