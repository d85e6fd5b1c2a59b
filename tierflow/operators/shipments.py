"""Shipment tables: raw events, clean events, carrier figures, alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions.numbers import round_to
from tierflow.functions.shipment_rules import geo_region, severity, sla_minutes
from tierflow.functions.times import parse_timestamps
from tierflow.operators.quality import dedup, require_key
from tierflow.schemas import ALERT_COLUMNS, CORRUPT

EVENT_KEY = ["shipment_id", "event_ts"]


def parse_envelope(raw: DataFrame, schema: T.StructType, keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed fields of the JSON in ``value``, for batches and streams.

    Text that does not fit stays in ``_corrupt_record``. ``keep`` names the
    envelope columns to carry besides the arrival time. Unpacking by a generator
    instead of a projection keeps later filters on the fields above the parser,
    where they would otherwise parse each message a second time.
    """
    with_text = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col("value").cast("string"), with_text,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (raw.select(F.inline(F.array(parsed)), F.col("timestamp").alias("kafka_ts"), *keep)
            .withColumn("ingested_at", F.current_timestamp()))


def enrich(bronze: DataFrame, hours: dict[str, int] | None = None,
           strict_nulls: bool = False) -> DataFrame:
    """Clean events, still with repeats: key check, times, breach, class, region."""
    delay = F.col("delay_minutes")
    typed = parse_timestamps(require_key(bronze, "shipment_id"), ["event_ts", "promised_eta"])
    return (typed.drop(CORRUPT)
            .withColumn("sla_minutes", sla_minutes(F.col("service_type"), hours))
            .withColumns({
                "sla_breached": delay > F.col("sla_minutes"),
                "delay_severity": severity(delay, strict_nulls),
                "geo_region": geo_region(F.col("longitude"))}))


def silver_shipments(bronze: DataFrame, hours: dict[str, int] | None = None,
                     strict_nulls: bool = False) -> DataFrame:
    """Clean events, one per (shipment, time): the one that arrived first."""
    arrival = [c for c in ("kafka_ts", "partition", "offset") if c in bronze.columns]
    return (dedup(enrich(bronze, hours, strict_nulls), EVENT_KEY, arrival)
            .withColumn("processed_at", F.current_timestamp()))


def _p95(delay: str, accuracy: int | None) -> Column:
    """Exact by default: the state per group is bounded by the number of
    different whole-minute delays. An accuracy asks for the sketch instead."""
    if accuracy:
        return F.percentile_approx(delay, 0.95, accuracy)
    return F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY {delay})")


def carrier_kpis(silver: DataFrame, window: str = "5 minutes",
                 watermark: str | None = "10 minutes",
                 p95_accuracy: int | None = None) -> DataFrame:
    """Delay figures per carrier and tumbling event-time window.

    A stream that comes out of another stateful step keeps the watermark of
    that step: pass None.
    """
    late = F.sum(F.when(F.col("delay_minutes") > 0, 1).otherwise(0))
    breached = F.sum(F.col("sla_breached").cast("int"))
    source = silver.withWatermark("event_ts", watermark) if silver.isStreaming and watermark \
        else silver
    return (source.groupBy(F.window("event_ts", window).alias("w"), "carrier_code")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 late.alias("delayed_events"),
                 F.avg("delay_minutes").alias("delay"),
                 F.try_divide(breached, F.count(F.lit(1))).alias("rate"),
                 _p95("delay_minutes", p95_accuracy).alias("p95"))
            .select("carrier_code", F.col("w.start").alias("window_start"),
                    F.col("w.end").alias("window_end"), "total_events", "delayed_events",
                    round_to(F.col("delay"), 1).alias("avg_delay_minutes"),
                    round_to(F.col("rate"), 3).alias("sla_breach_rate"),
                    F.round("p95", 0).cast("int").alias("p95_delay_minutes")))


def active_alerts(silver: DataFrame) -> DataFrame:
    """Exceptions, HIGH delays and breaches."""
    urgent = ((F.col("event_type") == "EXCEPTION") | (F.col("delay_severity") == "HIGH")
              | F.col("sla_breached"))
    return (silver.filter(urgent).select(*ALERT_COLUMNS)
            .withColumn("alert_generated_at", F.current_timestamp()))


def alert_summary(alerts: DataFrame, *by: str) -> DataFrame:
    """Number of alerts, in all or by the given columns."""
    return alerts.groupBy(*by).agg(F.count(F.lit(1)).alias("alert_count"))
