"""Look-ups over the ready shipment tables."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.schemas import ALERT, CARRIER_KPI
from tierflow.sources.layers import read_or_empty


def serve_shape(df: DataFrame) -> DataFrame:
    """Rows as a consumer gets them: no NULL numbers, texts or flags, and times
    as text."""
    shaped = []
    for f in df.schema.fields:
        column = F.col(f.name)
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            column = column.cast("string")
        elif f.dataType.typeName() == "boolean":
            column = F.coalesce(column, F.lit(False))
        elif f.dataType.typeName() == "string":
            column = F.coalesce(column, F.lit(""))
        else:
            column = F.coalesce(column, F.lit(0).cast(f.dataType))
        shaped.append(column.alias(f.name))
    return df.select(*shaped)


def newest_alerts(alerts: DataFrame, carrier: str | None = None, severity: str | None = None,
                  limit: int = 50, newest_by: str = "alert_generated_at") -> DataFrame:
    """Newest alerts first, at most ``limit`` (1..500)."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be within 1..500")
    if carrier:
        alerts = alerts.filter(F.col("carrier_code") == carrier.upper())
    if severity:
        alerts = alerts.filter(F.col("delay_severity") == severity.upper())
    order = [F.desc_nulls_last(newest_by), F.asc_nulls_last("shipment_id"),
             F.desc_nulls_last("event_ts")]
    return serve_shape(alerts.orderBy(*order).limit(limit))


def fetch_alerts(spark: SparkSession, path: str, carrier: str | None = None,
                 severity: str | None = None, limit: int = 50) -> DataFrame:
    """Newest alerts of a stored table; no table gives no rows."""
    return newest_alerts(read_or_empty(spark, path, ALERT), carrier, severity, limit)


def recent_kpis(kpis: DataFrame, carrier: str | None = None, minutes: int = 60,
                as_of: datetime | None = None) -> DataFrame:
    """Windows that started in the last ``minutes`` (5..1440), newest first.

    The cut-off is a typed literal, so it reaches the Parquet scan.
    """
    if not 5 <= minutes <= 1440:
        raise ValueError("minutes must be within 5..1440")
    now = as_of or datetime.now(timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=timezone.utc)
    kpis = kpis.filter(F.col("window_start") >= F.lit(now - timedelta(minutes=minutes)))
    if carrier:
        kpis = kpis.filter(F.col("carrier_code") == carrier.upper())
    shaped = kpis.withColumn("p95_delay_minutes", F.col("p95_delay_minutes").cast("double"))
    return serve_shape(shaped.orderBy(F.desc_nulls_last("window_start"), F.asc("carrier_code")))


def fetch_carrier_kpis(spark: SparkSession, path: str, carrier: str | None = None,
                       minutes: int = 60, as_of: datetime | None = None) -> DataFrame:
    """Recent windows of a stored table; no table gives no rows."""
    return recent_kpis(read_or_empty(spark, path, CARRIER_KPI), carrier, minutes, as_of)
