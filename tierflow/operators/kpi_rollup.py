"""Delay figures that can be merged: short windows are stored, longer ones made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.numbers import round_to

SKETCH_SIZE = 200  # values a quantile sketch keeps per level; up to so many it is exact

SUMS = ["total_events", "delayed_events", "delay_total", "delays_known", "breaches"]


def _windows(time: str, window: str) -> list[Column]:
    return [F.window(time, window).alias("w"), F.col("carrier_code")]


def _bounds(df: DataFrame) -> DataFrame:
    return df.select("carrier_code", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                     *SUMS, "delay_sketch")


def carrier_sketches(silver: DataFrame, window: str = "5 minutes", size: int = SKETCH_SIZE,
                     watermark: str | None = "10 minutes") -> DataFrame:
    """Sums and a quantile sketch of delays per carrier and window, for batches and streams.

    All columns can be merged without going back to events: sums add up, and sketches
    are merged with the error bound of one sketch over all values. Events without a
    delay count as events only.
    """
    delay = F.col("delay_minutes")
    source = silver.withWatermark("event_ts", watermark) if silver.isStreaming and watermark else silver
    return _bounds(source.groupBy(*_windows("event_ts", window)).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.sum(F.when(delay > 0, 1).otherwise(0)).alias("delayed_events"),
        F.sum(delay).alias("delay_total"), F.count(delay).alias("delays_known"),
        F.sum(F.col("sla_breached").cast("int")).alias("breaches"),
        F.kll_sketch_agg_bigint(delay.cast("bigint"), size).alias("delay_sketch")))


def merge_sketches(sketches: DataFrame, window: str = "1 hour", size: int = SKETCH_SIZE) -> DataFrame:
    """The same columns over longer windows; each must hold whole windows of the input."""
    return _bounds(sketches.groupBy(*_windows("window_start", window)).agg(
        *[F.sum(c).alias(c) for c in SUMS], F.kll_merge_agg_bigint("delay_sketch", size).alias("delay_sketch")))


def kpis_of_sketches(sketches: DataFrame, rank: float = 0.95) -> DataFrame:
    """The columns of the carrier figures; quantiles are NULL where no delay is known."""
    quantile = F.when(F.col("delays_known") > 0, F.kll_sketch_get_quantile_bigint("delay_sketch", F.lit(rank)))
    return sketches.select(
        "carrier_code", "window_start", "window_end", "total_events", "delayed_events",
        round_to(F.try_divide("delay_total", "delays_known"), 1).alias("avg_delay_minutes"),
        round_to(F.try_divide("breaches", "total_events"), 3).alias("sla_breach_rate"),
        quantile.cast("int").alias("p95_delay_minutes"))
