"""The shipment product as chained streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tierflow.operators.shipments import (EVENT_KEY, active_alerts, carrier_kpis, enrich,
                                          parse_envelope)
from tierflow.schemas import CARRIER_UPDATE, SHIPMENT, WAREHOUSE_OP
from tierflow.session import make_folder
from tierflow.streaming.sink import AVAILABLE_NOW, stream_sink

# How long a repeat of an event is still recognised.
DEDUP_HORIZON = "7 days"
# Slices over which copies of one message are spread.
SLICES = 256


def bronze_streams(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Parsed events per topic (shipments, carriers, warehouses)."""
    return {
        "shipments": parse_envelope(sources["shipments"], SHIPMENT, ("partition", "offset")),
        "carriers": parse_envelope(sources["carriers"], CARRIER_UPDATE),
        "warehouses": parse_envelope(sources["warehouses"], WAREHOUSE_OP),
    }


def stream_dedup(df: DataFrame, keys: list[str], event_time: str,
                 horizon: str = DEDUP_HORIZON, spread_by: str | None = None) -> DataFrame:
    """Drop repeats across batches. If the keys include the event time, state
    older than the horizon is released; otherwise repeats are dropped within it.

    A stream cannot combine repeats before its shuffle, so one message sent
    very often would end up in one task. ``spread_by`` names a whole-number
    column that differs between such copies (the offset): a first pass then
    removes repeats within 256 slices of it, and the second one only sees one
    copy per slice.
    """
    df = df.withWatermark(event_time, horizon)

    def once(stream: DataFrame, columns: list[str]) -> DataFrame:
        return stream.dropDuplicates(columns) if event_time in columns \
            else stream.dropDuplicatesWithinWatermark(columns)

    if spread_by:
        sliced = df.withColumn("_slice", F.pmod(F.col(spread_by), F.lit(SLICES)))
        df = once(sliced, [*keys, "_slice"]).drop("_slice")
    return once(df, keys)


def silver_stream(bronze: DataFrame, horizon: str = DEDUP_HORIZON,
                  hours: dict[str, int] | None = None, strict_nulls: bool = False) -> DataFrame:
    """Clean events as a stream."""
    return (stream_dedup(enrich(bronze, hours, strict_nulls), EVENT_KEY, "event_ts", horizon,
                         spread_by="offset")
            .withColumn("processed_at", F.current_timestamp()))


def read_table_stream(spark: SparkSession, path: str, like: DataFrame,
                      max_files: int | None = None, fmt: str = "parquet") -> DataFrame:
    """New rows of a table another stream writes."""
    reader = spark.readStream.schema(like.schema).format(fmt)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def run_stream_medallion(spark: SparkSession, sources: dict[str, DataFrame], base: str,
                         checkpoints: str, trigger: int | str = 60,
                         horizon: str = DEDUP_HORIZON, window: str = "5 minutes",
                         watermark: str = "10 minutes", hours: dict[str, int] | None = None,
                         partitions: int | None = None) -> dict[str, StreamingQuery]:
    """Six queries: three raw tables, clean shipments, carrier figures, alerts.

    Each step reads the table of the step before, so an event is parsed and
    de-duplicated once. With ``AVAILABLE_NOW`` the steps run one after the
    other to their end; otherwise all six run until they are stopped.
    """
    queries: dict[str, StreamingQuery] = {}

    def start(steps: dict[str, DataFrame]) -> None:
        for name, df in steps.items():
            queries[name] = stream_sink(df, f"{base}/{name}", f"{checkpoints}/{name}",
                                        trigger=trigger, partitions=partitions)
        if trigger == AVAILABLE_NOW:
            for name in steps:
                queries[name].awaitTermination()

    bronze = bronze_streams(sources)
    for name in ("bronze/shipments", "silver/shipments"):
        make_folder(spark, f"{base}/{name}")  # readers may start before the first file
    start({f"bronze/{name}": df for name, df in bronze.items()})
    silver = silver_stream(
        read_table_stream(spark, f"{base}/bronze/shipments", bronze["shipments"]), horizon, hours)
    start({"silver/shipments": silver})
    events = read_table_stream(spark, f"{base}/silver/shipments", silver)
    start({"gold/carrier_kpis": carrier_kpis(events, window, watermark),
           "gold/alerts": active_alerts(events)})
    return queries
