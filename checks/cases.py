"""Every registered query: the library's operators over the test tables.

Each case takes (spark, sf_dir) and runs over the whole tables.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.functions.times import parse_timestamps, to_utc_naive
from tierflow.operators import (customers, indicators, kpi_rollup, orders, quality, revenue, serving,
                                shipments)
from tierflow.operators.ranking import stored
from tierflow.plans import commerce, compaction, reports, upkeep
from tierflow.plans.indicators import run_indicators
from tierflow.schemas import CARRIER_UPDATE, CORRUPT, ORDER_TIMES, SHIPMENT, WAREHOUSE_OP
from tierflow.session import at_once, prepare, scratch_path
from tierflow.sinks import batch
from tierflow.sources import adapters
from tierflow.sources.csv import ingest_all, read_csv_bronze, read_csv_checked
from tierflow.sources.envelopes import envelope_stream
from tierflow.sources.layers import commerce_views, count_views, register_layer_views
from tierflow.sources.file_stats import Between, equal, read_matching, refresh_file_stats
from tierflow.sources.payloads import payload_stream
from tierflow.streaming import batches
from tierflow.streaming import shipments as streams
from tierflow.streaming.sink import (AVAILABLE_NOW, read_newest_version, stream_metrics,
                                     stream_sink)

Case = Callable[[SparkSession, str], DataFrame]
CASES: dict[str, Case] = {}

LINEAGE = ("_ingested_at", "_source_file")
SHOWN = [f"NATION_{i}" for i in range(8)]
CODE = "ORD.REV"


def case(build: Case) -> Case:
    """Register a query under its function name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return to_utc_naive(build(prepare(spark), sf_dir))

    CASES[build.__name__] = run
    return build


# --- domain tables -----------------------------------------------------------
def fact(spark, d):
    a = adapters
    return orders.orders_fact(a.orders(spark, d), a.order_items(spark, d), a.customers(spark, d),
                              a.order_payments(spark, d), a.products(spark, d),
                              a.category_translation(spark, d))


def raw_shipments(spark, d):
    return shipments.parse_envelope(adapters.shipment_envelopes(spark, d), SHIPMENT,
                                    ("partition", "offset"))


def silver(spark, d):
    return shipments.silver_shipments(raw_shipments(spark, d)).drop("ingested_at", "processed_at")


def facts(spark, d):
    return adapters.indicators(spark, d).filter(F.col("value").isNotNull())


def shown(spark, d):
    return indicators.slice_indicators(facts(spark, d), CODE, SHOWN, 1996, 2001)


def write_raw_csv(spark, d, names=tuple(adapters.COMMERCE)):
    """Raw CSV files of the commerce tables; returns (folder, schemas)."""
    folder = scratch_path(spark, "raw")
    frames = {name: adapters.COMMERCE[name](spark, d) for name in names}
    at_once(spark, {name: partial(batch.export_csv, df, f"{folder}/{name}.csv") for name, df in frames.items()})
    return folder, {name: df.schema for name, df in frames.items()}


# --- commerce ----------------------------------------------------------------
@case
def csv_bronze_roundtrip(spark, d):
    folder, kinds = write_raw_csv(spark, d, ["order_items"])
    return read_csv_bronze(spark, f"{folder}/order_items.csv", kinds["order_items"]).drop(*LINEAGE)


@case
def bronze_row_counts(spark, d):
    folder, kinds = write_raw_csv(spark, d)
    counts = ingest_all(spark, folder, scratch_path(spark, "bronze"), kinds)
    return spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


@case
def layer_view_counts(spark, d):
    folder, kinds = write_raw_csv(spark, d)
    base = scratch_path(spark, "commerce")
    commerce.run_commerce(spark, folder, base, kinds)
    made, _ = register_layer_views(spark, commerce_views(base))
    return count_views(spark, made)


@case
def order_timestamps(spark, d):
    return parse_timestamps(adapters.orders(spark, d), ORDER_TIMES).select("order_id", *ORDER_TIMES)


@case
def order_dates(spark, d):
    return orders.add_order_dates(adapters.orders(spark, d)).select(
        "order_id", "delivery_days", "is_late", "purchase_year", "purchase_month",
        "purchase_quarter")


@case
def customers_slim(spark, d):
    return orders.customers_slim(adapters.customers(spark, d))


@case
def products_translated(spark, d):
    return orders.products_translated(adapters.products(spark, d),
                                      adapters.category_translation(spark, d))


@case
def payments_agg(spark, d):
    return orders.payments_per_order(adapters.order_payments(spark, d))


@case
def items_agg(spark, d):
    return orders.items_per_order(adapters.order_items(spark, d))


@case
def primary_category(spark, d):
    english = orders.products_translated(adapters.products(spark, d),
                                         adapters.category_translation(spark, d))
    return orders.primary_category(adapters.order_items(spark, d), english)


@case
def orders_fact(spark, d):
    return fact(spark, d)


@case
def orders_fact_partition_pruned(spark, d):
    path = scratch_path(spark, "fact")
    batch.save_partitioned(fact(spark, d), path, commerce.FACT_PARTITIONS)
    return (spark.read.parquet(path).filter("purchase_year = 1997 AND purchase_month <= 6")
            .select("order_id", "purchase_year", "purchase_month", "total_payment",
                    "primary_category"))


@case
def customer_base(spark, d):
    return customers.customer_base(fact(spark, d))


@case
def rfm_scores(spark, d):
    return customers.rfm_scores(customers.customer_base(fact(spark, d))).select(
        "customer_unique_id", "recency_days", "frequency", "monetary", "r_score", "f_score",
        "m_score")


@case
def customer_rfm(spark, d):
    return customers.customer_rfm(fact(spark, d))


@case
def monthly_revenue(spark, d):
    return revenue.monthly_revenue(fact(spark, d))


@case
def category_performance(spark, d):
    return revenue.category_performance(fact(spark, d))


@case
def report_segments(spark, d):
    return reports.report_segments(customers.customer_rfm(fact(spark, d)))


@case
def report_top_customers(spark, d):
    return reports.report_top_customers(customers.customer_rfm(fact(spark, d)))


@case
def report_monthly(spark, d):
    return reports.report_monthly(revenue.monthly_revenue(fact(spark, d)))


@case
def report_top_state_months(spark, d):
    return reports.report_top_state_months(revenue.monthly_revenue(fact(spark, d)))


@case
def report_categories(spark, d):
    return reports.report_categories(revenue.category_performance(fact(spark, d)))


@case
def adhoc_segment_revenue(spark, d):
    return reports.adhoc_segment_revenue(customers.customer_rfm(fact(spark, d)))


@case
def adhoc_gmv_trend(spark, d):
    return reports.adhoc_gmv_trend(revenue.monthly_revenue(fact(spark, d)))


@case
def adhoc_top10_categories(spark, d):
    return reports.adhoc_top10_categories(revenue.category_performance(fact(spark, d)))


@case
def orders_fact_bucketed(spark, d):
    """The order table over raw tables that are bucketed by order."""
    tables = {}
    for name in ("orders", "order_items", "order_payments"):
        path = scratch_path(spark, name)
        tables[name] = "bucketed_" + path.rsplit("-", 1)[1]
        batch.save_bucketed(adapters.COMMERCE[name](spark, d), tables[name], path, "order_id", 16)
    return orders.orders_fact_colocated(
        *[spark.table(tables[n]) if n in tables else adapters.COMMERCE[n](spark, d) for n in (
            "orders", "order_items", "customers", "order_payments", "products", "category_translation")])


@case
def csv_quarantine(spark, d):
    """Lines of order items: well-formed ones typed, malformed ones with the reason."""
    folder = scratch_path(spark, "lines")
    adapters.csv_lines(spark, d).write.text(folder)
    good, bad = read_csv_checked(spark, folder, adapters.order_items(spark, d).schema, header=False)
    good, bad = good.drop(*LINEAGE), bad.drop(*LINEAGE, CORRUPT)
    return good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad.withColumnRenamed("_reason", "reason"))


# --- shipments, in batch form ------------------------------------------------
@case
def bronze_shipments(spark, d):
    return raw_shipments(spark, d).drop("ingested_at")


@case
def bronze_carriers(spark, d):
    return shipments.parse_envelope(adapters.carrier_envelopes(spark, d),
                                    CARRIER_UPDATE).drop("ingested_at")


@case
def bronze_warehouses(spark, d):
    return shipments.parse_envelope(adapters.warehouse_envelopes(spark, d),
                                    WAREHOUSE_OP).drop("ingested_at")


@case
def quarantined_events(spark, d):
    _, bad = quality.split_corrupt(raw_shipments(spark, d))
    return bad.select(CORRUPT, "kafka_ts", "partition", "offset")


@case
def silver_shipments(spark, d):
    return silver(spark, d)


@case
def severity_distribution(spark, d):
    return silver(spark, d).groupBy("delay_severity").agg(F.count(F.lit(1)).alias("events"))


@case
def geo_region_counts(spark, d):
    return silver(spark, d).groupBy("geo_region").agg(F.count(F.lit(1)).alias("events"))


@case
def carrier_kpis(spark, d):
    return shipments.carrier_kpis(silver(spark, d))


@case
def active_alerts(spark, d):
    return shipments.active_alerts(silver(spark, d)).drop("alert_generated_at")


@case
def alert_summary(spark, d):
    return shipments.alert_summary(shipments.active_alerts(silver(spark, d)),
                                   "carrier_code", "delay_severity")


@case
def alerts_topk(spark, d):
    alerts = shipments.active_alerts(silver(spark, d)).drop("alert_generated_at")
    return serving.newest_alerts(alerts, "fedex", "high", 50, newest_by="event_ts")


@case
def kpi_lookback(spark, d):
    return serving.recent_kpis(shipments.carrier_kpis(silver(spark, d)), "ups", 1440,
                               as_of=datetime(2024, 1, 15, 12))


@case
def stored_alerts(spark, d):
    """The newest alerts of one carrier, from the stored table."""
    path = scratch_path(spark, "alerts")
    (shipments.active_alerts(silver(spark, d))
     .withColumn("alert_generated_at", F.col("event_ts") + F.expr("INTERVAL 1 MINUTE"))
     .write.partitionBy("carrier_code").parquet(path))
    return serving.fetch_alerts(spark, path, "dhl", "high", 100)


@case
def stored_kpis(spark, d):
    """Half a day of figures of one carrier, from the stored table."""
    path = scratch_path(spark, "kpis")
    shipments.carrier_kpis(silver(spark, d)).write.parquet(path)
    return serving.fetch_carrier_kpis(spark, path, "fedex", 720, as_of=datetime(2024, 1, 20))


@case
def carrier_kpis_hourly(spark, d):
    """Five-minute sums and sketches are stored; hours are made of these, not of events."""
    path = scratch_path(spark, "sketches")
    kpi_rollup.carrier_sketches(silver(spark, d)).write.parquet(path)
    return kpi_rollup.kpis_of_sketches(kpi_rollup.merge_sketches(spark.read.parquet(path)))


# --- shipments, as streams ---------------------------------------------------
TOPICS = {"shipments": adapters.shipment_envelopes, "carriers": adapters.carrier_envelopes,
          "warehouses": adapters.warehouse_envelopes}


def medallion(spark, sources, base):
    return streams.run_stream_medallion(spark, sources, f"{base}/tables", f"{base}/checkpoints",
                                        trigger=AVAILABLE_NOW)


def run_topics(spark, d):
    """All messages through all six queries; returns the folder of the tables."""
    base = scratch_path(spark, "stream")
    sources = {}
    for topic, build in TOPICS.items():
        build(spark, d).write.parquet(f"{base}/topics/{topic}")
        sources[topic] = envelope_stream(spark, f"{base}/topics/{topic}")
    medallion(spark, sources, base)
    return f"{base}/tables"


def shipment_stream(spark, d):
    """(folder for output, stream of all parsed shipment messages)."""
    base = scratch_path(spark, "stream")
    adapters.shipment_envelopes(spark, d).write.parquet(f"{base}/topic")
    return base, shipments.parse_envelope(envelope_stream(spark, f"{base}/topic"), SHIPMENT,
                                          ("partition", "offset"))


def drain(spark, df, base, mode="append"):
    """Run a stream to its end; returns its output folder."""
    stream_sink(df, f"{base}/out", f"{base}/checkpoint", mode, AVAILABLE_NOW).awaitTermination()
    return f"{base}/out"


def middle_time(spark, d):
    """Half-way point of the event times."""
    row = adapters.table(spark, d, "events").agg(
        F.timestamp_millis(((F.unix_millis(F.min("ts")) + F.unix_millis(F.max("ts"))) / 2)
                           .cast("bigint")).alias("t")).first()
    return F.lit(row.t)


@case
def stream_bronze_shipments(spark, d):
    base, bronze = shipment_stream(spark, d)
    return spark.read.parquet(drain(spark, bronze, base)).drop("ingested_at")


@case
def stream_complete_counts(spark, d):
    base, bronze = shipment_stream(spark, d)
    counts = bronze.groupBy("carrier_code", "event_type").agg(F.count(F.lit(1)).alias("events"))
    return read_newest_version(spark, drain(spark, counts, base, "complete"))


@case
def stream_dedup(spark, d):
    base, bronze = shipment_stream(spark, d)
    events = shipments.enrich(bronze)
    once = streams.stream_dedup(events, shipments.EVENT_KEY, "event_ts", spread_by="offset")
    return spark.read.parquet(drain(spark, once.select(*shipments.EVENT_KEY, "event_type"), base))


@case
def stream_silver_shipments(spark, d):
    return spark.read.parquet(f"{run_topics(spark, d)}/silver/shipments").drop(
        "ingested_at", "processed_at", "offset")


@case
def stream_carrier_kpis(spark, d):
    return spark.read.parquet(f"{run_topics(spark, d)}/gold/carrier_kpis")


@case
def stream_alerts(spark, d):
    return spark.read.parquet(f"{run_topics(spark, d)}/gold/alerts").drop("alert_generated_at")


@case
def stream_restart(spark, d):
    """Half of the messages, stop, the other half, start again."""
    base, middle = scratch_path(spark, "stream"), middle_time(spark, d)
    sources = {}
    for first in (True, False):
        for topic, build in TOPICS.items():
            early = F.col("timestamp") - F.expr("INTERVAL 1 SECOND") < middle
            (build(spark, d).filter(early if first else ~early)
             .write.mode("append").parquet(f"{base}/topics/{topic}"))
            sources[topic] = envelope_stream(spark, f"{base}/topics/{topic}")
        medallion(spark, sources, base)
    return spark.read.parquet(f"{base}/tables/gold/carrier_kpis")


@case
def stream_late_events(spark, d):
    """The later half first; then the earlier half is beyond the watermark."""
    base, middle = scratch_path(spark, "stream"), middle_time(spark, d)
    events, metrics = stored(silver(spark, d), "silver"), {}
    for late in (False, True):
        early = F.col("event_ts") < middle
        (events.filter(early if late else ~early).write.mode("append").parquet(f"{base}/in"))
        stream = streams.read_table_stream(spark, f"{base}/in", events)
        query = stream_sink(shipments.carrier_kpis(stream), f"{base}/out", f"{base}/checkpoint",
                            trigger=AVAILABLE_NOW)
        query.awaitTermination()
        metrics = stream_metrics(query)
    return spark.read.parquet(f"{base}/out").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("total_events").alias("events_on_time"),
        F.lit(metrics["dropped_late"]).cast("bigint").alias("late_groups_dropped"))


@case
def stream_quarantine(spark, d):
    """Both halves of the messages through one query that is started twice; what is malformed is kept."""
    base, middle = scratch_path(spark, "stream"), middle_time(spark, d)
    for first in (True, False):
        early = F.col("timestamp") - F.expr("INTERVAL 1 SECOND") < middle
        (adapters.shipment_envelopes(spark, d).filter(early if first else ~early)
         .write.mode("append").parquet(f"{base}/topic"))
        parsed = shipments.parse_envelope(envelope_stream(spark, f"{base}/topic"), SHIPMENT,
                                          ("partition", "offset"))
        batches.quarantine_stream(parsed, f"{base}/good", f"{base}/bad", f"{base}/checkpoint",
                                  AVAILABLE_NOW).awaitTermination()
    good = batches.read_batches(spark, f"{base}/good").select("shipment_id", "kafka_ts", "partition", "offset")
    bad = batches.read_batches(spark, f"{base}/bad").select(CORRUPT, "kafka_ts", "partition", "offset")
    return good.unionByName(bad, allowMissingColumns=True)


@case
def stream_late_rows(spark, d):
    """The later half first; rows of the earlier half are late and kept with the watermark they missed."""
    base, middle = scratch_path(spark, "stream"), middle_time(spark, d)
    events = stored(silver(spark, d), "silver").select("shipment_id", "event_ts", "carrier_code")
    for late in (False, True):
        early = F.col("event_ts") < middle
        events.filter(early if late else ~early).write.mode("append").parquet(f"{base}/in")
        stream = streams.read_table_stream(spark, f"{base}/in", events)
        batches.late_rows_stream(stream, "event_ts", "10 minutes", f"{base}/out", f"{base}/checkpoint",
                                 AVAILABLE_NOW).awaitTermination()
    in_time, late_rows = (batches.read_batches(spark, f"{base}/out/{n}").drop(batches.BATCH)
                          for n in ("on_time", "late"))
    return in_time.unionByName(late_rows, allowMissingColumns=True)


@case
def stream_schema_evolution(spark, d):
    """A query is stopped and started again over events that have gained a column."""
    base = scratch_path(spark, "stream")
    events = adapters.table(spark, d, "events")
    old = F.col("event_type").isin("signup", "view")
    for part, columns in ((events.filter(old), ["event_id", "ts", "event_type"]),
                          (events.filter(~old), ["event_id", "ts", "event_type", "value"])):
        rows = part.select(*columns)
        rows.write.mode("append").parquet(f"{base}/in")
        drain(spark, streams.read_table_stream(spark, f"{base}/in", rows), base)
    return batch.read_merged(spark, f"{base}/out")


# --- indicators --------------------------------------------------------------
@case
def indicator_flatten(spark, d):
    return indicators.flatten_payload(adapters.payloads(spark, d), adapters.LOADED_AT,
                                      adapters.ORDER_INDICATORS)


@case
def indicator_scan(spark, d):
    return indicators.indicator_scan(adapters.indicators(spark, d))


@case
def indicator_load(spark, d):
    path = scratch_path(spark, "indicators")
    for _ in range(2):
        batch.truncate_and_load(adapters.indicators(spark, d), path)
    return spark.read.parquet(path)


@case
def indicator_layout_identity(spark, d):
    path = scratch_path(spark, "indicators")
    batch.save_indicators(adapters.indicators(spark, d), path)
    return spark.read.parquet(path)


@case
def indicator_preview(spark, d):
    return indicators.preview(facts(spark, d))


@case
def indicator_subset(spark, d):
    return indicators.select_indicators(facts(spark, d), ["REV", "UNKNOWN"],
                                        adapters.ORDER_INDICATORS)


@case
def indicator_slice(spark, d):
    return indicators.slice_indicators(facts(spark, d), CODE, SHOWN, 1996, 2000)


@case
def indicator_facets(spark, d):
    return indicators.facets(facts(spark, d))


@case
def formatted_values(spark, d):
    return indicators.formatted_values(facts(spark, d).withColumn("value", F.col("value") * 1000))


@case
def last_updated(spark, d):
    return indicators.last_updated(adapters.indicators(spark, d))


@case
def load_summary(spark, d):
    registry = {**adapters.ORDER_INDICATORS, "RET": ("ORD.RET", "Returned orders")}
    return indicators.load_summary(facts(spark, d), registry)


@case
def latest_snapshot(spark, d):
    return indicators.latest_snapshot(shown(spark, d))


@case
def yoy_snapshot(spark, d):
    return indicators.yoy_snapshot(shown(spark, d))


@case
def yoy_series(spark, d):
    return indicators.yoy_series(facts(spark, d))


@case
def pivot_recent_years(spark, d):
    return indicators.pivot_recent(shown(spark, d))


@case
def compare_latest(spark, d):
    return indicators.compare_latest(shown(spark, d))


@case
def trend_series(spark, d):
    return indicators.trend(shown(spark, d))


@case
def display_table(spark, d):
    return indicators.display_table(shown(spark, d), "Revenue")


@case
def csv_export_roundtrip(spark, d):
    table, path = indicators.display_table(facts(spark, d), "Revenue"), scratch_path(spark, "export")
    batch.export_csv(table, path)
    return spark.read.option("header", True).schema(table.schema).csv(path)


@case
def indicator_partial_reload(spark, d):
    """One indicator is loaded again with restated values; the others' folders stay."""
    path = scratch_path(spark, "indicators")
    rows = stored(adapters.indicators(spark, d), "indicators")
    batch.save_by_code(rows, path)
    restated = rows.filter(F.col("indicator_code") == CODE).withColumn("value", F.col("value") + 1)
    batch.reload_indicators(restated, [CODE], path)
    return spark.read.parquet(path)


@case
def indicator_job(spark, d):
    """Saved responses through the whole job: a full load, then one indicator alone."""
    base = scratch_path(spark, "job")
    adapters.save_payloads(spark, adapters.payloads(spark, d), f"{base}/in", "all")
    run = {"registry": adapters.ORDER_INDICATORS, "loaded_at": adapters.LOADED_AT}
    run_indicators(spark, f"{base}/in", f"{base}/full", **run)
    run_indicators(spark, f"{base}/in", f"{base}/part", ["CNT"], existing=f"{base}/full", **run)
    return spark.read.parquet(f"{base}/part")


@case
def payload_files_incremental(spark, d):
    """Response files arrive in two parts, the second with restated years; each file is read once."""
    base, facts = scratch_path(spark, "payloads"), stored(adapters.indicators(spark, d), "indicators")
    keys = ["country_name", "indicator_code", "year"]
    again = facts.filter("year >= 1997").withColumn("value", F.col("value") + 1000)
    for label, part in (("first", facts), ("second", again)):
        adapters.save_payloads(spark, adapters.payloads_of(part), f"{base}/in", label)
        files = payload_stream(spark, f"{base}/in")
        rows = indicators.flatten_payload(files, adapters.LOADED_AT, adapters.ORDER_INDICATORS,
                                          ["file_time", "file_name"])
        batches.upsert_stream(rows, keys, ["file_time", "file_name"], f"{base}/changes", f"{base}/checkpoint",
                              AVAILABLE_NOW).awaitTermination()
    return batches.read_current(spark, f"{base}/changes", keys).drop("file_time", "file_name")


# --- evolution and upkeep ----------------------------------------------------
@case
def schema_evolution_union(spark, d):
    path, events = scratch_path(spark, "evolving"), adapters.table(spark, d, "events")
    old = F.col("event_type").isin("signup", "view")
    batch.append_evolving(events.filter(old).select("event_id", "ts", "event_type"), path)
    batch.append_evolving(events.filter(~old).select("event_id", "ts", "event_type", "value"), path)
    return batch.read_merged(spark, path)


def to_instant(*day: int) -> datetime:
    """A day's start in UTC, as Spark literals take it."""
    return datetime(*day, tzinfo=timezone.utc)


def stored_silver(spark, d):
    """Clean shipments in the files the de-duplication leaves; returns their path."""
    path = scratch_path(spark, "silver")
    silver(spark, d).write.parquet(path)
    return path


@case
def compact_identity(spark, d):
    path = scratch_path(spark, "compact")
    upkeep.compact(spark, stored_silver(spark, d), path)
    return spark.read.parquet(path)


@case
def zorder_identity(spark, d):
    path = scratch_path(spark, "zorder")
    upkeep.zorder_layout(spark, stored_silver(spark, d), path, ["carrier_code", "event_ts"])
    return spark.read.parquet(path)


def large_files(rows, limit=1_000_000):
    """Number of files, at least one, of at most about ``limit`` rows each."""
    return max(1, math.ceil(rows.count() / limit))


@case
def compact_small_files(spark, d):
    """Clean shipments as a file per million older events and 24 times as many of newer ones; the small ones are joined."""
    path, middle = scratch_path(spark, "silver"), middle_time(spark, d)
    rows = stored(silver(spark, d), "silver")
    older = rows.filter(F.col("event_ts") < middle)
    files = large_files(older)
    older.repartition(files).write.parquet(path)
    large = min(compaction.file_sizes(spark.read.parquet(path)).values())
    rows.filter(F.col("event_ts") >= middle).repartition(24 * files).write.mode("append").parquet(path)
    compaction.compact_small_files(spark, path, small=large, target=max(large, 1 << 16))
    return spark.read.parquet(path)


@case
def zorder_file_pruning(spark, d):
    """Three days of one carrier, from the few clustered files that hold some."""
    path, columns = scratch_path(spark, "zorder"), ["carrier_code", "event_ts"]
    upkeep.zorder_layout(spark, stored_silver(spark, d), path, columns, files=64)
    refresh_file_stats(spark, path, columns)
    days = Between("event_ts", to_instant(2024, 1, 9), to_instant(2024, 1, 12))
    return read_matching(spark, path, [equal("carrier_code", "UPS"), days])


@case
def table_inventory(spark, d):
    """Three of the four shipment tables are there, so the set is degraded."""
    base = scratch_path(spark, "inventory")
    clean = stored(silver(spark, d), "silver")
    raw_shipments(spark, d).write.parquet(f"{base}/bronze/shipments")
    clean.write.parquet(f"{base}/silver/shipments")
    shipments.active_alerts(clean).write.parquet(f"{base}/gold/alerts")
    return upkeep.table_inventory(spark, {
        "bronze/shipments": (f"{base}/bronze/shipments", "kafka_ts"),
        "silver/shipments": (f"{base}/silver/shipments", "event_ts"),
        "gold/alerts": (f"{base}/gold/alerts", "event_ts"),
        "gold/carrier_kpis": (f"{base}/gold/carrier_kpis", "window_start")})
