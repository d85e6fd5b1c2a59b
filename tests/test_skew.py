"""A key that holds a third (or all) of the rows must not end up in one task."""

import pytest
from pyspark.sql import functions as F

from tierflow.operators.indicators import preview
from tierflow.operators.orders import customers_slim, orders_fact
from tierflow.operators.quality import dedup
from tierflow.operators.serving import recent_kpis
from tierflow.session import settings

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
}


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def hot(spark):
    """30,000 orders; a third belongs to one customer, a third starts with one product."""
    ids = spark.range(30_000)
    third = F.col("id") % 3 == 0
    day = F.date_format(F.timestamp_seconds(F.lit(1_500_000_000) + F.col("id") * 1000),
                        "yyyy-MM-dd HH:mm:ss")
    orders = ids.select(
        F.col("id").alias("order_id"), F.when(third, 7).otherwise(F.col("id")).alias("customer_id"),
        F.lit("delivered").alias("order_status"), *[day.alias(c) for c in (
            "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date")])
    items = ids.select(
        F.col("id").alias("order_id"), F.lit(1).alias("order_item_id"),
        F.when(third, 7).otherwise(F.col("id")).alias("product_id"), F.lit(1.0).alias("price"),
        F.lit(0.5).alias("freight_value"))
    customers = ids.select(F.col("id").alias("customer_id"), F.col("id").alias("customer_unique_id"),
                           F.lit("city").alias("customer_city"), F.lit("RJ").alias("customer_state"))
    payments = ids.select(F.col("id").alias("order_id"), F.lit(1).alias("payment_sequential"),
                          F.lit("card").alias("payment_type"), F.lit(1).alias("payment_installments"),
                          F.lit(1.5).alias("payment_value"))
    products = ids.select(F.col("id").alias("product_id"),
                          F.concat(F.lit("c"), F.col("id") % 10).alias("product_category_name"))
    translation = spark.range(10).select(
        F.concat(F.lit("c"), "id").alias("product_category_name"),
        F.concat(F.lit("category "), "id").alias("product_category_name_english"))
    return orders, items, customers, payments, products, translation


def test_hot_customer_is_split(spark, hot):
    with settings(spark, SMALL):
        joined = hot[0].join(customers_slim(hot[2]), "customer_id", "left")
        assert "skew=true" in final_plan(joined)


def test_hot_keys_give_the_right_fact(spark, hot):
    with settings(spark, SMALL):
        fact = orders_fact(*hot)
        row = fact.agg(F.count(F.lit(1)).alias("n"), F.sum("total_payment").alias("paid"),
                       F.count_if(F.col("customer_unique_id") == 7).alias("hot"),
                       F.count_if(F.col("primary_category") == "category 7").alias("category"),
                       F.count_distinct("order_id").alias("ids")).first()
    assert (row.n, row.ids, row.paid) == (30_000, 30_000, 45_000.0)
    assert row.hot == 10_001
    assert row.category == 10_000 + sum(1 for i in range(30_000) if i % 3 and i % 10 == 7)


def test_repeats_are_removed_before_the_shuffle(spark):
    df = spark.range(100_000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                     F.col("id").alias("offset"))
    once = dedup(df, ["k"], ["offset"])
    assert "row_number(), 1, Partial" in final_plan(once)
    assert [r.offset for r in once.filter("k = 0").collect()] == [0]


def test_preview_is_limited_before_the_shuffle(frame):
    df = frame("indicator_code string, country_name string, country_code string, year int,"
               " value double", *[("X", "c", "c", y, 1.0) for y in range(50)])
    assert "row_number(), 3, Partial" in final_plan(preview(df))


def test_look_back_reaches_the_scan(spark, frame, tmp_path):
    frame("carrier_code string, window_start timestamp, p95_delay_minutes int").write.parquet(
        str(tmp_path / "kpis"))
    with settings(spark, {"spark.sql.maxMetadataStringLength": "1000"}):
        text = final_plan(recent_kpis(spark.read.parquet(str(tmp_path / "kpis")), "ups"))
    assert "GreaterThanOrEqual(window_start" in text and "EqualTo(carrier_code,UPS)" in text
