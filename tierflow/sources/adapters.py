"""The domain tables, derived from the star-schema test tables.

Only per-row arithmetic and joins with the nation table, so every adapter
grows with its source and needs no shuffle (indicators are an aggregate).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierflow.functions.numbers import MONEY_UNITS, money
from tierflow.operators.indicators import Registry
from tierflow.session import file_system, make_folder, plain_name, scratch_path

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
PLAIN = "yyyy-MM-dd HH:mm:ss"

# The measures computed from the order table.
ORDER_INDICATORS: Registry = {
    "REV": ("ORD.REV", "Order revenue"),
    "CNT": ("ORD.CNT", "Number of orders"),
    "AOV": ("ORD.AOV", "Average order value"),
}
LOADED_AT = datetime(2024, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with its times as (UTC) timestamps."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    naive = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in naive})


def _days(count: Column | int) -> Column:
    return F.make_dt_interval(count if isinstance(count, Column) else F.lit(count))


def _hundredths(column: str) -> Column:
    """A number with two decimals times 100, as a whole (double) number, so
    that products of such numbers are exact."""
    return F.rint(F.col(column) * 100)


def _every(n: int, column: str = "event_id", rest: int = 0) -> Column:
    return F.col(column) % n == rest


def _pick(column: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (column + 1).cast("int"))


# --- commerce ----------------------------------------------------------------
def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their times as text, the way files deliver them."""
    day, status = F.col("o_orderdate"), F.col("o_orderstatus")
    arrived = F.when(status == "F", day + _days((F.col("o_orderkey") % 30).cast("int")))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(status == "F", "delivered").when(status == "O", "shipped")
         .otherwise("processing").alias("order_status"),
        F.date_format(day, PLAIN).alias("order_purchase_timestamp"),
        F.date_format(day + F.expr("INTERVAL 1 HOUR"), PLAIN).alias("order_approved_at"),
        F.date_format(day + _days(1), PLAIN).alias("order_delivered_carrier_date"),
        F.date_format(arrived, PLAIN).alias("order_delivered_customer_date"),
        F.date_format(day + _days(20), PLAIN).alias("order_estimated_delivery_date"))


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    freight = _hundredths("l_extendedprice") * _hundredths("l_tax") / 10_000
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"), freight.alias("freight_value"))


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    paid = _hundredths("l_extendedprice") * (100 - _hundredths("l_discount")) / 10_000
    kind = (F.when(F.col("l_returnflag") == "A", "credit_card")
             .when(F.col("l_returnflag") == "N", "boleto").otherwise("voucher"))
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("payment_sequential"),
        kind.alias("payment_type"),
        (F.lit(1) + F.col("l_partkey") % 12).cast("int").alias("payment_installments"),
        paid.alias("payment_value"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    person = F.concat(F.lit("U"), F.floor(F.col("c_custkey") / 2).cast("string"))
    return (table(spark, sf_dir, "customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("c_custkey").alias("customer_id"), person.alias("customer_unique_id"),
                    F.col("c_mktsegment").alias("customer_city"),
                    F.col("n_name").alias("customer_state")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = F.when(~_every(50, "p_partkey"), F.col("p_type"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), category.alias("product_category_name"))


def category_translation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "part").filter(~F.col("p_type").contains("SMALL"))
            .select(F.col("p_type").alias("product_category_name")).distinct()
            .withColumn("product_category_name_english", F.lower("product_category_name")))


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (table(spark, sf_dir, "supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("s_suppkey").alias("seller_id"), F.col("n_name").alias("seller_state")))


def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One review per delivered order."""
    return (table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")
            .select(F.concat(F.lit("R"), F.col("o_orderkey")).alias("review_id"),
                    F.col("o_orderkey").alias("order_id"),
                    (F.lit(1) + F.col("o_orderkey") % 5).cast("int").alias("review_score")))


COMMERCE = {
    "orders": orders, "order_items": order_items, "customers": customers, "products": products,
    "sellers": sellers, "order_payments": order_payments, "order_reviews": order_reviews,
    "category_translation": category_translation,
}


# --- event streams -----------------------------------------------------------
def shipment_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipment messages: some sent twice, some not JSON, some without id."""
    event, user = F.col("event_id"), F.col("user_id")
    kind = (F.when(F.col("event_type") == "signup", "PICKUP")
             .when(F.col("event_type") == "view", "IN_TRANSIT")
             .when(F.col("event_type") == "click", "OUT_FOR_DELIVERY")
             .when(F.col("event_type") == "purchase", "DELIVERED").otherwise("EXCEPTION"))
    tier = (F.when(event % 10 < 6, "STANDARD").when(event % 10 < 9, "EXPRESS")
             .otherwise("OVERNIGHT"))
    delay = F.when(~_every(97), F.when(_every(5), F.floor(F.col("value") * 20)).otherwise(0))
    message = F.to_json(F.struct(
        F.when(~_every(211), F.concat(F.lit("SHP-"), user)).alias("shipment_id"),
        kind.alias("event_type"),
        _pick(user % 4, ["FEDEX", "UPS", "DHL", "USPS"]).alias("carrier_code"),
        tier.alias("service_type"),
        F.concat(F.lit("WH-"), user % 6).alias("origin_wh"),
        F.concat(F.lit("City-"), event % 20).alias("dest_city"),
        F.lit("US").alias("dest_country"),
        (F.lit(0.5) + (event % 400) / 10).alias("weight_kg"),
        F.date_format(F.col("ts") + _days(2), ISO).alias("promised_eta"),
        F.date_format("ts", ISO).alias("event_ts"),
        (F.lit(25.0) + (event % 240) / 10).alias("latitude"),
        F.when(~_every(89), F.lit(-125.0) + (event % 601) / 10).alias("longitude"),
        delay.cast("int").alias("delay_minutes"),
        F.when(F.col("event_type") == "error", "reported by carrier").otherwise("").alias("notes")))
    copies = F.when(_every(50), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (table(spark, sf_dir, "events").withColumn("copy", F.explode(copies))
            .select(F.when(_every(199), "not json").otherwise(message).alias("value"),
                    (F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("timestamp"),
                    (user % 6).cast("int").alias("partition"),
                    (event * 2 + F.col("copy")).alias("offset")))


def _envelope(events: DataFrame, message: Column) -> DataFrame:
    return events.select(message.alias("value"),
                         (F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("timestamp"),
                         F.lit(0).alias("partition"), F.col("event_id").alias("offset"))


def carrier_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    return _envelope(table(spark, sf_dir, "events"), F.to_json(F.struct(
        _pick(F.col("user_id") % 4, ["FEDEX", "UPS", "DHL", "USPS"]).alias("carrier_code"),
        _pick(event % 3, ["WEST", "CENTRAL", "EAST"]).alias("region"),
        (F.lit(100) + event % 4900).cast("int").alias("active_shipments"),
        (F.lit(0.75) + (event % 25) / 100).alias("on_time_rate"),
        F.col("value").alias("avg_delay_minutes"),
        F.date_format("ts", ISO).alias("report_ts"))))


def warehouse_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    event, user = F.col("event_id"), F.col("user_id")
    return _envelope(table(spark, sf_dir, "events"), F.to_json(F.struct(
        F.concat(F.lit("WH-"), user % 6).alias("warehouse_id"),
        _pick(event % 4, ["INBOUND", "OUTBOUND", "SCAN", "HOLD"]).alias("operation"),
        F.concat(F.lit("SHP-"), user).alias("shipment_id"),
        F.concat(F.lit("OP-"), event % 50).alias("operator_id"),
        (F.lit(1) + event % 24).cast("int").alias("dock_door"),
        F.date_format("ts", ISO).alias("op_ts"))))


# --- indicators --------------------------------------------------------------
def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three measures per nation and year, loaded at the time of its newest order;
    some nations have a row without value (and load time) in 2002."""
    per_customer = (table(spark, sf_dir, "orders")
                    .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
                    .agg(F.sum(money("o_totalprice")).alias("total"),
                         F.count(F.lit(1)).alias("orders"), F.max("o_orderdate").alias("newest")))
    sums = (per_customer.join(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"),
                              F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_nationkey", "year")
            .agg((F.sum("total").cast("double") / MONEY_UNITS).alias("total"),
                 F.sum("orders").cast("double").alias("orders"), F.max("newest").alias("loaded_at")))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    measures = sums.select("c_nationkey", "year", "loaded_at", F.expr(
        "stack(3, 'REV', total, 'CNT', orders, 'AOV', total / orders) AS (key, value)"))
    empty = nations.filter(_every(7, "n_nationkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.lit(2002).alias("year"),
        F.lit(None).cast("timestamp").alias("loaded_at"),
        F.lit("REV").alias("key"), F.lit(None).cast("double").alias("value"))
    code = F.create_map(*[F.lit(x) for k, (c, _) in ORDER_INDICATORS.items() for x in (k, c)])
    name = F.create_map(*[F.lit(x) for k, (_, n) in ORDER_INDICATORS.items() for x in (k, n)])
    return (measures.unionByName(empty)
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
                     .alias("country_code"),
                    F.col("n_name").alias("country_name"),
                    code[F.col("key")].alias("indicator_code"),
                    name[F.col("key")].alias("indicator_name"),
                    "year", "value", F.col("loaded_at").cast("timestamp").alias("loaded_at")))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Response pages (key, body), one page per indicator and year.

    Every fifth country comes without code, and each page ends with a record
    with a bad year. Two pages without records are added per indicator.
    """
    return payloads_of(indicators(spark, sf_dir))


def payloads_of(facts: DataFrame) -> DataFrame:
    """Indicator rows as response pages."""
    keys = F.create_map(*[F.lit(x) for k, (c, _) in ORDER_INDICATORS.items() for x in (c, k)])
    coded = F.substring("country_code", 2, 2).cast("int") % 5 != 0
    record = F.to_json(F.struct(
        F.struct(F.col("country_name").alias("value")).alias("country"),
        F.when(coded, F.col("country_code")).alias("countryiso3code"),
        F.col("year").cast("string").alias("date"), F.col("value")))
    full = (facts.groupBy("indicator_code", "year")
            .agg(F.concat(F.lit('[{"page":1},['), F.array_join(F.collect_list(record), ","),
                          F.lit(',{"country":{"value":"?"},"date":"20x5","value":1.5}]]'))
                  .alias("body"))
            .select(keys[F.col("indicator_code")].alias("key"), "body"))
    bare = (facts.select("indicator_code").distinct()
            .select(keys[F.col("indicator_code")].alias("key"),
                    F.explode(F.array(F.lit('[{"message":"none"}]'), F.lit('[{"page":1},null]')))
                     .alias("body")))
    return full.unionAll(bare)


def save_payloads(spark: SparkSession, pages: DataFrame, folder: str, label: str) -> None:
    """Response pages as files ``<key>.<label>-<page>.json``: one page an indicator and year, so they are few."""
    numbered = pages.withColumn("page", F.row_number().over(Window.partitionBy("key").orderBy("body")))
    staging = scratch_path(spark, "payloads")
    numbered.repartition("key", "page").write.partitionBy("key", "page").text(staging)
    make_folder(spark, folder)
    for name in spark.read.text(staging, wholetext=True).inputFiles():
        key, page = (part.split("=", 1)[1] for part in plain_name(name).split("/")[-3:-1])
        system, source = file_system(spark, plain_name(name))
        _, target = file_system(spark, f"{folder}/{key}.{label}-{page}.json")
        system.rename(source, target)


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items as CSV lines: some with a price that is no number, some cut short."""
    item, key = order_items(spark, sf_dir), F.col("order_id")
    price = F.when(_every(13, "order_id"), "n/a").otherwise(F.col("price").cast("string"))
    cells = [key, F.col("order_item_id"), F.col("product_id"), F.col("seller_id"), price]
    return item.select(F.when(_every(17, "order_id"), F.concat_ws(",", *cells)).otherwise(
        F.concat_ws(",", *cells, F.col("freight_value"))).alias("value"))
