"""The wide order table and the pieces it is made of."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.numbers import money_sum
from tierflow.functions.times import parse_timestamps
from tierflow.operators.quality import require_key
from tierflow.schemas import ORDER_TIMES


def add_order_dates(orders: DataFrame) -> DataFrame:
    """Parse the order times, drop orders without id, add calendar columns."""
    bought, arrived = F.col("order_purchase_timestamp"), F.col("order_delivered_customer_date")
    return require_key(parse_timestamps(orders, ORDER_TIMES), "order_id").withColumns({
        "delivery_days": F.datediff(arrived, bought),
        "is_late": arrived > F.col("order_estimated_delivery_date"),
        "purchase_year": F.year(bought),
        "purchase_month": F.month(bought),
        "purchase_quarter": F.quarter(bought),
    })


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Total paid per order, with type and installments of its first payment."""
    first = F.min(F.struct("payment_sequential", "payment_type", "payment_installments"))
    return (payments.groupBy("order_id")
            .agg(money_sum("payment_value").alias("total_payment"), first.alias("first"))
            .select("order_id", "total_payment",
                    F.col("first.payment_installments").cast("int").alias("payment_installments"),
                    "first.payment_type"))


def _item_totals() -> list[Column]:
    return [F.count("order_item_id").alias("item_count"),
            money_sum("price").alias("items_subtotal"),
            money_sum("freight_value").alias("freight_total")]


def items_per_order(items: DataFrame) -> DataFrame:
    """Number of items, sum of prices and sum of freight per order."""
    return items.groupBy("order_id").agg(*_item_totals())


def products_translated(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category; untranslated ones keep NULL.

    Neither side has a size bound, so the join strategy is left to the planner,
    which broadcasts the translation while it is below the threshold.
    """
    return (products.join(translation, "product_category_name", "left")
            .select("product_id", F.col("product_category_name_english").alias("category")))


def _with_first_product(items: DataFrame, *totals: Column) -> DataFrame:
    first = F.min(F.struct("order_item_id", "product_id"))
    return (items.groupBy("order_id").agg(*totals, first.alias("_first"))
            .withColumn("product_id", F.col("_first.product_id")).drop("_first"))


def primary_category(items: DataFrame, products_en: DataFrame) -> DataFrame:
    """Category of the first item of each order (NULL if that item has none).

    The first item is found before the product join, so only one narrow row
    per order takes part in it instead of every item.
    """
    return (_with_first_product(items).join(products_en, "product_id", "left")
            .select("order_id", F.col("category").alias("primary_category")))


def top_category(items: DataFrame, products_en: DataFrame) -> DataFrame:
    """Variant: the most frequent category of each order, ties by name."""
    counts = (items.join(products_en, "product_id", "left")
              .groupBy("order_id", "category").agg(F.count(F.lit(1)).alias("n")))
    return (counts.groupBy("order_id")
            .agg(F.min_by("category", F.struct(-F.col("n"), "category")).alias("primary_category")))


def customers_slim(customers: DataFrame) -> DataFrame:
    """The customer columns the order table needs."""
    return customers.select("customer_id", "customer_unique_id",
                            F.col("customer_city").alias("city"),
                            F.col("customer_state").alias("state"))


def orders_fact(orders: DataFrame, items: DataFrame, customers: DataFrame, payments: DataFrame,
                products: DataFrame, translation: DataFrame) -> DataFrame:
    """One wide row per order.

    Items are aggregated once for totals and first product. The narrow joins on
    customer and product key come before the joins on ``order_id``, whose
    sides are all hash-partitioned on it already or become so exactly once.
    """
    lines = (_with_first_product(items, *_item_totals())
             .join(products_translated(products, translation), "product_id", "left")
             .withColumnRenamed("category", "primary_category").drop("product_id"))
    return (add_order_dates(orders)
            .join(customers_slim(customers), "customer_id", "left")
            .join(payments_per_order(payments), "order_id", "left")
            .join(lines, "order_id", "left"))


def orders_fact_colocated(orders: DataFrame, items: DataFrame, customers: DataFrame, payments: DataFrame,
                          products: DataFrame, translation: DataFrame) -> DataFrame:
    """The same table from orders, items and payments that are bucketed by ``order_id``.

    The joins on that key come first: all three sides lie in the same buckets, in order,
    so neither the sums nor these joins shuffle. Only the joins on product and
    customer key move rows, where their tables are too large to broadcast.
    """
    lines = _with_first_product(items, *_item_totals())
    return (add_order_dates(orders)
            .join(payments_per_order(payments), "order_id", "left")
            .join(lines, "order_id", "left")
            .join(products_translated(products, translation), "product_id", "left")
            .withColumnRenamed("category", "primary_category").drop("product_id")
            .join(customers_slim(customers), "customer_id", "left"))
