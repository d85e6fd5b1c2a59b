"""Stored layer tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.session import path_exists


def read_layer(spark: SparkSession, base: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Table ``name`` below ``base``."""
    return spark.read.format(fmt).load(f"{base.rstrip('/')}/{name}")


def read_if_there(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table at ``path``, or None if there is none (yet)."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "UNABLE_TO_INFER_SCHEMA":  # a folder without files yet
            return None
        raise


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or no rows of ``schema``."""
    found = read_if_there(spark, path)
    return spark.createDataFrame([], schema) if found is None else found


def register_layer_views(spark: SparkSession, tables: dict[str, str],
                         fmt: str = "parquet") -> tuple[list[str], list[str]]:
    """Make a view per (name, path); returns the names made and those skipped."""
    made, skipped = [], []
    for name, path in tables.items():
        table = read_if_there(spark, path, fmt)
        if table is None:
            skipped.append(name)
        else:
            table.createOrReplaceTempView(name)
            made.append(name)
    return made, skipped


def count_views(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row count of each view, in one job; Parquet counts come from footers."""
    counts = [spark.table(name).agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(name).alias("view_name"), "row_count") for name in names]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionAll(one)
    return result


# Ready, clean and raw tables of the commerce product, by view name.
COMMERCE_VIEWS = {
    "gold_customer_rfm": "gold/customer_rfm",
    "gold_monthly_revenue": "gold/monthly_revenue",
    "gold_category_performance": "gold/category_performance",
    "silver_orders_fact": "silver/orders_fact",
    "bronze_orders": "bronze/orders",
    "bronze_order_items": "bronze/order_items",
    "bronze_customers": "bronze/customers",
    "bronze_products": "bronze/products",
    "bronze_sellers": "bronze/sellers",
    "bronze_payments": "bronze/order_payments",
    "bronze_reviews": "bronze/order_reviews",
    "bronze_category_translation": "bronze/category_translation",
}


def commerce_views(base: str) -> dict[str, str]:
    """The commerce view paths below ``base``."""
    return {name: f"{base.rstrip('/')}/{path}" for name, path in COMMERCE_VIEWS.items()}
