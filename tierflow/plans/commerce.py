"""The commerce product: CSV files -> raw tables -> order table -> ready tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tierflow.operators.customers import customer_rfm
from tierflow.operators.orders import orders_fact
from tierflow.operators.revenue import category_performance, monthly_revenue
from tierflow.session import at_once
from tierflow.sinks.batch import save_partitioned, save_table
from tierflow.sources.csv import ingest_all
from tierflow.sources.layers import read_layer

FACT_PARTITIONS = ["purchase_year", "purchase_month"]


def orders_fact_from(spark: SparkSession, bronze: str, fmt: str = "parquet") -> DataFrame:
    """The order table over stored raw tables."""
    def raw(name: str) -> DataFrame:
        return read_layer(spark, bronze, name, fmt).drop("_ingested_at", "_source_file")

    return orders_fact(raw("orders"), raw("order_items"), raw("customers"),
                       raw("order_payments"), raw("products"), raw("category_translation"))


def run_commerce(spark: SparkSession, raw_dir: str, base: str,
                 tables: dict[str, T.StructType | None] | None = None,
                 fmt: str = "parquet") -> dict[str, int]:
    """All three steps in order, independent tables of a step side by side; returns the rows written per table."""
    counts = {f"bronze/{name}": n
              for name, n in ingest_all(spark, raw_dir, f"{base}/bronze", tables, fmt).items()}
    fact_path = f"{base}/silver/orders_fact"
    save_partitioned(orders_fact_from(spark, f"{base}/bronze", fmt), fact_path,
                     FACT_PARTITIONS, fmt)
    fact = spark.read.format(fmt).load(fact_path)

    def save(build: Callable[[DataFrame], DataFrame]) -> int:
        return save_table(build(fact), f"{base}/gold/{build.__name__}", fmt)

    return counts | at_once(spark, {f"gold/{build.__name__}": partial(save, build)
                                    for build in (customer_rfm, monthly_revenue, category_performance)})
