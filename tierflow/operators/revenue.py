"""Revenue tables computed from the wide order table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.functions.numbers import flag_rate, money_avg, money_sum


def delivered(orders: DataFrame) -> DataFrame:
    """Orders that reached the customer."""
    return orders.filter(F.col("order_status") == "delivered")


def monthly_revenue(orders: DataFrame) -> DataFrame:
    """Revenue and order figures per purchase month and customer state."""
    return (delivered(orders).groupBy("purchase_year", "purchase_month", "state").agg(
        money_sum("total_payment").alias("revenue"),
        F.count("order_id").alias("order_count"),
        money_avg("total_payment").alias("avg_order_value"),
        F.sum("item_count").alias("total_items_sold"),
        F.avg("delivery_days").alias("avg_delivery_days")))


def category_performance(orders: DataFrame) -> DataFrame:
    """Revenue and delivery figures per category; no category is a group too."""
    return (delivered(orders).groupBy("primary_category").agg(
        money_sum("total_payment").alias("revenue"),
        F.count("order_id").alias("order_count"),
        money_avg("total_payment").alias("avg_order_value"),
        F.avg("delivery_days").alias("avg_delivery_days"),
        flag_rate("is_late").alias("late_rate")))
