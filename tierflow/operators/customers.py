"""Customer value: recency, frequency, spend, scores and segments."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.functions.numbers import flag_rate, money_sum
from tierflow.operators.ranking import Ordering, global_ntile, stored
from tierflow.operators.revenue import delivered


def customer_base(orders: DataFrame) -> DataFrame:
    """One row per customer with delivered orders.

    Recency counts from the newest order of any status. State and category are
    those of the customer's first delivered order. The newest order is a scalar
    subquery, so nothing is collected while the plan is built.
    """
    newest = orders.agg(F.max("order_purchase_timestamp")).scalar()
    first = F.min(F.struct("order_purchase_timestamp", "order_id", "state", "primary_category"))
    return (delivered(orders).groupBy("customer_unique_id").agg(
                F.max("order_purchase_timestamp").alias("last_purchase"),
                F.countDistinct("order_id").alias("frequency"),
                money_sum("total_payment").alias("monetary"),
                F.avg("delivery_days").alias("avg_delivery_days"),
                flag_rate("is_late").alias("late_rate"),
                first.alias("first"))
            .select("customer_unique_id",
                    F.datediff(newest, "last_purchase").alias("recency_days"),
                    "frequency", "monetary", "avg_delivery_days", "late_rate",
                    "first.state", F.col("first.primary_category").alias("top_category")))


def rfm_scores(base: DataFrame) -> DataFrame:
    """Quintile scores 1..5, ties broken by customer id.

    ``base`` is written to the shared folder first because it is scanned more
    than once.
    """
    key = "customer_unique_id"
    return global_ntile(stored(base, "customer-base"), 5, {
        "r_score": Ordering("recency_days", key, descending=True),
        "f_score": Ordering("frequency", key),
        "m_score": Ordering("monetary", key)})


def segment(r: Column, f: Column, total: Column) -> Column:
    """Segment name; the first rule that holds wins."""
    return (F.when(total >= 13, "Champions")
             .when(total >= 10, "Loyal Customers")
             .when((r >= 4) & (f <= 2), "New Customers")
             .when((r <= 2) & (f >= 4), "At Risk")
             .when(total <= 5, "Lost")
             .otherwise("Potential Loyalists"))


def customer_rfm(orders: DataFrame) -> DataFrame:
    """Customer base with scores, their sum and the segment."""
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    return (rfm_scores(customer_base(orders)).withColumn("rfm_score", total)
            .withColumn("segment", segment(F.col("r_score"), F.col("f_score"), F.col("rfm_score"))))
