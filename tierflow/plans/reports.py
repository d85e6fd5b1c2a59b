"""SQL reports over the ready commerce tables.

Each report takes the table it reads. Amounts and rates are rounded on their
decimal value, and each order ends in a key so that cut-offs are repeatable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _rounded(expression: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _mean(column: str) -> str:
    total = f"CAST(SUM(CAST({column} AS DECIMAL(28,10))) AS DOUBLE)"
    return f"try_divide({total}, CAST(COUNT({column}) AS DOUBLE))"


def _run(text: str, table: DataFrame) -> DataFrame:
    return table.sparkSession.sql(text, tbl=table)


def report_segments(rfm: DataFrame) -> DataFrame:
    """Customers and averages per segment, best spenders first."""
    return _run(f"""
        SELECT segment, COUNT(*) AS customers,
               {_rounded(_mean('recency_days'), 1)} AS avg_recency_days,
               {_rounded(_mean('frequency'), 2)} AS avg_orders,
               {_rounded(_mean('monetary'), 2)} AS avg_spend_brl,
               {_rounded(_mean('late_rate') + ' * 100', 1)} AS late_delivery_pct
        FROM {{tbl}} GROUP BY segment
        ORDER BY avg_spend_brl DESC NULLS LAST, segment""", rfm)


def report_top_customers(rfm: DataFrame, limit: int = 20) -> DataFrame:
    """Customers with the highest score."""
    return _run(f"""
        SELECT customer_unique_id, segment, recency_days, frequency,
               {_rounded('monetary', 2)} AS monetary_brl,
               r_score, f_score, m_score, rfm_score, state, top_category
        FROM {{tbl}} ORDER BY rfm_score DESC NULLS LAST, customer_unique_id LIMIT {limit}""", rfm)


def report_monthly(monthly: DataFrame) -> DataFrame:
    """Month totals across states."""
    return _run(f"""
        SELECT purchase_year, purchase_month,
               {_rounded('SUM(CAST(revenue AS DECIMAL(28,4)))', 2)} AS total_revenue_brl,
               SUM(order_count) AS total_orders,
               {_rounded(_mean('avg_order_value'), 2)} AS avg_order_value_brl,
               SUM(total_items_sold) AS items_sold
        FROM {{tbl}} GROUP BY purchase_year, purchase_month
        ORDER BY purchase_year, purchase_month""", monthly)


def report_top_state_months(monthly: DataFrame, limit: int = 20) -> DataFrame:
    """State-months with the highest revenue."""
    return _run(f"""
        SELECT purchase_year, purchase_month, state,
               {_rounded('revenue', 2)} AS revenue_brl, order_count,
               {_rounded('avg_order_value', 2)} AS avg_order_value_brl,
               {_rounded('avg_delivery_days', 1)} AS avg_delivery_days
        FROM {{tbl}}
        ORDER BY revenue_brl DESC NULLS LAST, purchase_year, purchase_month, state
        LIMIT {limit}""", monthly)


def report_categories(categories: DataFrame) -> DataFrame:
    """All categories, highest revenue first."""
    return _run(f"""
        SELECT primary_category, {_rounded('revenue', 2)} AS revenue_brl, order_count,
               {_rounded('avg_order_value', 2)} AS avg_order_value_brl,
               {_rounded('avg_delivery_days', 1)} AS avg_delivery_days,
               {_rounded('late_rate * 100', 1)} AS late_delivery_pct
        FROM {{tbl}} ORDER BY revenue_brl DESC NULLS LAST, primary_category""", categories)


def adhoc_segment_revenue(rfm: DataFrame) -> DataFrame:
    """Customers, spend and recency per segment."""
    return _run(f"""
        SELECT segment, COUNT(*) AS customers,
               {_rounded(_mean('monetary'), 2)} AS avg_spend_brl,
               {_rounded(_mean('recency_days'), 1)} AS avg_recency_days
        FROM {{tbl}} GROUP BY segment
        ORDER BY avg_spend_brl DESC NULLS LAST, segment""", rfm)


def adhoc_gmv_trend(monthly: DataFrame) -> DataFrame:
    """Revenue and orders per month."""
    return _run(f"""
        SELECT purchase_year, purchase_month,
               {_rounded('SUM(CAST(revenue AS DECIMAL(28,4)))', 2)} AS total_revenue_brl,
               SUM(order_count) AS total_orders
        FROM {{tbl}} GROUP BY purchase_year, purchase_month
        ORDER BY purchase_year, purchase_month""", monthly)


def adhoc_top10_categories(categories: DataFrame, limit: int = 10) -> DataFrame:
    """Categories with the highest revenue."""
    return _run(f"""
        SELECT primary_category, {_rounded('revenue', 2)} AS revenue_brl, order_count,
               {_rounded('late_rate * 100', 1)} AS late_pct
        FROM {{tbl}}
        ORDER BY revenue_brl DESC NULLS LAST, primary_category LIMIT {limit}""", categories)
