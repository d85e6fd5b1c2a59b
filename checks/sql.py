"""DuckDB SQL with the results the registered queries must have.

Written against the raw test tables, independently of the Spark code: firsts by
row numbers, tiles by the window function, JSON never parsed.
"""

from __future__ import annotations

# --- commerce ----------------------------------------------------------------
ORDERS = """orders_d AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
              ELSE 'processing' END AS order_status,
         o_orderdate AS order_purchase_timestamp,
         o_orderdate + INTERVAL 1 HOUR AS order_approved_at,
         o_orderdate + INTERVAL 1 DAY AS order_delivered_carrier_date,
         CASE WHEN o_orderstatus = 'F'
              THEN o_orderdate + to_days(CAST(o_orderkey % 30 AS INTEGER)) END
           AS order_delivered_customer_date,
         o_orderdate + INTERVAL 20 DAY AS order_estimated_delivery_date
  FROM orders)"""

ORDER_DATES = ORDERS + """, order_dates AS (
  SELECT *,
    CAST(date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS INTEGER)
      AS delivery_days,
    order_delivered_customer_date > order_estimated_delivery_date AS is_late,
    CAST(year(order_purchase_timestamp) AS INTEGER) AS purchase_year,
    CAST(month(order_purchase_timestamp) AS INTEGER) AS purchase_month,
    CAST(quarter(order_purchase_timestamp) AS INTEGER) AS purchase_quarter
  FROM orders_d)"""

ITEMS = """items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_suppkey AS seller_id, l_extendedprice AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DOUBLE)
           AS freight_value
  FROM lineitem)"""

PAYMENTS = """payments AS (
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential,
         CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'N' THEN 'boleto' ELSE 'voucher' END
           AS payment_type,
         CAST(1 + l_partkey % 12 AS INTEGER) AS payment_installments,
         CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
           AS payment_value
  FROM lineitem)"""

CUSTOMERS = """customers_d AS (
  SELECT c_custkey AS customer_id,
         'U' || CAST(CAST(floor(c_custkey / 2) AS BIGINT) AS VARCHAR) AS customer_unique_id,
         c_mktsegment AS city, n_name AS state
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

TRANSLATED = """translated AS (
  SELECT p_partkey AS product_id,
         CASE WHEN p_partkey % 50 <> 0 AND p_type NOT LIKE '%SMALL%' THEN lower(p_type) END
           AS category
  FROM part)"""

PAYMENTS_AGG = PAYMENTS + """, first_payment AS (
  SELECT * FROM payments QUALIFY row_number() OVER (PARTITION BY order_id
    ORDER BY payment_sequential, payment_type, payment_installments) = 1),
payments_agg AS (
  SELECT p.order_id, CAST(SUM(p.payment_value) AS DOUBLE) AS total_payment,
         any_value(f.payment_installments) AS payment_installments,
         any_value(f.payment_type) AS payment_type
  FROM payments p JOIN first_payment f ON p.order_id = f.order_id GROUP BY p.order_id)"""

ITEMS_AGG = ITEMS + """, items_agg AS (
  SELECT order_id, COUNT(order_item_id) AS item_count,
         CAST(SUM(CAST(price AS DECIMAL(20,4))) AS DOUBLE) AS items_subtotal,
         CAST(SUM(CAST(freight_value AS DECIMAL(20,4))) AS DOUBLE) AS freight_total
  FROM items GROUP BY order_id)"""

PRIMARY = TRANSLATED + """, primary_category AS (
  SELECT order_id, category AS primary_category FROM (
    SELECT order_id, category, row_number() OVER (PARTITION BY order_id
             ORDER BY order_item_id, i.product_id) AS n
    FROM items i LEFT JOIN translated t ON i.product_id = t.product_id) WHERE n = 1)"""

FACT = "WITH " + ",\n".join(
    [ORDER_DATES, PAYMENTS_AGG, ITEMS_AGG, PRIMARY, CUSTOMERS]) + """, fact AS (
  SELECT o.*, c.customer_unique_id, c.city, c.state, p.total_payment, p.payment_installments,
         p.payment_type, i.item_count, i.items_subtotal, i.freight_total, g.primary_category
  FROM order_dates o
  LEFT JOIN customers_d c ON o.customer_id = c.customer_id
  LEFT JOIN payments_agg p ON o.order_id = p.order_id
  LEFT JOIN items_agg i ON o.order_id = i.order_id
  LEFT JOIN primary_category g ON o.order_id = g.order_id)"""


def _money(column: str) -> str:
    return f"CAST(SUM(CAST({column} AS DECIMAL(20,4))) AS DOUBLE)"


def _rounded(expression: str, digits: int) -> str:
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _mean(column: str) -> str:
    return (f"(CAST(SUM(CAST({column} AS DECIMAL(28,10))) AS DOUBLE)"
            f" / NULLIF(COUNT({column}), 0))")


MONTHLY = FACT + f""", monthly AS (
  SELECT purchase_year, purchase_month, state, {_money('total_payment')} AS revenue,
         COUNT(order_id) AS order_count,
         {_money('total_payment')} / NULLIF(COUNT(total_payment), 0) AS avg_order_value,
         CAST(SUM(item_count) AS BIGINT) AS total_items_sold,
         AVG(delivery_days) AS avg_delivery_days
  FROM fact WHERE order_status = 'delivered'
  GROUP BY purchase_year, purchase_month, state)"""

CATEGORY = FACT + f""", category AS (
  SELECT primary_category, {_money('total_payment')} AS revenue, COUNT(order_id) AS order_count,
         {_money('total_payment')} / NULLIF(COUNT(total_payment), 0) AS avg_order_value,
         AVG(delivery_days) AS avg_delivery_days, AVG(CAST(is_late AS INTEGER)) AS late_rate
  FROM fact WHERE order_status = 'delivered' GROUP BY primary_category)"""

BASE = FACT + f""", delivered AS (SELECT * FROM fact WHERE order_status = 'delivered'),
first_order AS (
  SELECT customer_unique_id, state, primary_category FROM delivered
  QUALIFY row_number() OVER (PARTITION BY customer_unique_id
    ORDER BY order_purchase_timestamp NULLS FIRST, order_id) = 1),
base AS (
  SELECT b.*, f.state, f.primary_category AS top_category FROM (
    SELECT customer_unique_id,
      CAST(date_diff('day', MAX(order_purchase_timestamp),
        (SELECT MAX(order_purchase_timestamp) FROM fact)) AS INTEGER) AS recency_days,
      COUNT(DISTINCT order_id) AS frequency, {_money('total_payment')} AS monetary,
      AVG(delivery_days) AS avg_delivery_days, AVG(CAST(is_late AS INTEGER)) AS late_rate
    FROM delivered GROUP BY customer_unique_id) b
  LEFT JOIN first_order f ON b.customer_unique_id IS NOT DISTINCT FROM f.customer_unique_id)"""

SCORED = BASE + """, scored AS (
  SELECT *,
    CAST(ntile(5) OVER (ORDER BY recency_days DESC NULLS LAST, customer_unique_id) AS INTEGER)
      AS r_score,
    CAST(ntile(5) OVER (ORDER BY frequency NULLS FIRST, customer_unique_id) AS INTEGER)
      AS f_score,
    CAST(ntile(5) OVER (ORDER BY monetary NULLS FIRST, customer_unique_id) AS INTEGER)
      AS m_score
  FROM base), rfm AS (
  SELECT *, r_score + f_score + m_score AS rfm_score,
    CASE WHEN r_score + f_score + m_score >= 13 THEN 'Champions'
         WHEN r_score + f_score + m_score >= 10 THEN 'Loyal Customers'
         WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
         WHEN r_score <= 2 AND f_score >= 4 THEN 'At Risk'
         WHEN r_score + f_score + m_score <= 5 THEN 'Lost'
         ELSE 'Potential Loyalists' END AS segment
  FROM scored)"""

RAW_COUNTS = {
    "orders": "SELECT COUNT(*) AS n FROM orders",
    "order_items": "SELECT COUNT(*) AS n FROM lineitem",
    "customers": "SELECT COUNT(*) AS n FROM customer",
    "products": "SELECT COUNT(*) AS n FROM part",
    "sellers": "SELECT COUNT(*) AS n FROM supplier",
    "order_payments": "SELECT COUNT(*) AS n FROM lineitem",
    "order_reviews": "SELECT COUNT(*) AS n FROM orders WHERE o_orderstatus = 'F'",
    "category_translation":
        "SELECT COUNT(DISTINCT p_type) AS n FROM part WHERE p_type NOT LIKE '%SMALL%'",
}

VIEW_COUNTS = {
    "gold_customer_rfm": "SELECT COUNT(*) AS n FROM rfm",
    "gold_monthly_revenue": """SELECT COUNT(*) AS n FROM (SELECT DISTINCT purchase_year,
        purchase_month, state FROM fact WHERE order_status = 'delivered')""",
    "gold_category_performance": """SELECT COUNT(*) AS n FROM (SELECT DISTINCT primary_category
        FROM fact WHERE order_status = 'delivered')""",
    "silver_orders_fact": "SELECT COUNT(*) AS n FROM fact",
    "bronze_orders": RAW_COUNTS["orders"],
    "bronze_order_items": RAW_COUNTS["order_items"],
    "bronze_customers": RAW_COUNTS["customers"],
    "bronze_products": RAW_COUNTS["products"],
    "bronze_sellers": RAW_COUNTS["sellers"],
    "bronze_payments": RAW_COUNTS["order_payments"],
    "bronze_reviews": RAW_COUNTS["order_reviews"],
    "bronze_category_translation": RAW_COUNTS["category_translation"],
}


def _counts(name: str, parts: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{key}' AS {name}, n AS row_count FROM ({text})" for key, text in parts.items())


# --- shipments ---------------------------------------------------------------
MESSAGES = """messages AS (
  SELECT *, event_id % 199 = 0 AS bad, event_id * 2 + copy AS "offset",
         ts + INTERVAL 1 SECOND AS kafka_ts, CAST(user_id % 6 AS INTEGER) AS "partition"
  FROM (SELECT *, 0 AS copy FROM events
        UNION ALL SELECT *, 1 AS copy FROM events WHERE event_id % 50 = 0))"""

SHIPMENT_FIELDS = {
    "shipment_id": "CASE WHEN event_id % 211 <> 0 THEN 'SHP-' || user_id END",
    "event_type": """CASE event_type WHEN 'signup' THEN 'PICKUP' WHEN 'view' THEN 'IN_TRANSIT'
        WHEN 'click' THEN 'OUT_FOR_DELIVERY' WHEN 'purchase' THEN 'DELIVERED'
        ELSE 'EXCEPTION' END""",
    "carrier_code": """CASE user_id % 4 WHEN 0 THEN 'FEDEX' WHEN 1 THEN 'UPS' WHEN 2 THEN 'DHL'
        ELSE 'USPS' END""",
    "service_type": """CASE WHEN event_id % 10 < 6 THEN 'STANDARD' WHEN event_id % 10 < 9
        THEN 'EXPRESS' ELSE 'OVERNIGHT' END""",
    "origin_wh": "'WH-' || (user_id % 6)",
    "dest_city": "'City-' || (event_id % 20)",
    "dest_country": "'US'",
    "weight_kg": "0.5::DOUBLE + (event_id % 400) / 10.0::DOUBLE",
    "latitude": "25.0::DOUBLE + (event_id % 240) / 10.0::DOUBLE",
    "longitude": """CASE WHEN event_id % 89 <> 0
        THEN -125.0::DOUBLE + (event_id % 601) / 10.0::DOUBLE END""",
    "delay_minutes": """CAST(CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 5 = 0
        THEN floor(value * 20) ELSE 0 END AS INTEGER)""",
    "notes": "CASE WHEN event_type = 'error' THEN 'reported by carrier' ELSE '' END",
}
ISO = "'%Y-%m-%dT%H:%M:%S.%f'"


def _fields(fields: dict[str, str]) -> str:
    return ",\n".join(f"CASE WHEN NOT bad THEN {text} END AS {name}"
                      for name, text in fields.items())


BRONZE = "WITH " + MESSAGES + f""", bronze AS (
  SELECT {_fields(SHIPMENT_FIELDS)},
    CASE WHEN NOT bad THEN strftime(ts + INTERVAL 2 DAY, {ISO}) END AS promised_eta,
    CASE WHEN NOT bad THEN strftime(ts, {ISO}) END AS event_ts,
    CASE WHEN bad THEN 'not json' END AS _corrupt_record,
    kafka_ts, "partition", "offset"
  FROM messages)"""

SILVER = "WITH " + MESSAGES + f""", typed AS (
  SELECT {_fields(SHIPMENT_FIELDS)}, ts + INTERVAL 2 DAY AS promised_eta, ts AS event_ts,
         kafka_ts, "partition", "offset"
  FROM messages),
silver AS (
  SELECT *, delay_minutes > sla_minutes AS sla_breached,
    CASE WHEN delay_minutes = 0 THEN 'NONE' WHEN delay_minutes < 60 THEN 'LOW'
         WHEN delay_minutes < 240 THEN 'MEDIUM' ELSE 'HIGH' END AS delay_severity,
    CASE WHEN longitude < -115 THEN 'West' WHEN longitude < -100 THEN 'Mountain'
         WHEN longitude < -85 THEN 'Central' ELSE 'East' END AS geo_region
  FROM (SELECT *, CAST(CASE service_type WHEN 'OVERNIGHT' THEN 12 WHEN 'EXPRESS' THEN 24
                       ELSE 48 END * 60 AS INTEGER) AS sla_minutes
        FROM typed WHERE shipment_id IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY shipment_id, event_ts ORDER BY "offset") = 1)"""

KPIS = SILVER + f""", kpis AS (
  SELECT carrier_code, time_bucket(INTERVAL 5 MINUTE, event_ts) AS window_start,
    time_bucket(INTERVAL 5 MINUTE, event_ts) + INTERVAL 5 MINUTE AS window_end,
    COUNT(*) AS total_events,
    CAST(SUM(CASE WHEN delay_minutes > 0 THEN 1 ELSE 0 END) AS BIGINT) AS delayed_events,
    {_rounded('AVG(delay_minutes)', 1)} AS avg_delay_minutes,
    {_rounded('CAST(SUM(CAST(sla_breached AS INTEGER)) AS DOUBLE) / COUNT(*)', 3)}
      AS sla_breach_rate,
    CAST(quantile_disc(delay_minutes, 0.95) AS INTEGER) AS p95_delay_minutes
  FROM silver GROUP BY ALL),
closed AS (
  SELECT * FROM kpis
  WHERE window_end <= (SELECT MAX(event_ts) - INTERVAL 10 MINUTE FROM silver))"""

ALERTS = SILVER + """, alerts AS (
  SELECT shipment_id, event_type, carrier_code, service_type, delay_minutes, delay_severity,
         sla_breached, origin_wh, dest_city, event_ts, notes
  FROM silver WHERE event_type = 'EXCEPTION' OR delay_severity = 'HIGH' OR sla_breached)"""

LATE = KPIS + """, middle AS (
  SELECT epoch_ms(CAST((epoch_ms(MIN(ts)) + epoch_ms(MAX(ts))) // 2 AS BIGINT)) AS t FROM events),
on_time AS (
  SELECT time_bucket(INTERVAL 5 MINUTE, event_ts) AS w, carrier_code, COUNT(*) AS n
  FROM silver, middle WHERE event_ts >= t GROUP BY ALL),
late AS (
  SELECT DISTINCT time_bucket(INTERVAL 5 MINUTE, event_ts) AS w, carrier_code
  FROM silver, middle WHERE event_ts < t)
SELECT COUNT(*) AS windows, CAST(SUM(n) AS BIGINT) AS events_on_time,
       (SELECT COUNT(*) FROM late) AS late_groups_dropped
FROM on_time WHERE w + INTERVAL 5 MINUTE <=
  (SELECT MAX(event_ts) - INTERVAL 10 MINUTE FROM silver)"""

CARRIERS = """SELECT
    CASE user_id % 4 WHEN 0 THEN 'FEDEX' WHEN 1 THEN 'UPS' WHEN 2 THEN 'DHL' ELSE 'USPS' END
      AS carrier_code,
    CASE event_id % 3 WHEN 0 THEN 'WEST' WHEN 1 THEN 'CENTRAL' ELSE 'EAST' END AS region,
    CAST(100 + event_id % 4900 AS INTEGER) AS active_shipments,
    0.75::DOUBLE + (event_id % 25) / 100.0::DOUBLE AS on_time_rate, value AS avg_delay_minutes,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS report_ts, CAST(NULL AS VARCHAR) AS _corrupt_record,
    ts + INTERVAL 1 SECOND AS kafka_ts
  FROM events"""

WAREHOUSES = """SELECT 'WH-' || (user_id % 6) AS warehouse_id,
    CASE event_id % 4 WHEN 0 THEN 'INBOUND' WHEN 1 THEN 'OUTBOUND' WHEN 2 THEN 'SCAN'
         ELSE 'HOLD' END AS operation,
    'SHP-' || user_id AS shipment_id, 'OP-' || (event_id % 50) AS operator_id,
    CAST(1 + event_id % 24 AS INTEGER) AS dock_door,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS op_ts, CAST(NULL AS VARCHAR) AS _corrupt_record,
    ts + INTERVAL 1 SECOND AS kafka_ts
  FROM events"""

# --- indicators --------------------------------------------------------------
INDICATORS = """WITH yearly AS (
  SELECT n_nationkey, n_name, CAST(year(o_orderdate) AS INTEGER) AS year,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(20,4))) AS DOUBLE) AS total,
         CAST(COUNT(*) AS DOUBLE) AS orders, MAX(o_orderdate) AS newest
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL),
long AS (
  SELECT n_nationkey, n_name, 'ORD.REV' AS indicator_code, 'Order revenue' AS indicator_name,
         year, total AS value, newest FROM yearly
  UNION ALL SELECT n_nationkey, n_name, 'ORD.CNT', 'Number of orders', year, orders, newest FROM yearly
  UNION ALL SELECT n_nationkey, n_name, 'ORD.AOV', 'Average order value', year, total / orders,
    newest FROM yearly
  UNION ALL SELECT n_nationkey, n_name, 'ORD.REV', 'Order revenue', 2002, NULL, NULL
  FROM nation WHERE n_nationkey % 7 = 0),
ind AS (
  SELECT 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS country_code,
         n_name AS country_name, indicator_code, indicator_name, year, value,
         CAST(newest AS TIMESTAMP) AS loaded_at
  FROM long),
filled AS (SELECT * FROM ind WHERE value IS NOT NULL),
shown AS (
  SELECT * FROM filled WHERE indicator_code = 'ORD.REV' AND year BETWEEN 1996 AND 2001
    AND country_name IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3', 'NATION_4', 'NATION_5',
                         'NATION_6', 'NATION_7')),
latest AS (SELECT * FROM shown WHERE year = (SELECT MAX(year) FROM shown))"""

YOY = INDICATORS + """, pair AS (
  SELECT l.country_name, l.year, l.value, p.value AS previous_value, l.value - p.value AS delta
  FROM latest l LEFT JOIN shown p ON l.country_name = p.country_name AND p.year = l.year - 1)
SELECT *, delta / NULLIF(previous_value, 0) * 100 AS delta_pct,
  CASE WHEN value >= 1e12 THEN printf('$%.2fT', value / 1e12)
       WHEN value >= 1e9 THEN printf('$%.2fB', value / 1e9)
       ELSE format('${:,.0f}', value) END AS value_text,
  COALESCE(CASE WHEN delta > 0 THEN '▲' ELSE '▼' END || ' '
    || printf('%.1f', abs(delta / NULLIF(previous_value, 0) * 100)) || '% YoY', '—')
    AS delta_text
FROM pair"""

SERIES = INDICATORS + """, pair AS (
  SELECT a.country_name, a.indicator_code, a.year, a.value, b.value AS previous_value,
         a.value - b.value AS delta
  FROM filled a LEFT JOIN filled b ON a.country_name = b.country_name
    AND a.indicator_code = b.indicator_code AND b.year = a.year - 1)
SELECT *, delta / NULLIF(previous_value, 0) * 100 AS delta_pct FROM pair"""

DISPLAY = """SELECT country_name AS "Country", year AS "Year", value AS "Revenue",
  indicator_name AS "Indicator" FROM """

ORACLE = {
    # raw layer and files
    "csv_bronze_roundtrip": f"WITH {ITEMS} SELECT * FROM items",
    "bronze_row_counts": _counts("table_name", RAW_COUNTS),
    "layer_view_counts": SCORED + _counts("view_name", VIEW_COUNTS),
    # orders
    "order_timestamps": f"""WITH {ORDERS} SELECT order_id, order_purchase_timestamp,
        order_approved_at, order_delivered_carrier_date, order_delivered_customer_date,
        order_estimated_delivery_date FROM orders_d""",
    "order_dates": f"""WITH {ORDER_DATES} SELECT order_id, delivery_days, is_late, purchase_year,
        purchase_month, purchase_quarter FROM order_dates""",
    "customers_slim": f"WITH {CUSTOMERS} SELECT * FROM customers_d",
    "products_translated": f"WITH {TRANSLATED} SELECT * FROM translated",
    "payments_agg": f"WITH {PAYMENTS_AGG} SELECT * FROM payments_agg",
    "items_agg": f"WITH {ITEMS_AGG} SELECT * FROM items_agg",
    "primary_category": f"WITH {ITEMS}, {PRIMARY} SELECT * FROM primary_category",
    "orders_fact": FACT + "SELECT * FROM fact",
    "orders_fact_partition_pruned": FACT + """SELECT order_id, purchase_year, purchase_month,
        total_payment, primary_category FROM fact
        WHERE purchase_year = 1997 AND purchase_month <= 6""",
    "orders_fact_bucketed": FACT + "SELECT * FROM fact",
    "csv_quarantine": f"""WITH {ITEMS} SELECT order_id, order_item_id, product_id, seller_id,
        CASE WHEN order_id % 13 <> 0 THEN price END AS price,
        CASE WHEN order_id % 17 <> 0 THEN freight_value END AS freight_value,
        CASE WHEN order_id % 17 = 0 THEN 'cells' WHEN order_id % 13 = 0 THEN 'value' END AS reason
        FROM items""",
    # customers and revenue
    "customer_base": BASE + "SELECT * FROM base",
    "rfm_scores": SCORED + """SELECT customer_unique_id, recency_days, frequency, monetary,
        r_score, f_score, m_score FROM scored""",
    "customer_rfm": SCORED + "SELECT * FROM rfm",
    "monthly_revenue": MONTHLY + "SELECT * FROM monthly",
    "category_performance": CATEGORY + "SELECT * FROM category",
    "report_segments": SCORED + f"""SELECT segment, COUNT(*) AS customers,
        {_rounded(_mean('recency_days'), 1)} AS avg_recency_days,
        {_rounded(_mean('frequency'), 2)} AS avg_orders,
        {_rounded(_mean('monetary'), 2)} AS avg_spend_brl,
        {_rounded(_mean('late_rate') + ' * 100', 1)} AS late_delivery_pct
        FROM rfm GROUP BY segment""",
    "report_top_customers": SCORED + f"""SELECT customer_unique_id, segment, recency_days,
        frequency, {_rounded('monetary', 2)} AS monetary_brl, r_score, f_score, m_score,
        rfm_score, state, top_category
        FROM rfm ORDER BY rfm_score DESC, customer_unique_id LIMIT 20""",
    "report_monthly": MONTHLY + f"""SELECT purchase_year, purchase_month,
        {_rounded('SUM(CAST(revenue AS DECIMAL(28,4)))', 2)} AS total_revenue_brl,
        CAST(SUM(order_count) AS BIGINT) AS total_orders,
        {_rounded(_mean('avg_order_value'), 2)} AS avg_order_value_brl,
        CAST(SUM(total_items_sold) AS BIGINT) AS items_sold
        FROM monthly GROUP BY purchase_year, purchase_month""",
    "report_top_state_months": MONTHLY + f"""SELECT purchase_year, purchase_month, state,
        {_rounded('revenue', 2)} AS revenue_brl, order_count,
        {_rounded('avg_order_value', 2)} AS avg_order_value_brl,
        {_rounded('avg_delivery_days', 1)} AS avg_delivery_days FROM monthly
        ORDER BY revenue_brl DESC NULLS LAST, purchase_year, purchase_month, state LIMIT 20""",
    "report_categories": CATEGORY + f"""SELECT primary_category,
        {_rounded('revenue', 2)} AS revenue_brl, order_count,
        {_rounded('avg_order_value', 2)} AS avg_order_value_brl,
        {_rounded('avg_delivery_days', 1)} AS avg_delivery_days,
        {_rounded('late_rate * 100', 1)} AS late_delivery_pct FROM category""",
    "adhoc_segment_revenue": SCORED + f"""SELECT segment, COUNT(*) AS customers,
        {_rounded(_mean('monetary'), 2)} AS avg_spend_brl,
        {_rounded(_mean('recency_days'), 1)} AS avg_recency_days FROM rfm GROUP BY segment""",
    "adhoc_gmv_trend": MONTHLY + f"""SELECT purchase_year, purchase_month,
        {_rounded('SUM(CAST(revenue AS DECIMAL(28,4)))', 2)} AS total_revenue_brl,
        CAST(SUM(order_count) AS BIGINT) AS total_orders
        FROM monthly GROUP BY purchase_year, purchase_month""",
    "adhoc_top10_categories": CATEGORY + f"""SELECT primary_category,
        {_rounded('revenue', 2)} AS revenue_brl, order_count,
        {_rounded('late_rate * 100', 1)} AS late_pct FROM category
        ORDER BY revenue_brl DESC NULLS LAST, primary_category NULLS FIRST LIMIT 10""",
    # shipments
    "bronze_shipments": BRONZE + "SELECT * FROM bronze",
    "stream_bronze_shipments": BRONZE + "SELECT * FROM bronze",
    "bronze_carriers": CARRIERS,
    "bronze_warehouses": WAREHOUSES,
    "quarantined_events": BRONZE + """SELECT _corrupt_record, kafka_ts, "partition", "offset"
        FROM bronze WHERE _corrupt_record IS NOT NULL""",
    "silver_shipments": SILVER + "SELECT * FROM silver",
    "stream_silver_shipments": SILVER + """SELECT * EXCLUDE ("offset") FROM silver""",
    "stream_dedup": SILVER + "SELECT shipment_id, event_ts, event_type FROM silver",
    "severity_distribution":
        SILVER + "SELECT delay_severity, COUNT(*) AS events FROM silver GROUP BY ALL",
    "geo_region_counts": SILVER + "SELECT geo_region, COUNT(*) AS events FROM silver GROUP BY ALL",
    "carrier_kpis": KPIS + "SELECT * FROM kpis",
    "stream_carrier_kpis": KPIS + "SELECT * FROM closed",
    "stream_restart": KPIS + "SELECT * FROM closed",
    "stream_late_events": LATE,
    "stream_complete_counts": BRONZE + """SELECT carrier_code, event_type, COUNT(*) AS events
        FROM bronze GROUP BY ALL""",
    "active_alerts": ALERTS + "SELECT * FROM alerts",
    "stream_alerts": ALERTS + "SELECT * FROM alerts",
    "alert_summary": ALERTS + """SELECT carrier_code, delay_severity, COUNT(*) AS alert_count
        FROM alerts GROUP BY ALL""",
    "alerts_topk": ALERTS + """SELECT * REPLACE (COALESCE(delay_minutes, 0) AS delay_minutes,
        COALESCE(sla_breached, FALSE) AS sla_breached, CAST(event_ts AS VARCHAR) AS event_ts)
        FROM (SELECT * FROM alerts WHERE carrier_code = 'FEDEX' AND delay_severity = 'HIGH'
              ORDER BY event_ts DESC, shipment_id LIMIT 50)""",
    "kpi_lookback": KPIS + """SELECT carrier_code, CAST(window_start AS VARCHAR) AS window_start,
        CAST(window_end AS VARCHAR) AS window_end, total_events, delayed_events,
        COALESCE(avg_delay_minutes, 0) AS avg_delay_minutes,
        COALESCE(sla_breach_rate, 0) AS sla_breach_rate,
        COALESCE(CAST(p95_delay_minutes AS DOUBLE), 0) AS p95_delay_minutes
        FROM kpis WHERE carrier_code = 'UPS' AND window_start >= TIMESTAMP '2024-01-14 12:00:00'""",
    "stored_alerts": ALERTS + """SELECT * REPLACE (COALESCE(delay_minutes, 0) AS delay_minutes,
        COALESCE(sla_breached, FALSE) AS sla_breached, CAST(event_ts AS VARCHAR) AS event_ts),
        CAST(event_ts + INTERVAL 1 MINUTE AS VARCHAR) AS alert_generated_at
        FROM (SELECT * FROM alerts WHERE carrier_code = 'DHL' AND delay_severity = 'HIGH'
              ORDER BY event_ts DESC, shipment_id LIMIT 100)""",
    "stored_kpis": KPIS + """SELECT carrier_code, CAST(window_start AS VARCHAR) AS window_start,
        CAST(window_end AS VARCHAR) AS window_end, total_events, delayed_events,
        COALESCE(avg_delay_minutes, 0) AS avg_delay_minutes,
        COALESCE(sla_breach_rate, 0) AS sla_breach_rate,
        COALESCE(CAST(p95_delay_minutes AS DOUBLE), 0) AS p95_delay_minutes
        FROM kpis WHERE carrier_code = 'FEDEX' AND window_start >= TIMESTAMP '2024-01-19 12:00:00'""",
    "carrier_kpis_hourly": KPIS.replace("INTERVAL 5 MINUTE", "INTERVAL 1 HOUR") + "SELECT * FROM kpis",
    "stream_quarantine": BRONZE + """SELECT shipment_id, _corrupt_record, kafka_ts, "partition", "offset"
        FROM bronze""",
    "stream_late_rows": SILVER + """, middle AS (
        SELECT epoch_ms(CAST((epoch_ms(MIN(ts)) + epoch_ms(MAX(ts))) // 2 AS BIGINT)) AS t FROM events),
      mark AS (SELECT MAX(event_ts) - INTERVAL 10 MINUTE AS watermark FROM silver, middle WHERE event_ts >= t)
      SELECT shipment_id, event_ts, carrier_code,
        CASE WHEN event_ts < t AND event_ts < watermark THEN watermark END AS watermark
      FROM silver, middle, mark""",
    "stream_schema_evolution": """SELECT event_id, ts, event_type,
        CASE WHEN event_type NOT IN ('signup', 'view') THEN value END AS value FROM events""",
    # indicators
    "indicator_flatten": INDICATORS + """SELECT * REPLACE (
        CASE WHEN CAST(substr(country_code, 2, 2) AS INTEGER) % 5 = 0 THEN '' ELSE country_code END
          AS country_code, TIMESTAMP '2024-01-01 00:00:00' AS loaded_at) FROM filled""",
    "indicator_scan": INDICATORS + "SELECT * FROM filled",
    "indicator_load": INDICATORS + "SELECT * FROM ind",
    "indicator_layout_identity": INDICATORS + "SELECT * FROM ind",
    "indicator_preview": INDICATORS + """SELECT * FROM filled
        QUALIFY row_number() OVER (PARTITION BY indicator_code
          ORDER BY year DESC, country_name, country_code, value) <= 3""",
    "indicator_subset": INDICATORS + "SELECT * FROM filled WHERE indicator_code = 'ORD.REV'",
    "indicator_slice": INDICATORS + "SELECT * FROM shown WHERE year <= 2000",
    "indicator_facets": INDICATORS + """SELECT 'indicator' AS facet, indicator_code AS choice
        FROM filled GROUP BY ALL
        UNION ALL SELECT 'country', country_name FROM filled GROUP BY ALL
        UNION ALL SELECT 'first_year', CAST(MIN(year) AS VARCHAR) FROM filled
        UNION ALL SELECT 'last_year', CAST(MAX(year) AS VARCHAR) FROM filled""",
    "formatted_values": INDICATORS + """SELECT country_name, indicator_code, year,
        CASE WHEN v >= 1e12 THEN printf('$%.2fT', v / 1e12)
             WHEN v >= 1e9 THEN printf('$%.2fB', v / 1e9)
             ELSE format('${:,.0f}', v) END AS as_money,
        printf('%.2f%%', v) AS as_percent
        FROM (SELECT *, value * 1000 AS v FROM filled)""",
    "last_updated": INDICATORS + """SELECT
        COALESCE(strftime(MAX(loaded_at), '%d %b %Y %H:%M UTC'), 'Unknown') AS last_updated
        FROM ind""",
    "load_summary": INDICATORS + """SELECT key, code AS indicator_code,
        COUNT(f.indicator_code) AS rows_loaded
        FROM (VALUES ('REV', 'ORD.REV'), ('CNT', 'ORD.CNT'), ('AOV', 'ORD.AOV'),
                     ('RET', 'ORD.RET')) AS r(key, code)
        LEFT JOIN filled f ON f.indicator_code = r.code GROUP BY key, code""",
    "indicator_partial_reload": INDICATORS + """SELECT * REPLACE (
        CASE WHEN indicator_code = 'ORD.REV' THEN value + 1 ELSE value END AS value) FROM ind""",
    "indicator_job": INDICATORS + """SELECT * REPLACE (
        CASE WHEN CAST(substr(country_code, 2, 2) AS INTEGER) % 5 = 0 THEN '' ELSE country_code END
          AS country_code, TIMESTAMP '2024-01-01 00:00:00' AS loaded_at) FROM filled""",
    "payload_files_incremental": INDICATORS + """SELECT * REPLACE (
        CASE WHEN CAST(substr(country_code, 2, 2) AS INTEGER) % 5 = 0 THEN '' ELSE country_code END
          AS country_code, TIMESTAMP '2024-01-01 00:00:00' AS loaded_at,
        CASE WHEN year >= 1997 THEN value + 1000 ELSE value END AS value) FROM filled""",
    "latest_snapshot":
        INDICATORS + "SELECT country_name, country_code, year, value FROM latest",
    "compare_latest":
        INDICATORS + "SELECT country_name, country_code, year, value FROM latest",
    "yoy_snapshot": YOY,
    "yoy_series": SERIES,
    "pivot_recent_years": INDICATORS + "SELECT country_name, " + ", ".join(
        f'AVG(CASE WHEN year = {y} THEN value END) AS "{y}"' for y in range(1996, 2002)
    ) + " FROM shown GROUP BY country_name",
    "trend_series":
        INDICATORS + "SELECT country_name, indicator_code, year, value FROM shown",
    "display_table": INDICATORS + DISPLAY + "shown",
    "csv_export_roundtrip": INDICATORS + DISPLAY + "filled",
    # evolution and upkeep
    "schema_evolution_union": """SELECT event_id, ts, event_type,
        CASE WHEN event_type NOT IN ('signup', 'view') THEN value END AS value FROM events""",
    "compact_identity": SILVER + "SELECT * FROM silver",
    "compact_small_files": SILVER + "SELECT * FROM silver",
    "zorder_file_pruning": SILVER + """SELECT * FROM silver WHERE carrier_code = 'UPS'
        AND event_ts BETWEEN TIMESTAMP '2024-01-09' AND TIMESTAMP '2024-01-12'""",
    "zorder_identity": SILVER + "SELECT * FROM silver",
    "table_inventory": ALERTS + """SELECT 'bronze/shipments' AS table_name, TRUE AS found,
        COUNT(*) AS row_count, MAX(kafka_ts) AS newest, 'degraded' AS status FROM messages
        UNION ALL SELECT 'silver/shipments', TRUE, COUNT(*), MAX(event_ts), 'degraded' FROM silver
        UNION ALL SELECT 'gold/alerts', TRUE, COUNT(*), MAX(event_ts), 'degraded' FROM alerts
        UNION ALL SELECT 'gold/carrier_kpis', FALSE, 0, NULL, 'degraded'""",
}
