import pytest
from pyspark.sql import functions as F

from tierflow.operators.customers import customer_base, customer_rfm, segment
from tierflow.operators.orders import (add_order_dates, items_per_order, orders_fact,
                                       payments_per_order, primary_category,
                                       products_translated, top_category)
from tierflow.operators.revenue import category_performance, monthly_revenue
from tierflow.plans import reports
from tierflow.schemas import ORDER_TIMES

ORDER = ("order_id string, customer_id string, order_status string, "
         + ", ".join(f"{c} string" for c in ORDER_TIMES))


@pytest.fixture
def order(frame):
    def build(order_id="o1", bought="2018-01-01 10:00:00", arrived="2018-01-06 09:00:00",
              promised="2018-01-08 00:00:00", customer="c1", status="delivered"):
        return frame(ORDER, (order_id, customer, status, bought, None, None, arrived, promised))

    return build


def test_delivery_days(order):
    assert add_order_dates(order()).first().delivery_days == 5


@pytest.mark.parametrize("arrived, late", [("2018-01-06 00:00:00", False),
                                           ("2018-01-10 00:00:00", True), (None, None),
                                           ("unknown", None)])
def test_late_flag(order, arrived, late):
    assert add_order_dates(order(arrived=arrived)).first().is_late is late


def test_orders_without_id_are_dropped(order):
    assert add_order_dates(order().unionAll(order(order_id=None))).count() == 1


def test_calendar_columns(order):
    row = add_order_dates(order(bought="2018-06-15 00:00:00")).first()
    assert (row.purchase_year, row.purchase_month, row.purchase_quarter) == (2018, 6, 2)


@pytest.fixture
def tables(frame, order):
    orders = (order("o1", customer="c1").unionAll(order("o2", customer="c2", status="shipped"))
              .unionAll(order("o3", customer="nobody")))
    items = frame("order_id string, order_item_id int, product_id string, price double,"
                  " freight_value double",
                  ("o1", 2, "p1", 0.1, 1.0), ("o1", 1, "p2", 0.2, 1.0), ("o1", 3, "p1", 0.3, 1.0),
                  ("o2", 1, "p3", 5.0, 0.5))
    payments = frame("order_id string, payment_sequential int, payment_type string,"
                     " payment_installments int, payment_value double",
                     ("o1", 2, "voucher", 1, 0.1), ("o1", 1, "boleto", 4, 0.2),
                     ("o2", 1, "card", 2, 5.5))
    customers = frame("customer_id string, customer_unique_id string, customer_city string,"
                      " customer_state string", ("c1", "u1", "Rio", "RJ"), ("c2", "u2", "SP", "SP"))
    products = frame("product_id string, product_category_name string",
                     ("p1", "moveis"), ("p2", "raro"), ("p3", None))
    translation = frame("product_category_name string, product_category_name_english string",
                        ("moveis", "furniture"))
    return orders, items, customers, payments, products, translation


def test_first_payment_and_exact_sum(tables):
    row = payments_per_order(tables[3]).filter("order_id = 'o1'").first()
    assert (row.total_payment, row.payment_type, row.payment_installments) == (0.3, "boleto", 4)


def test_item_totals(tables):
    row = items_per_order(tables[1]).filter("order_id = 'o1'").first()
    assert (row.item_count, row.items_subtotal, row.freight_total) == (3, 0.6, 3.0)


def test_categories(tables):
    english = products_translated(tables[4], tables[5])
    assert {r.product_id: r.category for r in english.collect()} == {
        "p1": "furniture", "p2": None, "p3": None}
    first = {r.order_id: r.primary_category for r in primary_category(tables[1], english).collect()}
    assert first == {"o1": None, "o2": None}  # the first item decides, even without category
    top = {r.order_id: r.primary_category for r in top_category(tables[1], english).collect()}
    assert top["o1"] == "furniture"


def test_fact_has_one_row_per_order(tables):
    rows = {r.order_id: r for r in orders_fact(*tables).collect()}
    assert sorted(rows) == ["o1", "o2", "o3"]
    assert rows["o1"].state == "RJ" and rows["o1"].item_count == 3
    assert rows["o3"].customer_unique_id is None and rows["o3"].total_payment is None


FACT = ("order_id string, customer_unique_id string, order_status string,"
        " order_purchase_timestamp timestamp, total_payment double, delivery_days int,"
        " is_late boolean, state string, primary_category string, purchase_year int,"
        " purchase_month int, item_count bigint")


@pytest.fixture
def fact(spark, frame):
    return frame(FACT.replace("timestamp timestamp", "timestamp string"),
                 ("o1", "u1", "delivered", "2018-01-01", 10.0, 5, False, "RJ", "toys", 2018, 1, 1),
                 ("o2", "u1", "delivered", "2018-01-05", 20.0, 7, True, "SP", None, 2018, 1, 2),
                 ("o3", "u2", "delivered", "2018-02-01", None, None, None, "SP", "toys", 2018, 2,
                  None),
                 ("o4", "u3", "shipped", "2018-03-01", 99.0, None, None, "SP", "toys", 2018, 3, 1)
                 ).withColumn("order_purchase_timestamp",
                              F.col("order_purchase_timestamp").cast("timestamp"))


def test_customer_base(fact):
    rows = {r.customer_unique_id: r for r in customer_base(fact).collect()}
    assert sorted(rows) == ["u1", "u2"]  # delivered orders only ...
    assert rows["u1"].recency_days == 55  # ... but recency counts from the newest of all orders
    assert (rows["u1"].frequency, rows["u1"].monetary, rows["u1"].late_rate) == (2, 30.0, 0.5)
    assert (rows["u1"].state, rows["u1"].top_category) == ("RJ", "toys")
    assert rows["u2"].monetary is None


def test_revenue_tables(fact):
    month = monthly_revenue(fact).filter("state = 'SP' AND purchase_month = 1").first()
    assert (month.revenue, month.order_count, month.total_items_sold) == (20.0, 1, 2)
    rows = {r.primary_category: r for r in category_performance(fact).collect()}
    assert rows["toys"].order_count == 2 and rows["toys"].avg_order_value == 10.0
    assert rows[None].late_rate == 1.0


def test_rfm_and_reports(fact):
    rfm = customer_rfm(fact)
    rows = {r.customer_unique_id: r for r in rfm.collect()}
    assert (rows["u1"].r_score, rows["u1"].f_score, rows["u1"].m_score) == (1, 2, 2)
    assert (rows["u2"].r_score, rows["u2"].f_score, rows["u2"].m_score) == (2, 1, 1)
    assert rows["u1"].segment == "Lost"
    assert reports.report_segments(rfm).first().customers == 2
    assert [r.customer_unique_id for r in reports.report_top_customers(rfm, 1).collect()] == ["u1"]
    assert [r.purchase_month for r in reports.report_monthly(monthly_revenue(fact)).collect()] == [1, 2]


@pytest.mark.parametrize("r, f, total, name", [
    (5, 4, 13, "Champions"), (4, 2, 11, "Loyal Customers"), (4, 2, 9, "New Customers"),
    (2, 4, 8, "At Risk"), (1, 1, 5, "Lost"), (3, 3, 8, "Potential Loyalists"),
    (4, 1, 6, "New Customers")])
def test_segment_rules(spark, r, f, total, name):
    got = spark.range(1).select(segment(F.lit(r), F.lit(f), F.lit(total)).alias("s")).first()
    assert got.s == name
