import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import gold, payments

ORDERS = (
    "order_id string, customer_id string, order_purchase_ts timestamp,"
    " is_delivered int, event_date date"
)
PAYMENTS = (
    "order_id string, payment_sequential_int int, payment_value_amount double,"
    " is_high_value_payment int"
)
ITEMS = "order_id string, product_id string, price_amount double"


def order(order_id, customer, day=1, hour=10, delivered=0):
    stamp = datetime(2018, 1, day, hour, 30)
    return (order_id, customer, stamp, delivered, stamp.date())


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            order("o1", "c1", delivered=1),
            order("o2", "c1", hour=11),
            order("o3", "c2"),
            order("o4", "c3", day=2),
        ],
        ORDERS,
    )


@pytest.fixture
def paid(spark):
    return spark.createDataFrame(
        [
            ("o1", 1, 600.0, 1),
            ("o1", 2, 0.1, 0),
            ("o1", 2, 0.2, 0),
            ("o2", 1, 0.0, 0),
            ("o3", None, 5.0, 0),
            ("lost", 1, 99.0, 0),
        ],
        PAYMENTS,
    )


@pytest.mark.parametrize("exact", [False, True])
def test_payments_by_order(paid, rows_of, exact):
    assert [tuple(r.values()) for r in rows_of(payments.payments_by_order(paid, exact))] == [
        ("lost", 1, 99.0, 0),
        ("o1", 3, 600.3, 1),
        ("o2", 1, 0.0, 0),
        ("o3", 1, 5.0, 0),
    ]


def test_three_ways_to_have_a_payment(orders, paid, rows_of):
    """o1 paid twice, o2 paid zero, o3 paid without a sequence, o4 did not pay."""
    by_record = payments.orders_with_payments(orders, payments.payments_by_order(paid))
    by_value = payments.payment_facts_by_order(paid)
    by_number = payments.sequenced_payments_by_order(paid)

    def flags(frame):
        return {r["order_id"]: r["has_payment"] for r in rows_of(frame, "order_id", "has_payment")}

    assert flags(by_record) == {"o1": 1, "o2": 1, "o3": 1, "o4": 0}
    assert flags(by_value) == {"o1": 1, "o2": 0, "o3": 1, "lost": 1}
    assert flags(by_number) == {"o1": 1, "o2": 1, "o3": 0, "lost": 1}
    counts = {r["order_id"]: r["payment_count"] for r in rows_of(by_value, "order_id", "payment_count")}
    assert counts == {"o1": 2, "o2": 1, "o3": 0, "lost": 1}


def test_orders_without_payment_are_filled(orders, paid, rows_of):
    enriched = payments.orders_with_payments(orders, payments.payments_by_order(paid))
    assert enriched.count() == 4
    row = enriched.filter("order_id = 'o4'").first()
    assert (row.payment_record_count, row.payment_total_value, row.has_high_value_payment) == (
        0,
        0.0,
        0,
    )


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("unique", [False, True])
def test_daily_orders_payments_summary(orders, paid, exact, unique):
    enriched = payments.orders_with_payments(orders, payments.payments_by_order(paid, exact))
    days = gold.daily_orders_payments_summary(enriched, exact, unique).collect()
    assert [tuple(day) for day in days] == [
        (date(2018, 1, 1), 3, 2, 3, 605.3, 1, 1, 1.0),
        (date(2018, 1, 2), 1, 1, 0, 0.0, 0, 0, 0.0),
    ]


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("unique", [False, True])
def test_daily_sales_summary(orders, paid, rows_of, exact, unique):
    days = rows_of(gold.daily_sales_summary(orders, paid, exact, unique))
    assert [tuple(day.values()) for day in days] == [
        (date(2018, 1, 1), 3, 2, 2, 605.3, 201.77, 2, 1, 0.6667, 0.3333, 2018, 1),
        (date(2018, 1, 2), 1, 1, 1, 0.0, 0.0, 0, 0, 0.0, 0.0, 2018, 1),
    ]


@pytest.mark.parametrize("exact", [False, True])
def test_an_order_with_a_nan_payment_counts_as_zero_revenue(spark, orders, exact):
    paid = spark.createDataFrame([("o4", 1, math.nan, 0), ("o4", 2, 3.0, 0)], PAYMENTS)
    days = gold.daily_sales_summary(orders, paid, exact).filter("event_date = '2018-01-02'")
    row = days.first()
    assert (row.total_revenue, row.orders_with_payment) == (0.0, 1)


def test_counting_distinct_ids_without_a_unique_key(spark, rows_of):
    """A repeated order counts once, but its flags are added per row."""
    orders = spark.createDataFrame(
        [order("o1", "c1", delivered=1), order("o1", "c1", delivered=1), order("o2", None)], ORDERS
    )
    paid = spark.createDataFrame([("o1", 1, 10.0, 0)], PAYMENTS)
    day = gold.daily_sales_summary(orders, paid, unique_orders=False).first()
    assert (day.order_count, day.unique_customer_count, day.delivered_order_count) == (2, 1, 2)
    assert (day.total_revenue, day.avg_revenue_per_order) == (20.0, 6.67)
    hour = gold.hourly_order_summary(orders, unique_orders=False).first()
    assert (hour.order_count, hour.unique_customer_count) == (2, 1)


@pytest.mark.parametrize("unique", [False, True])
def test_hourly_order_summary(orders, rows_of, unique):
    untimed = orders.limit(1).withColumn("order_purchase_ts", F.lit(None).cast("timestamp"))
    hours = rows_of(gold.hourly_order_summary(orders.union(untimed), unique))
    assert [tuple(hour.values()) for hour in hours] == [
        (datetime(2018, 1, 1, 10), date(2018, 1, 1), 10, 2, 2, 2, 2018, 1),
        (datetime(2018, 1, 1, 11), date(2018, 1, 1), 11, 1, 1, 1, 2018, 1),
        (datetime(2018, 1, 2, 10), date(2018, 1, 2), 10, 1, 1, 1, 2018, 1),
    ]


@pytest.mark.parametrize("unique", [False, True])
def test_orders_by_city_day(spark, orders, rows_of, unique):
    customers = spark.createDataFrame(
        [("c1", "recife", "PE"), ("c2", None, "SP")],
        "customer_id string, customer_city string, customer_state string",
    )
    cities = rows_of(gold.orders_by_city_day(orders, customers, unique))
    assert [tuple(city.values()) for city in cities] == [
        (date(2018, 1, 1), "recife", "PE", 2, 1, 2018, 1),
        (date(2018, 1, 1), "unknown", "SP", 1, 1, 2018, 1),
        (date(2018, 1, 2), "unknown", "unknown", 1, 1, 2018, 1),
    ]


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("unique", [False, True])
def test_payment_ratio_by_day(orders, paid, rows_of, exact, unique):
    days = rows_of(gold.payment_ratio_by_day(orders, paid, exact, unique))
    assert [tuple(day.values()) for day in days] == [
        (date(2018, 1, 1), 3, 2, 0.6667, 2018, 1),
        (date(2018, 1, 2), 1, 0, 0.0, 2018, 1),
    ]


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("unique", [False, True])
def test_top_products_rank_by_revenue_then_id(spark, orders, rows_of, exact, unique):
    items = spark.createDataFrame(
        [
            ("o1", "p1", 10.0),
            ("o1", "p1", 0.1),
            ("o2", "p1", 0.2),
            ("o2", "p3", 7.0),
            ("o3", "p2", 7.0),
            ("o4", "p9", 1.0),
            ("lost", "p9", 1000.0),
        ],
        ITEMS,
    )
    top = gold.top_products_by_day(orders, items, k=2, exact_cents=exact, unique_orders=unique)
    columns = ("event_date", "rank_in_day", "product_id", "order_count", "product_revenue")
    assert [tuple(r.values()) for r in rows_of(top, *columns)] == [
        (date(2018, 1, 1), 1, "p1", 2, 10.3),
        (date(2018, 1, 1), 2, "p2", 1, 7.0),
        (date(2018, 1, 2), 1, "p9", 1, 1.0),
    ]


def test_ten_products_by_default(spark, orders):
    items = spark.createDataFrame([("o1", f"p{i}", float(i)) for i in range(12)], ITEMS)
    top = gold.top_products_by_day(orders, items)
    assert sorted(r.product_revenue for r in top.collect()) == [float(i) for i in range(2, 12)]
