"""A third of all rows under one key gives the same results as brute force."""

from collections import defaultdict
from datetime import datetime

import pyarrow as pa
import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.functions.best import keep_best
from millrace.functions.dedup import keep_one
from millrace.operators import gold, payments
from millrace.sources.session import session_settings

ROWS = 3000


@pytest.fixture
def hot(spark):
    """Orders, payments and items where one customer, one order, one product and one
    day each hold a third of the rows."""
    orders = [
        (
            f"o{i}",
            "hot" if i % 3 == 0 else f"c{i % 97}",
            datetime(2018, 1, 1 if i % 3 == 1 else 2 + i % 20, i % 24),
            i % 2,
        )
        for i in range(ROWS)
    ]
    lines = [
        (
            "o1" if i % 3 == 0 else f"o{i % ROWS}",
            i,
            "hot" if i % 3 == 1 else f"p{i % 211}",
            (i % 1000) / 100,
        )
        for i in range(2 * ROWS)
    ]
    return orders, lines


def test_daily_sales(spark, hot):
    orders, lines = hot
    revenue, any_paid = defaultdict(int), defaultdict(int)
    for order, _, _, value in lines:
        revenue[order] += round(value * 100)
        any_paid[order] |= value > 0
    expected = defaultdict(lambda: [0, set(), 0, 0, 0])
    for order, customer, stamp, delivered in orders:
        day = expected[stamp.date()]
        day[0] += 1
        day[1].add(customer)
        day[2] += revenue[order]
        day[3] += any_paid[order]
        day[4] += delivered
    staged = spark.createDataFrame(
        orders, "order_id string, customer_id string, order_purchase_ts timestamp, is_delivered int"
    ).selectExpr("*", "date(order_purchase_ts) as event_date")
    paid = spark.createDataFrame(
        lines,
        "order_id string, payment_sequential_int int, p string, payment_value_amount double",
    )
    days = gold.daily_sales_summary(staged, paid, exact_cents=True).collect()
    assert len(days) == len(expected)
    for row in days:
        count, customers, cents, with_payment, delivered = expected[row.event_date]
        assert row.order_count == count
        assert row.unique_customer_count == len(customers)
        assert row.total_revenue == cents / 100
        assert row.avg_revenue_per_order == ((2 * cents + count) // (2 * count)) / 100
        assert row.orders_with_payment == with_payment
        assert row.delivered_order_count == delivered


def test_top_products(spark, hot):
    orders, lines = hot
    day_of = {order: stamp.date() for order, _, stamp, _ in orders}
    revenue, in_orders = defaultdict(int), defaultdict(set)
    for order, _, product, value in lines:
        key = (day_of[order], product)
        revenue[key] += round(value * 100)
        in_orders[key].add(order)
    expected = set()
    for day in set(day_of.values()):
        ranked = sorted(
            (product for d, product in revenue if d == day),
            key=lambda product: (-revenue[day, product], product),
        )
        for rank, product in enumerate(ranked[:10], 1):
            key = (day, product)
            expected.add((day, product, len(in_orders[key]), revenue[key] / 100, rank))
    staged = spark.createDataFrame(
        [(order, stamp) for order, _, stamp, _ in orders], "order_id string, ts timestamp"
    ).selectExpr("order_id", "date(ts) as event_date")
    items = spark.createDataFrame(
        lines, "order_id string, n int, product_id string, price_amount double"
    )
    top = gold.top_products_by_day(staged, items, exact_cents=True).select(
        "event_date", "product_id", "order_count", "product_revenue", "rank_in_day"
    )
    assert {tuple(row) for row in top.collect()} == expected


def test_cities(spark, hot):
    orders, _ = hot
    expected = defaultdict(lambda: [0, set()])
    for _, customer, stamp, _ in orders:
        city = "hotville" if customer == "hot" else "unknown"
        expected[stamp.date(), city][0] += 1
        expected[stamp.date(), city][1].add(customer)
    staged = spark.createDataFrame(
        [(order, customer, stamp) for order, customer, stamp, _ in orders],
        "order_id string, customer_id string, ts timestamp",
    ).selectExpr("order_id", "customer_id", "date(ts) as event_date")
    customers = spark.createDataFrame(
        [("hot", "hotville", None)],
        "customer_id string, customer_city string, customer_state string",
    )
    cities = gold.orders_by_city_day(staged, customers).collect()
    assert {
        (r.event_date, r.customer_city): [r.order_count, r.unique_customer_count] for r in cities
    } == {key: [count, len(customers)] for key, (count, customers) in expected.items()}


def test_payments_of_one_order(spark, hot):
    _, lines = hot
    paid = spark.createDataFrame(
        [(order, value, int(value >= 5)) for order, _, _, value in lines],
        "order_id string, payment_value_amount double, is_high_value_payment int",
    )
    row = payments.payments_by_order(paid, exact_cents=True).filter("order_id = 'o1'").first()
    values = [value for order, _, _, value in lines if order == "o1"]
    assert row.payment_record_count == len(values)
    assert row.payment_total_value == sum(round(v * 100) for v in values) / 100


def shuffled_rows(frame):
    """Rows written by each shuffle of the executed plan, outermost first."""
    frame.collect()
    found = []

    def visit(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return visit(node.executedPlan())
        if kind == "ShuffleExchangeExec":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.plan() if kind.endswith("QueryStageExec") else None
        if children is not None:
            return visit(children)
        below = node.children()
        for i in range(below.size()):
            visit(below.apply(i))

    visit(frame._jdf.queryExecution().executedPlan())
    return found


TASKS = 4


def test_a_hot_copy_shuffles_one_row_per_task(spark):
    rows = spark.range(0, 6000, 1, TASKS).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id)) as k", "id as n", "cast(id as string) as s"
    )
    unique = keep_one(rows, ["k"])
    assert unique.filter("k = 'hot'").collect() == [("hot", 0, "0")]
    assert unique.count() == 4001
    assert shuffled_rows(unique) == [4000 + TASKS]


def test_a_hot_customer_joins_as_one_row_per_day(spark):
    days, customers = 5, 100
    orders = spark.range(0, 9000, 1, TASKS).selectExpr(
        "cast(id as string) as order_id",
        f"if(id % 3 = 0, 'hot', concat('c', id % {customers})) as customer_id",
        f"date_add(date'2018-01-01', cast(id % {days} as int)) as event_date",
    )
    places = spark.range(customers).selectExpr(
        "concat('c', id) as customer_id", "'x' as customer_city", "'y' as customer_state"
    )
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        shuffles = shuffled_rows(gold.orders_by_city_day(orders, places))
    # The last group-by, the join of the grouped orders, their group-by, customers.
    assert len(shuffles) == 4
    assert max(shuffles) <= TASKS * days * (customers + 1)


def test_a_hot_order_joins_as_one_row_per_product(spark):
    products = 50
    items = spark.range(0, 9000, 1, TASKS).selectExpr(
        "if(id % 3 = 0, 'hot', concat('o', id % 30)) as order_id",
        f"concat('p', id % {products}) as product_id",
        "1.5D as price_amount",
    )
    orders = spark.range(30).selectExpr(
        "if(id = 0, 'hot', concat('o', id)) as order_id", "date'2018-01-01' as event_date"
    )
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        shuffles = shuffled_rows(gold.top_products_by_day(orders, items))
    assert max(shuffles) <= TASKS * 31 * products


@pytest.mark.parametrize("k", [5, 1500])
def test_at_most_k_products_of_a_day_leave_a_task(spark, k):
    """One day has most of the products; k is above Spark's own limit, too."""
    products = 12_000
    items = spark.range(0, products, 1, TASKS).selectExpr(
        "concat('o', id % 10) as order_id", "concat('p', id) as product_id", "cast(id % 977 as double) as price_amount"
    )
    orders = spark.range(10).selectExpr(
        "concat('o', id) as order_id", "if(id < 9, date'2018-01-01', date'2018-01-02') as event_date"
    )
    top = gold.top_products_by_day(orders, items, k=k)
    shuffles = shuffled_rows(top)
    assert shuffles[0] <= k * 2 * TASKS
    ranked = sorted(((-(i % 977), f"p{i}") for i in range(products) if i % 10 < 9))[:k]
    found = top.filter("event_date = '2018-01-01'").orderBy("rank_in_day").collect()
    assert [(-row.product_revenue, row.product_id) for row in found] == ranked


def test_the_best_of_a_group_with_nulls_ties_and_many_batches(spark):
    rows = [(g, None if i % 7 == 0 else i % 5, None if i % 11 == 0 else f"n{i % 13}") for i in range(900) for g in (None, "a", "b")]
    frame = spark.createDataFrame(rows, "g string, value int, name string").repartition(3)
    by = Window.partitionBy("g").orderBy(F.col("value").desc(), F.col("name").asc())
    with session_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "40"}):
        best = keep_best(frame, "g", [("value", "descending"), ("name", "ascending")], 30)
        assert best.count() <= 3 * 3 * 30

        def top(table):
            return sorted(map(str, table.withColumn("r", F.row_number().over(by)).filter("r <= 30").collect()))

        assert top(best) == top(frame)
        assert keep_best(frame.limit(0), "g", [("value", "descending")], 3).count() == 0


def test_the_best_of_many_groups_pass_batch_by_batch(spark, monkeypatch):
    frame = spark.createDataFrame([], "g int, value int")
    functions = []
    monkeypatch.setattr(type(frame), "mapInArrow", lambda self, function, schema: functions.append(function) or self)
    keep_best(frame, "g", [("value", "descending")], 3)
    taken = []

    def batches():
        for groups in ([None, None], [None, None, 1], [2, 2], [], [2], [2, 2, 3]):
            taken.append(groups)
            yield pa.RecordBatch.from_pydict({"g": pa.array(groups, pa.int32()), "value": pa.array([0] * len(groups), pa.int32())})

    found = []
    for batch in functions[0](batches()):
        found += batch["g"].to_pylist()
        assert len(found) >= sum(map(len, taken)) - 3  # no rows wait for the end
    assert found == [None, None, None, 1, 2, 2, 2, 3]
