"""Plans that must hold at scale: what is pushed down, combined early or split."""

import re

import pytest
from pyspark.sql import functions as F

from millrace import standins
from millrace.operators import gold, payments, staging
from millrace.sources.session import session_settings
from tests.conftest import SMALL_TABLES


def physical(frame):
    """The initial plan, with joins as they are between large tables."""
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large(spark):
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        yield


@pytest.fixture
def tables(spark):
    def read(name):
        return standins.table(spark, SMALL_TABLES, name)

    return {
        "orders": staging.stage_orders(standins.raw_orders(read("orders"))),
        "payments": staging.stage_payments(standins.raw_payments(read("lineitem"))),
        "items": staging.stage_order_items(standins.raw_order_items(read("lineitem"))),
        "customers": staging.stage_customers(
            standins.raw_customers(read("customer"), read("nation"), read("region"))
        ),
    }


def test_missing_keys_are_skipped_by_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.range(1).selectExpr(
        "'o' order_id", "'c' customer_id", "'x' order_status", "'2018-01-01' order_purchase_timestamp",
        "'' order_approved_at", "'' order_delivered_customer_date",
        "'' order_estimated_delivery_date", "'wide' unused",
    ).write.parquet(path)
    with session_settings(spark, {"spark.sql.maxMetadataStringLength": "1000"}):
        plan = physical(staging.stage_orders(spark.read.parquet(path)))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    assert {"IsNotNull(order_id)", "IsNotNull(customer_id)"} <= set(pushed.split(", "))
    assert "unused" not in plan


@pytest.mark.parametrize("name", ["orders", "items", "customers"])
def test_copies_are_dropped_before_the_shuffle(tables, name):
    plan = physical(tables[name])
    after, before = plan.split("Exchange hashpartitioning", 1)
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Final", after)
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", before)


def test_payment_copies_are_dropped_by_hash(tables):
    plan = physical(tables["payments"])
    assert plan.count("HashAggregate") == 2
    assert "Sort" not in plan and "Window" not in plan


def test_an_unread_distinct_count_is_not_computed(tables):
    per_order = payments.payment_facts_by_order(tables["payments"])
    assert "count(distinct" in physical(per_order)
    assert "count(distinct" not in physical(per_order.drop("payment_count"))


@pytest.mark.parametrize("unique", [True, False])
def test_distinct_counts_do_not_multiply_rows(tables, large, unique):
    plan = physical(
        gold.daily_sales_summary(tables["orders"], tables["payments"], unique_orders=unique)
    )
    assert ("Expand" in plan) == (not unique)


def test_the_daily_summary_reuses_the_order_partitioning(tables, large):
    """Payments shuffle by copy key and order, orders by order, then two group-bys."""
    plan = physical(gold.daily_sales_summary(tables["orders"], tables["payments"]))
    assert plan.count("Exchange hashpartitioning") == 5
    assert "SortMergeJoin" in plan


@pytest.mark.parametrize(
    "key, build",
    [
        ("customer_id", lambda t: gold.orders_by_city_day(t["orders"], t["customers"])),
        ("order_id", lambda t: gold.top_products_by_day(t["orders"], t["items"])),
    ],
)
def test_the_skewed_side_is_grouped_before_its_join(tables, large, key, build):
    plan = physical(build(tables))
    join = re.search(rf"SortMergeJoin \[{key}#\d+\]", plan)
    left = plan[join.start() :].split("Exchange hashpartitioning", 2)
    assert "HashAggregate" in left[1]


def test_top_products_limit_each_day_before_the_shuffle(tables):
    plan = physical(gold.top_products_by_day(tables["orders"], tables["items"], k=3))
    assert re.search(r"row_number\(\), 3, Final", plan)
    assert re.search(r"row_number\(\), 3, Partial", plan)


def test_no_python_in_any_plan(tables):
    for table in tables.values():
        assert not re.search(r"Python|Pandas|Arrow", physical(table))


def test_one_pass_per_rule_set(spark, tables):
    from millrace.operators import quality

    daily = tables["orders"].groupBy("event_date").agg(F.count("*").alias("order_count"))
    report = quality.count_failures(daily, {str(i): F.col("order_count") < i for i in range(9)})
    assert physical(report).count("FileScan") == 1
