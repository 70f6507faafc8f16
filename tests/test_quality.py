from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import gold, quality

DAILY = (
    "event_date date, order_count long, total_revenue double,"
    " orders_with_payment long, delivered_order_count long"
)
DAY1, DAY2 = date(2018, 1, 1), date(2018, 1, 2)


def failures(report):
    return {row.check_name: row.failed_rows for row in report.collect()}


def hourly(spark, *rows):
    return spark.createDataFrame(rows, "event_date date, order_count long")


def test_clean_gold_tables_pass(spark):
    daily = spark.createDataFrame([(DAY1, 3, 9.5, 2, 1)], DAILY)
    report = quality.validate_gold(daily, hourly(spark, (DAY1, 1), (DAY1, 2)))
    assert len(failures(report)) == 7 and set(failures(report).values()) == {0}
    quality.require_passed(report)


def test_an_empty_daily_table_and_repeated_orders_fail(spark):
    daily = spark.createDataFrame([], DAILY)
    orders = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), ("c",)], "order_id string")
    found = failures(quality.validate_gold(daily, hourly(spark, (DAY1, 1)), staged_orders=orders))
    assert found["daily table is empty"] == 1
    assert found["daily and hourly order counts differ"] == 1
    assert found["order_id is not unique"] == 2
    assert sum(found.values()) == 4


def test_rejected_amounts_are_counted_by_reason(spark):
    values = ["1.5", "free", "NaN", "Infinity", "-Infinity", "1e15", "-2", None, "0"]
    raw = spark.createDataFrame([(v,) for v in values], "price string")
    assert failures(quality.rejected_amounts(raw, "price")) == {
        "price is no number": 1,
        "price is not finite or too large": 4,
        "price is negative": 1,
    }


def test_every_gold_rule_counts_its_bad_rows(spark):
    daily = spark.createDataFrame(
        [
            (None, 1, 1.0, 0, 0),
            (None, None, None, None, None),
            (DAY1, 0, 1.0, 0, 0),
            (DAY1, -1, -0.5, 0, 0),
            (DAY2, 2, 1.0, 3, 3),
        ],
        DAILY,
    )
    report = quality.validate_gold(daily, hourly(spark, (DAY2, 2)))
    assert failures(report) == {
        "daily table is empty": 0,
        "daily event_date is null": 2,
        "daily order_count is not positive": 2,
        "daily total_revenue is negative": 1,
        "orders_with_payment exceeds order_count": 2,
        "delivered_order_count exceeds order_count": 2,
        "daily and hourly order counts differ": 2,  # one without a date, one below zero
    }
    with pytest.raises(quality.QualityError, match="daily event_date is null: 2"):
        quality.require_passed(report)


def test_reconciliation_and_days_on_one_side_only(spark):
    daily = spark.createDataFrame([(DAY1, 3, 0.0, 0, 0), (DAY2, 5, 0.0, 0, 0)], DAILY)
    other = hourly(spark, (DAY1, 1), (DAY1, 1), (date(2018, 1, 3), 4))
    compared = quality.daily_vs_hourly(daily, other, include_unmatched=False).collect()
    assert [tuple(row) for row in compared] == [(DAY1, 3, 2, 1)]
    everything = quality.daily_vs_hourly(daily, other)
    assert sorted(row.order_count_diff for row in everything.collect()) == [-4, 1, 5]
    name = "daily and hourly order counts differ"
    assert failures(quality.validate_gold(daily, other, include_unmatched=False))[name] == 1
    assert failures(quality.validate_gold(daily, other))[name] == 3


def test_serving_checks(spark):
    mart = spark.createDataFrame(
        [(DAY1, 1.0), (DAY1, -1.0), (None, 2.0), (None, 3.0), (DAY2, None)],
        "sales_date date, total_revenue double",
    )
    assert failures(quality.check_serving(mart)) == {
        "mart is empty": 0,
        "sales_date is null": 2,
        "total_revenue is negative": 1,
        "sales_date is duplicated": 2,
    }
    empty = quality.check_serving(mart.limit(0))
    assert failures(empty) == {
        "mart is empty": 1,
        "sales_date is null": 0,
        "total_revenue is negative": 0,
        "sales_date is duplicated": 0,
    }
    with pytest.raises(quality.QualityError, match="mart is empty"):
        quality.require_passed(empty)
    quality.require_passed(quality.check_serving(mart.filter(F.col("total_revenue") == 1)))


@settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(
    st.lists(
        st.tuples(st.integers(0, 200), st.integers(0, 9), st.booleans()), min_size=1, max_size=60
    ),
    st.lists(st.tuples(st.integers(0, 70), st.integers(0, 3), st.integers(0, 10**6)), max_size=60),
)
def test_gold_tables_of_any_staged_tables_pass(spark, order_rows, payment_rows):
    orders = spark.createDataFrame(
        [(f"o{i}", f"c{c}", h, int(d)) for i, (h, c, d) in enumerate(order_rows)],
        "order_id string, customer_id string, h int, is_delivered int",
    ).select(
        "*",
        F.expr("timestamp'2018-01-01' + make_interval(0, 0, 0, 0, h)").alias("order_purchase_ts"),
    ).withColumn("event_date", F.to_date("order_purchase_ts"))
    paid = spark.createDataFrame(
        [(f"o{o}", s, v / 100) for o, s, v in payment_rows],
        "order_id string, payment_sequential_int int, payment_value_amount double",
    )
    daily = gold.daily_sales_summary(orders, paid)
    report = quality.validate_gold(daily, gold.hourly_order_summary(orders), True)
    quality.require_passed(report)
