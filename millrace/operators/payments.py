"""Payments at order grain, and orders enriched with them.

Payments are brought to one row per order before any join: an order can have
many payments, and joining first would count it once per payment.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import money
from millrace.functions.cleaning import flag


def payments_by_order(staged_payments: DataFrame, exact_cents=True) -> DataFrame:
    """Record count, total to 2 digits and high-value flag of each order."""
    value = F.col("payment_value_amount")
    return staged_payments.groupBy("order_id").agg(
        F.count("*").alias("payment_record_count"),
        F.round(money.total(value, exact_cents), 2).alias("payment_total_value"),
        F.max("is_high_value_payment").alias("has_high_value_payment"),
    )


def payment_facts_by_order(staged_payments: DataFrame, exact_cents=True) -> DataFrame:
    """Unrounded total, number of sequences and whether anything was paid.

    A consumer that does not read ``payment_count`` does not pay for its distinct
    count: the optimizer prunes unused aggregates.
    """
    value = F.col("payment_value_amount")
    return staged_payments.groupBy("order_id").agg(
        money.total(value, exact_cents).alias("payment_total_value"),
        F.count_distinct("payment_sequential_int").alias("payment_count"),
        F.max(flag(value > 0)).alias("has_payment"),
    )


def sequenced_payments_by_order(staged_payments: DataFrame) -> DataFrame:
    """Whether an order has a payment with a sequence number, whatever its value.

    "At least one distinct number" is "any number at all", so no distinct count
    is needed.
    """
    numbered = F.col("payment_sequential_int").isNotNull()
    return staged_payments.groupBy("order_id").agg(
        F.max(flag(numbered)).alias("has_payment")
    )


def orders_with_payments(
    staged_orders: DataFrame, order_payments: DataFrame
) -> DataFrame:
    """Every order with its payment totals; ``has_payment`` counts records.

    ``order_payments`` comes from ``payments_by_order``.
    """
    joined = staged_orders.join(order_payments, on="order_id", how="left")
    filled = joined.fillna(
        {
            "payment_record_count": 0,
            "payment_total_value": 0.0,
            "has_high_value_payment": 0,
        }
    )
    return filled.withColumn("has_payment", flag(F.col("payment_record_count") > 0))
