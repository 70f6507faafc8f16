"""Tumbling-window facts over parsed events.

In append mode a window appears once, when the watermark has passed its end.
Each row carries ``processed_at``, one value per micro-batch.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _per_window(events: DataFrame, length: str, *measures: Column) -> DataFrame:
    windows = events.groupBy(F.window("event_ts", length)).agg(*measures)
    return windows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *(name for name in windows.columns if name != "window"),
        F.current_timestamp().alias("processed_at"),
    )


def order_count_10m(orders: DataFrame) -> DataFrame:
    """Orders per ten minutes."""
    return _per_window(
        orders, "10 minutes", F.count("*").alias("order_created_count")
    )


def payment_revenue_5m(payments: DataFrame) -> DataFrame:
    """Payments and revenue per five minutes."""
    return _per_window(
        payments,
        "5 minutes",
        F.count("*").alias("payment_confirmed_count"),
        F.sum("payment_value").alias("payment_revenue"),
    )


def fact_realtime_orders_5m(orders: DataFrame, sketch: bool = False) -> DataFrame:
    """Orders and estimated customers per five minutes.

    A stream cannot count distinct values exactly. ``sketch`` adds a mergeable
    ``customer_sketch``, from which a later step can count customers over any
    longer period without counting one twice.
    """
    measures = [
        F.count("*").alias("order_created_count"),
        F.approx_count_distinct("customer_id").alias("unique_customer_count"),
    ]
    if sketch:
        measures.append(F.hll_sketch_agg("customer_id").alias("customer_sketch"))
    return _per_window(orders, "5 minutes", *measures)


def fact_payment_status_5m(payments: DataFrame) -> DataFrame:
    """Payments, revenue and average value per five minutes."""
    return _per_window(
        payments,
        "5 minutes",
        F.count("*").alias("payment_confirmed_count"),
        F.sum("payment_value").alias("payment_revenue"),
        F.avg("payment_value").alias("avg_payment_value"),
    )
