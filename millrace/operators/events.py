"""Business tables to event messages with a text key and a JSON value."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import all_present, amount, integer
from millrace.schemas import ORDER_CREATED, PAYMENT_CONFIRMED, REPLAY_EVENT_TIME


def _first(rows: DataFrame, limit: int | None, *order: str) -> DataFrame:
    return rows if limit is None else rows.orderBy(*order).limit(limit)


def _as_messages(payload: DataFrame) -> DataFrame:
    return payload.select(
        F.col("order_id").alias("key"), F.to_json(F.struct("*")).alias("value")
    )


def order_created_events(raw_orders: DataFrame, limit: int | None = None) -> DataFrame:
    """One order_created message per complete order.

    With a limit, the first orders by id (a top-k, not a full sort).
    """
    complete = raw_orders.select(
        F.col("order_id").cast("string"),
        F.col("customer_id").cast("string"),
        F.col("order_purchase_timestamp").cast("string").alias("event_time"),
    ).filter(all_present("order_id", "customer_id", "event_time"))
    payload = _first(complete, limit, "order_id", "event_time", "customer_id").select(
        "order_id", "customer_id", F.lit(ORDER_CREATED).alias("event_type"), "event_time"
    )
    return _as_messages(payload)


def payment_confirmed_events(
    raw_payments: DataFrame,
    limit: int | None = None,
    event_time: Column | None = None,
) -> DataFrame:
    """One payment_confirmed message per complete payment.

    Payments have no time of their own. The default stamps all of them with the
    fixed replay time, which never closes a window; pass ``event_time``, a column
    over the raw payments, to give them real times.
    """
    stamp = F.lit(REPLAY_EVENT_TIME) if event_time is None else event_time
    # a payment without a time would be a message that no parser can use
    complete = raw_payments.select(
        F.col("order_id").cast("string"),
        integer("payment_sequential").alias("sequence"),
        amount("payment_value").alias("payment_value"),
        stamp.cast("string").alias("event_time"),
    ).filter(all_present("order_id", "sequence", "payment_value", "event_time"))
    payload = _first(complete, limit, "order_id", "sequence", "payment_value").select(
        "order_id",
        F.concat_ws("_", "order_id", "sequence").alias("payment_id"),
        F.lit(PAYMENT_CONFIRMED).alias("event_type"),
        "event_time",
        "payment_value",
    )
    return _as_messages(payload)
