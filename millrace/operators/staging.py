"""Raw tables to typed, clean tables with one row per business key.

Each operator reads only the raw columns it needs, types them in one projection,
drops the rows that cannot be used, keeps one row per key and only then derives
the remaining columns, so that nothing derivable is sorted or shuffled. Missing
keys are filtered on the raw columns, where the scan can skip them.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import (
    all_present,
    amount,
    calendar,
    flag,
    integer,
    known_code,
    lower_text,
    moment,
    text,
    upper_text,
)
from millrace.functions.dedup import keep_one
from millrace.functions.money import usable
from millrace.schemas import (
    DELIVERED,
    HIGH_VALUE_PAYMENT,
    ORDER_CREATED,
    ORDER_STATUSES,
    PAYMENT_TYPES,
    UNKNOWN,
)


# Orders


def preview_orders(raw_orders: DataFrame) -> DataFrame:
    """The four leading order columns, untrimmed, with the purchase time parsed.

    Rows with a malformed purchase time stay, with a NULL time.
    """
    return raw_orders.filter(all_present("order_id")).select(
        "order_id",
        "customer_id",
        "order_status",
        moment("order_purchase_timestamp").alias("order_purchase_ts"),
    )


def clean_orders_basic(raw_orders: DataFrame) -> DataFrame:
    """The preview, complete rows only, with the order date. Not deduplicated."""
    return (
        preview_orders(raw_orders)
        .filter(all_present("customer_id", "order_purchase_ts"))
        .withColumn("order_date", F.to_date("order_purchase_ts"))
    )


def _unique_orders(raw_orders: DataFrame) -> DataFrame:
    keyed = raw_orders.filter(all_present("order_id", "customer_id"))
    typed = keyed.select(
        text("order_id"),
        text("customer_id"),
        moment("order_purchase_timestamp").alias("order_purchase_ts"),
        moment("order_approved_at").alias("order_approved_ts"),
        moment("order_delivered_customer_date").alias("order_delivered_customer_ts"),
        moment("order_estimated_delivery_date").alias("order_estimated_delivery_ts"),
        known_code(lower_text("order_status"), ORDER_STATUSES).alias(
            "order_status_normalized"
        ),
    )
    dated = typed.filter(all_present("order_purchase_ts"))
    return keep_one(dated, ["order_id"])


def _status_flags() -> dict[str, Column]:
    status = F.col("order_status_normalized")
    return {
        "is_delivered": flag(status == DELIVERED),
        "is_status_valid": flag(status != UNKNOWN),
    }


def curate_orders(raw_orders: DataFrame) -> DataFrame:
    """One row per order, ready for a layout by ``order_year``, ``order_month``."""
    return _unique_orders(raw_orders).withColumns(
        {
            "order_date": F.to_date("order_purchase_ts"),
            **_status_flags(),
            **calendar("order_purchase_ts", "order_year", "order_month"),
        }
    )


def stage_orders(raw_orders: DataFrame) -> DataFrame:
    """One row per order, ready for a layout by ``event_date``."""
    return _unique_orders(raw_orders).withColumns(
        {**_status_flags(), "event_date": F.to_date("order_purchase_ts")}
    )


# Order items


def _unique_items(
    raw_items: DataFrame, item_key: str, required: Sequence[str]
) -> DataFrame:
    keyed = raw_items.filter(all_present("order_id", "product_id", *required))
    typed = keyed.select(
        text("order_id"),
        text("product_id"),
        text("seller_id"),
        integer("order_item_id").alias(item_key),
        moment("shipping_limit_date").alias("shipping_limit_ts"),
        amount("price").alias("price_amount"),
        amount("freight_value").alias("freight_value_amount"),
    )
    # A comparison with NULL is not true, so these also drop missing amounts.
    complete = typed.filter(
        all_present(item_key)
        & usable(F.col("price_amount"))
        & usable(F.col("freight_value_amount"))
    )
    return keep_one(complete, ["order_id", item_key])


def _line_total() -> Column:
    return F.round(F.col("price_amount") + F.col("freight_value_amount"), 2)


def curate_order_items(raw_items: DataFrame) -> DataFrame:
    """One row per order line; the seller may be missing."""
    unique = _unique_items(raw_items, "order_item_id", required=())
    return unique.withColumn("line_total_amount", _line_total())


def stage_order_items(raw_items: DataFrame) -> DataFrame:
    """One row per order line with a known seller.

    The validity flags are 1 on every row, since rows with a bad amount are
    dropped; they are part of the table's published columns.
    """
    unique = _unique_items(raw_items, "order_item_id_int", required=("seller_id",))
    return unique.withColumns(
        {
            "is_valid_price": F.lit(1),
            "is_valid_freight": F.lit(1),
            "item_total_amount": _line_total(),
        }
    )


# Payments and customers


def stage_payments(raw_payments: DataFrame) -> DataFrame:
    """One row per order, sequence, type and value of a payment."""
    keyed = raw_payments.filter(all_present("order_id"))
    typed = keyed.select(
        text("order_id"),
        integer("payment_sequential").alias("payment_sequential_int"),
        integer("payment_installments").alias("payment_installments_int"),
        amount("payment_value").alias("payment_value_amount"),
        known_code(lower_text("payment_type"), PAYMENT_TYPES).alias(
            "payment_type_normalized"
        ),
    )
    unique = keep_one(
        typed.filter(usable(F.col("payment_value_amount"))),
        [
            "order_id",
            "payment_sequential_int",
            "payment_type_normalized",
            "payment_value_amount",
        ],
    )
    return unique.withColumns(
        {
            "is_payment_type_valid": flag(F.col("payment_type_normalized") != UNKNOWN),
            "is_high_value_payment": flag(
                F.col("payment_value_amount") >= HIGH_VALUE_PAYMENT
            ),
        }
    )


def stage_customers(raw_customers: DataFrame) -> DataFrame:
    """One row per customer id, with flags for a usable city and state."""
    keyed = raw_customers.filter(all_present("customer_id", "customer_unique_id"))
    typed = keyed.select(
        text("customer_id"),
        text("customer_unique_id"),
        text("customer_zip_code_prefix"),
        lower_text("customer_city"),
        upper_text("customer_state"),
    )
    # A comparison with NULL is not true: a missing value gets flag 0.
    return keep_one(typed, ["customer_id"]).withColumns(
        {
            "is_customer_city_valid": flag(F.col("customer_city") != ""),
            "is_customer_state_valid": flag(F.col("customer_state") != ""),
        }
    )


# Event archives


#: Where a broker keeps a message: unique in the archive of any number of topics.
MESSAGE_POSITION = ("topic", "partition", "offset")
#: The key of older archives. Messages without a key that have the same offset in
#: two partitions are one message by it.
MESSAGE_KEY = ("message_key", "offset")


def _unique_events(envelopes: DataFrame, keys: Sequence[str]) -> DataFrame:
    flat = envelopes.select(
        "topic",
        "partition",
        "offset",
        F.col("key").alias("message_key"),
        "value.order_id",
        "value.customer_id",
        "value.event_type",
        "value.event_time",
        moment("value.event_time").alias("event_ts"),
    )
    complete = flat.filter(all_present("order_id", "event_type", "event_ts"))
    return keep_one(complete, keys)


def curate_order_events(
    envelopes: DataFrame, keys: Sequence[str] = MESSAGE_POSITION
) -> DataFrame:
    """One row per archived message, ready for a layout by year and month."""
    return _unique_events(envelopes, keys).withColumns(
        {
            "event_date": F.to_date("event_ts"),
            **calendar("event_ts", "event_year", "event_month"),
        }
    )


def stage_order_events(
    envelopes: DataFrame, keys: Sequence[str] = MESSAGE_POSITION
) -> DataFrame:
    """One row per archived message, ready for a layout by ``event_date``."""
    unique = _unique_events(envelopes, keys).drop("event_time")
    return unique.withColumns(
        {
            "is_order_created_event": flag(F.col("event_type") == ORDER_CREATED),
            "event_date": F.to_date("event_ts"),
        }
    )
