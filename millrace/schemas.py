"""Explicit schemas and the fixed code lists of the data model.

Raw text tables are all-string: typing happens in the staging operators, so one
bad value costs one row and never a whole scan.
"""

from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _text_table(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


# Column names of the raw files and event payloads.
RAW_ORDERS = _text_table(
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)
RAW_ORDER_ITEMS = _text_table(
    "order_id",
    "order_item_id",
    "product_id",
    "seller_id",
    "shipping_limit_date",
    "price",
    "freight_value",
)
RAW_PAYMENTS = _text_table(
    "order_id",
    "payment_sequential",
    "payment_type",
    "payment_installments",
    "payment_value",
)
RAW_CUSTOMERS = _text_table(
    "customer_id",
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
)
ORDER_CREATED_PAYLOAD = _text_table(
    "order_id", "customer_id", "event_type", "event_time"
)
PAYMENT_CONFIRMED_PAYLOAD = _text_table(
    "order_id", "payment_id", "event_type", "event_time"
).add("payment_value", DoubleType())


def event_envelope(payment_value_type=DoubleType()) -> StructType:
    """Schema of one archived message with its payload nested under ``value``.

    Older archives carry ``payment_value`` as text: pass ``StringType()``.
    """
    value = (
        _text_table(
            "order_id", "customer_id", "event_type", "event_time", "payment_id"
        )
        .add("payment_value", payment_value_type)
        .add("delivered_customer_date", StringType())
        .add("invalid_reason", StringType())
    )
    return (
        StructType()
        .add("topic", StringType())
        .add("partition", LongType())
        .add("offset", LongType())
        .add("key", StringType())
        .add("value", value)
    )


def _facts(*measures: tuple[str, str]) -> StructType:
    columns = [("window_start", "timestamp"), ("window_end", "timestamp"), *measures]
    columns.append(("processed_at", "timestamp"))
    schema = StructType()
    for name, kind in columns:
        schema.add(name, kind)
    return schema


#: The five-minute facts. Sketches of customers are part of the table only if asked for.
ORDER_FACTS = _facts(
    ("order_created_count", "long"),
    ("unique_customer_count", "long"),
    ("customer_sketch", "binary"),
)
PAYMENT_FACTS = _facts(
    ("payment_confirmed_count", "long"),
    ("payment_revenue", "double"),
    ("avg_payment_value", "double"),
)

#: What a landing stream writes, with the folders it writes to.
LANDED = (
    StructType()
    .add("topic", "string")
    .add("partition", "integer")
    .add("offset", "long")
    .add("kafka_ingest_ts", "timestamp")
    .add("message_key", "string")
    .add("raw_json", "string")
    .add("processed_at", "timestamp")
    .add("ingest_date", "date")
    .add("ingest_hour", "integer")
)

# Code lists, limits and event names of the data model.
ORDER_STATUSES = (
    "created",
    "approved",
    "invoiced",
    "processing",
    "shipped",
    "delivered",
    "canceled",
    "unavailable",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")
UNKNOWN = "unknown"
DELIVERED = "delivered"
HIGH_VALUE_PAYMENT = 500
ORDER_CREATED = "order_created"
PAYMENT_CONFIRMED = "payment_confirmed"
ORDER_TOPIC = "ecom.order_created.v1"
PAYMENT_TOPIC = "ecom.payment_confirmed.v1"
REPLAY_EVENT_TIME = "2018-01-01 00:00:00"
EVENT_WATERMARK = "20 minutes"
