from datetime import date, datetime

import pytest
from pyspark.sql.types import StringType

from millrace import schemas
from millrace.operators import staging

GOOD_ORDER = {
    "order_id": "o1",
    "customer_id": "c1",
    "order_status": "delivered",
    "order_purchase_timestamp": "2018-03-04 05:06:07",
    "order_approved_at": "2018-03-04 06:00:00",
    "order_delivered_customer_date": "2018-03-10 00:00:00",
    "order_estimated_delivery_date": "2018-03-20 00:00:00",
}
GOOD_ITEM = {
    "order_id": "o1",
    "order_item_id": "1",
    "product_id": "p1",
    "seller_id": "s1",
    "shipping_limit_date": "2018-03-05 00:00:00",
    "price": "10.10",
    "freight_value": "2.05",
}
GOOD_PAYMENT = {
    "order_id": "o1",
    "payment_sequential": "1",
    "payment_type": "voucher",
    "payment_installments": "2",
    "payment_value": "12.50",
}
GOOD_CUSTOMER = {
    "customer_id": "c1",
    "customer_unique_id": "u1",
    "customer_zip_code_prefix": "01000",
    "customer_city": "sao paulo",
    "customer_state": "SP",
}


def test_preview_keeps_rows_with_a_bad_time(text_table, rows_of):
    raw = text_table(
        schemas.RAW_ORDERS,
        GOOD_ORDER | {"order_purchase_timestamp": "yesterday"},
        GOOD_ORDER | {"order_id": None},
    )
    preview = staging.preview_orders(raw)
    assert preview.columns == ["order_id", "customer_id", "order_status", "order_purchase_ts"]
    assert rows_of(preview, "order_id", "order_purchase_ts") == [
        {"order_id": "o1", "order_purchase_ts": None}
    ]


def test_basic_cleaning_drops_incomplete_rows_and_keeps_copies(text_table, rows_of):
    raw = text_table(
        schemas.RAW_ORDERS,
        GOOD_ORDER,
        GOOD_ORDER,
        GOOD_ORDER | {"customer_id": None},
        GOOD_ORDER | {"order_purchase_timestamp": "yesterday"},
        GOOD_ORDER | {"order_purchase_timestamp": None},
        GOOD_ORDER | {"order_id": " padded "},
    )
    clean = staging.clean_orders_basic(raw)
    assert rows_of(clean, "order_id", "order_date") == [
        {"order_id": " padded ", "order_date": date(2018, 3, 4)},
        {"order_id": "o1", "order_date": date(2018, 3, 4)},
        {"order_id": "o1", "order_date": date(2018, 3, 4)},
    ]


def test_curated_orders_columns_and_values(text_table):
    raw = text_table(schemas.RAW_ORDERS, GOOD_ORDER | {"order_status": " DELIVERED "})
    curated = staging.curate_orders(raw)
    assert set(curated.columns) == {
        "order_id",
        "customer_id",
        "order_purchase_ts",
        "order_approved_ts",
        "order_delivered_customer_ts",
        "order_estimated_delivery_ts",
        "order_date",
        "order_status_normalized",
        "is_delivered",
        "is_status_valid",
        "order_year",
        "order_month",
    }
    row = curated.first()
    assert row.order_purchase_ts == datetime(2018, 3, 4, 5, 6, 7)
    assert (row.order_status_normalized, row.is_delivered, row.is_status_valid) == (
        "delivered",
        1,
        1,
    )
    assert (row.order_date, row.order_year, row.order_month) == (date(2018, 3, 4), 2018, 3)


@pytest.mark.parametrize(
    "status, expected",
    [
        ("Shipped", ("shipped", 0, 1)),
        ("lost", ("unknown", 0, 0)),
        ("", ("unknown", 0, 0)),
        (None, ("unknown", 0, 0)),
    ],
)
def test_order_status(text_table, status, expected):
    row = staging.stage_orders(
        text_table(schemas.RAW_ORDERS, GOOD_ORDER | {"order_status": status})
    ).first()
    assert (row.order_status_normalized, row.is_delivered, row.is_status_valid) == expected


def test_staged_orders_drop_unusable_rows_and_copies(text_table, rows_of):
    raw = text_table(
        schemas.RAW_ORDERS,
        GOOD_ORDER,
        GOOD_ORDER | {"order_id": "  o1  ", "customer_id": "c0"},
        GOOD_ORDER | {"order_id": None},
        GOOD_ORDER | {"customer_id": None},
        GOOD_ORDER | {"order_id": "o2", "order_purchase_timestamp": "not a time"},
        GOOD_ORDER | {"order_id": "   "},
        GOOD_ORDER | {"order_id": "o3", "order_approved_at": "not a time"},
    )
    staged = staging.stage_orders(raw)
    assert "order_date" not in staged.columns and "order_year" not in staged.columns
    assert rows_of(staged, "order_id", "customer_id", "event_date") == [
        {"order_id": "", "customer_id": "c1", "event_date": date(2018, 3, 4)},
        {"order_id": "o1", "customer_id": "c0", "event_date": date(2018, 3, 4)},
        {"order_id": "o3", "customer_id": "c1", "event_date": date(2018, 3, 4)},
    ]


def item_cases():
    return [
        GOOD_ITEM,
        GOOD_ITEM | {"product_id": "p0"},  # copy of line 1: smaller product wins
        GOOD_ITEM | {"order_item_id": "2", "seller_id": None},
        GOOD_ITEM | {"order_item_id": "3", "price": "0", "freight_value": "0"},
        GOOD_ITEM | {"order_item_id": "4", "price": "-1"},
        GOOD_ITEM | {"order_item_id": "5", "freight_value": "-0.01"},
        GOOD_ITEM | {"order_item_id": "6", "price": "ten"},
        GOOD_ITEM | {"order_item_id": "7", "freight_value": None},
        GOOD_ITEM | {"order_item_id": "x"},
        GOOD_ITEM | {"order_item_id": "8", "product_id": None},
        GOOD_ITEM | {"order_item_id": "9", "order_id": None},
        GOOD_ITEM | {"order_item_id": "10", "shipping_limit_date": "soon"},
    ]


def test_curated_items(text_table, rows_of):
    curated = staging.curate_order_items(text_table(schemas.RAW_ORDER_ITEMS, *item_cases()))
    assert rows_of(curated, "order_item_id", "product_id", "line_total_amount") == [
        {"order_item_id": 1, "product_id": "p0", "line_total_amount": 12.15},
        {"order_item_id": 10, "product_id": "p1", "line_total_amount": 12.15},
        {"order_item_id": 2, "product_id": "p1", "line_total_amount": 12.15},
        {"order_item_id": 3, "product_id": "p1", "line_total_amount": 0.0},
    ]


def test_staged_items_need_a_seller(text_table, rows_of):
    staged = staging.stage_order_items(text_table(schemas.RAW_ORDER_ITEMS, *item_cases()))
    assert [r["order_item_id_int"] for r in rows_of(staged, "order_item_id_int")] == [1, 10, 3]
    assert set(staged.columns) == {
        "order_id",
        "product_id",
        "seller_id",
        "order_item_id_int",
        "shipping_limit_ts",
        "price_amount",
        "freight_value_amount",
        "is_valid_price",
        "is_valid_freight",
        "item_total_amount",
    }
    assert {(r["is_valid_price"], r["is_valid_freight"]) for r in rows_of(staged)} == {(1, 1)}


def test_staged_payments(text_table, rows_of):
    def paid(order, **other):
        return GOOD_PAYMENT | {"order_id": order} | other

    raw = text_table(
        schemas.RAW_PAYMENTS,
        paid("a", payment_value="499.99"),
        paid("b", payment_value="500", payment_type=" Credit_Card "),
        paid("c", payment_value="0", payment_type="cash"),
        paid("d", payment_value="-0.01"),
        paid("e", payment_value="free"),
        paid("f", payment_value="NaN"),
        paid("h", payment_value="Infinity"),
        paid("i", payment_value="1e13"),
        paid("j", payment_sequential="first"),
        paid("g"),
        paid("g", payment_installments="1"),
        paid("g", payment_type="boleto"),
        paid(None),
    )
    staged = staging.stage_payments(raw)
    columns = (
        "order_id",
        "payment_sequential_int",
        "payment_installments_int",
        "payment_type_normalized",
        "is_payment_type_valid",
        "is_high_value_payment",
    )
    assert [tuple(r.values()) for r in rows_of(staged, *columns)] == [
        ("a", 1, 2, "voucher", 1, 0),
        ("b", 1, 2, "credit_card", 1, 1),
        ("c", 1, 2, "unknown", 0, 0),
        ("g", 1, 1, "voucher", 1, 0),
        ("g", 1, 2, "boleto", 1, 0),
        ("j", None, 2, "voucher", 1, 0),
    ]


def test_staged_customers(text_table, rows_of):
    raw = text_table(
        schemas.RAW_CUSTOMERS,
        GOOD_CUSTOMER | {"customer_city": "  São Paulo ", "customer_state": " sp "},
        GOOD_CUSTOMER | {"customer_unique_id": "u2"},
        GOOD_CUSTOMER | {"customer_id": "c2", "customer_city": "  ", "customer_state": None},
        GOOD_CUSTOMER | {"customer_id": None},
        GOOD_CUSTOMER | {"customer_id": "c3", "customer_unique_id": None},
    )
    staged = staging.stage_customers(raw)
    columns = (
        "customer_id",
        "customer_city",
        "customer_state",
        "is_customer_city_valid",
        "is_customer_state_valid",
    )
    assert [tuple(r.values()) for r in rows_of(staged, *columns)] == [
        ("c1", "são paulo", "SP", 1, 1),
        ("c2", "", None, 0, 0),
    ]


def envelope(offset, key="k", partition=0, **value):
    payload = {
        "order_id": "o1",
        "customer_id": "c1",
        "event_type": "order_created",
        "event_time": "2018-03-04T05:06:07",
    } | value
    names = schemas.event_envelope()["value"].dataType.names
    return ("t", partition, offset, key, tuple(payload.get(name) for name in names))


def test_event_archives(spark, rows_of):
    envelopes = spark.createDataFrame(
        [
            envelope(1),
            envelope(1, order_id="o0"),
            envelope(2, event_type="payment_confirmed"),
            envelope(3, order_id=None),
            envelope(4, event_type=None),
            envelope(5, event_time="noon"),
            envelope(6, key=None),
            envelope(6, key=None, partition=1, order_id="o9"),
        ],
        schemas.event_envelope(),
    )
    staged = staging.stage_order_events(envelopes)
    assert "event_time" not in staged.columns
    columns = ("offset", "order_id", "is_order_created_event", "event_date")
    day = date(2018, 3, 4)
    assert [tuple(r.values()) for r in rows_of(staged, *columns)] == [
        (1, "o0", 1, day),
        (2, "o1", 0, day),
        (6, "o1", 1, day),
        (6, "o9", 1, day),
    ]
    curated = staging.curate_order_events(envelopes)
    assert {"event_time", "event_year", "event_month"} <= set(curated.columns)
    assert curated.count() == 4
    assert staging.curate_order_events(envelopes, keys=staging.MESSAGE_KEY).count() == 3


def test_event_archive_with_text_values(spark):
    schema = schemas.event_envelope(StringType())
    archive = spark.createDataFrame([envelope(1, payment_value="1.5")], schema)
    assert staging.curate_order_events(archive).count() == 1


def test_staging_accepts_typed_columns(spark, rows_of):
    typed = spark.createDataFrame(
        [(7, 1, "voucher", 2, 12.5)],
        "order_id long, payment_sequential int, payment_type string,"
        " payment_installments int, payment_value double",
    )
    assert rows_of(staging.stage_payments(typed), "order_id", "payment_value_amount") == [
        {"order_id": "7", "payment_value_amount": 12.5}
    ]
