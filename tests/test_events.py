import json

from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators import events
from millrace.operators.profile import profile_table


def orders(text_table, *ids):
    return text_table(
        schemas.RAW_ORDERS,
        *(
            {"order_id": i, "customer_id": "c", "order_purchase_timestamp": "2018-01-02 03:04:05"}
            for i in ids
        ),
        {"order_id": "late", "customer_id": "c"},
        {"customer_id": "c", "order_purchase_timestamp": "2018-01-02 03:04:05"},
    )


def test_order_created_messages(text_table):
    row = events.order_created_events(orders(text_table, "o1")).collect()
    assert [r.key for r in row] == ["o1"]
    assert json.loads(row[0].value) == {
        "order_id": "o1",
        "customer_id": "c",
        "event_type": "order_created",
        "event_time": "2018-01-02 03:04:05",
    }


def test_a_limit_takes_the_first_ids(text_table):
    table = orders(text_table, "o3", "o1", "o2")
    limited = events.order_created_events(table, limit=2)
    assert sorted(r.key for r in limited.collect()) == ["o1", "o2"]
    assert events.order_created_events(table).count() == 3


def payments(text_table):
    return text_table(
        schemas.RAW_PAYMENTS,
        {"order_id": "o1", "payment_sequential": "1", "payment_value": "10.5"},
        {"order_id": "o1", "payment_sequential": "2", "payment_value": "20"},
        {"order_id": "o2", "payment_sequential": None, "payment_value": "1"},
        {"order_id": "o3", "payment_sequential": "1", "payment_value": "one"},
    )


def test_payment_confirmed_messages(text_table):
    rows = events.payment_confirmed_events(payments(text_table)).collect()
    values = sorted((json.loads(r.value) for r in rows), key=lambda v: v["payment_id"])
    assert values[0] == {
        "order_id": "o1",
        "payment_id": "o1_1",
        "event_type": "payment_confirmed",
        "event_time": "2018-01-01 00:00:00",
        "payment_value": 10.5,
    }
    assert [v["payment_id"] for v in values] == ["o1_1", "o1_2"]


def test_payment_time_is_a_parameter(text_table):
    stamp = F.concat(F.lit("2018-05-0"), "payment_sequential")
    limited = events.payment_confirmed_events(payments(text_table), limit=1, event_time=stamp)
    values = [json.loads(r.value) for r in limited.collect()]
    assert [(v["payment_id"], v["event_time"]) for v in values] == [("o1_1", "2018-05-01")]


def test_profile(spark, capsys):
    table = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "n int, s string")
    profile = profile_table(table, "n", rows=2)
    assert profile.schema == table.schema
    assert profile.row_count.first().row_count == 3
    assert [r.n for r in profile.head.collect()] == [1, 2]
    assert profile_table(table, rows=1).head.count() == 1
    profile.show()
    shown = capsys.readouterr().out
    assert "n: integer" in shown and "row_count" in shown
