"""Wire records to typed, deduplicated business events.

A wire record has the columns of Spark's Kafka source: ``key`` and ``value`` in
binary, ``topic``, ``partition``, ``offset`` and ``timestamp``. Every function
here also runs on a batch DataFrame of that shape, which is how an archive is
reprocessed. No event is late then, and of several copies the one that the broker
received first is kept, so that reprocessing gives the same result every time.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.functions.cleaning import all_present, moment
from millrace.functions.dedup import keep_one
from millrace.functions.money import usable
from millrace.schemas import (
    EVENT_WATERMARK,
    ORDER_CREATED,
    ORDER_CREATED_PAYLOAD,
    PAYMENT_CONFIRMED,
    PAYMENT_CONFIRMED_PAYLOAD,
)

CORRUPT = "_corrupt"
#: Why a record is no event of its topic; the first that applies counts.
REJECTIONS = (
    "no_text",
    "malformed",
    "wrong_type",
    "no_event_type",
    "other_event",
    "no_id",
    "unusable_amount",
    "unusable_time",
)


def as_text(records: DataFrame) -> DataFrame:
    """The record with key and value as text, and the broker's time renamed."""
    return records.select(
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_ingest_ts"),
        F.col("key").cast("string").alias("message_key"),
        F.col("value").cast("string").alias("raw_json"),
    )


def _timed(records: DataFrame, payload: StructType, *origin: Column | str) -> DataFrame:
    """The records with their payload's fields, and ``_corrupt``, the text of a record
    that is no JSON or has a field of another type; such fields are NULL."""
    # As the output of a generator the fields are parsed once. Projected from a
    # struct they would be parsed again in each filter that moves below it.
    schema = StructType([*payload, StructField(CORRUPT, StringType())])
    options = {"columnNameOfCorruptRecord": CORRUPT}
    fields = F.inline_outer(F.array(F.from_json("raw_json", schema, options)))
    parsed = as_text(records).select("raw_json", *origin, fields)
    return parsed.withColumn("event_ts", moment("event_time"))


def _reason(payload: StructType, event_type: str, identified: Column, amount: Column | None) -> Column:
    """Why a record is no event, one of ``REJECTIONS``, or NULL."""
    broken = F.col(CORRUPT).isNotNull()
    unread = broken
    for name in payload.names:
        unread = unread & F.col(name).isNull()
    usable_amount = F.lit(True) if amount is None else F.coalesce(amount, F.lit(False))
    kept = (F.col("event_type") == event_type) & identified & usable_amount & all_present("event_ts")
    return (
        F.when(F.coalesce(kept, F.lit(False)), None)
        .when(F.col("raw_json").isNull(), "no_text")
        .when(unread, "malformed")
        .when(broken, "wrong_type")
        .when(F.col("event_type").isNull(), "no_event_type")
        .when(F.col("event_type") != event_type, "other_event")
        .when(~identified, "no_id")
        .when(~usable_amount, "unusable_amount")
        .otherwise("unusable_time")
    )


def _events(
    records: DataFrame,
    payload: StructType,
    event_type: str,
    identified: Column,
    amount: Column | None,
    identity: str,
    lineage: bool,
    watermark: str,
    copy_spread: int,
    observed: str | None,
) -> DataFrame:
    origin = ["message_key", "kafka_ingest_ts"]
    if lineage:
        origin += ["raw_json", "topic", "partition", "offset"]
    share = F.pmod("offset", F.lit(copy_spread)).alias("_share")
    timed = _timed(records, payload, "message_key", "kafka_ingest_ts", "topic", "partition", "offset", share)
    timed = timed.withColumn("_reason", _reason(payload, event_type, identified, amount))
    if observed:
        rejected = (F.count_if(F.col("_reason") == reason).alias(reason) for reason in REJECTIONS)
        kept = F.count_if(F.col("_reason").isNull()).alias("kept")
        timed = timed.observe(observed, F.count("*").alias("records"), kept, *rejected)
    events = timed.filter(F.col("_reason").isNull()).select(*origin, "_share", *payload.names, "event_ts")
    key = [identity, "event_ts"]
    if not events.isStreaming:
        received = F.col("kafka_ingest_ts").asc_nulls_last()
        return keep_one(events.drop("_share"), key, prefer=[received])
    events = events.withWatermark("event_ts", watermark)
    if copy_spread > 1:
        events = events.dropDuplicates([*key, "_share"])
    return events.drop("_share").dropDuplicates(key)


def _rejected(records: DataFrame, payload: StructType, event_type: str, identified: Column, amount: Column | None) -> DataFrame:
    rows = _timed(records, payload, "topic", "partition", "offset", "message_key", "kafka_ingest_ts")
    rows = rows.withColumn("reason", _reason(payload, event_type, identified, amount))
    kept = ["topic", "partition", "offset", "kafka_ingest_ts", "message_key", "raw_json", "reason"]
    return rows.filter(F.col("reason").isNotNull()).select(*kept)


def rejected_orders(records: DataFrame) -> DataFrame:
    """The records that ``parse_order_created`` leaves out, with the ``reason``.

    Stateless, for batches and streams. Copies and late events are no rejections.
    """
    return _rejected(records, ORDER_CREATED_PAYLOAD, ORDER_CREATED, all_present("order_id", "customer_id"), None)


def rejected_payments(records: DataFrame) -> DataFrame:
    """The records that ``parse_payment_confirmed`` leaves out, with the ``reason``."""
    amount = usable(F.col("payment_value"))
    return _rejected(records, PAYMENT_CONFIRMED_PAYLOAD, PAYMENT_CONFIRMED, all_present("order_id", "payment_id"), amount)


def parse_order_created(
    records: DataFrame,
    lineage: bool = True,
    watermark: str = EVENT_WATERMARK,
    copy_spread: int = 1,
    observed: str | None = None,
) -> DataFrame:
    """order_created events, once per order id and event time.

    The event time is part of the key because the watermark then bounds the
    state: an id with another event time is another event. ``lineage`` keeps the
    raw text and the Kafka position.

    ``copy_spread`` above 1 is for topics where copies of one message make up a
    large part of the traffic: copies are first dropped in that many groups by
    offset, on as many tasks, and then among the few that are left. The result is
    the same; state and shuffle cost about twice as much.

    ``observed`` names figures that Spark reports with the progress of each batch:
    ``records`` read, ``kept`` and, by reason, those left out (``REJECTIONS``).
    """
    return _events(
        records,
        ORDER_CREATED_PAYLOAD,
        ORDER_CREATED,
        identified=all_present("order_id", "customer_id"),
        amount=None,
        identity="order_id",
        lineage=lineage,
        watermark=watermark,
        copy_spread=copy_spread,
        observed=observed,
    )


def parse_payment_confirmed(
    records: DataFrame,
    lineage: bool = True,
    watermark: str = EVENT_WATERMARK,
    copy_spread: int = 1,
    observed: str | None = None,
) -> DataFrame:
    """payment_confirmed events with a usable value, once per payment id and
    event time. See ``parse_order_created`` for the parameters."""
    return _events(
        records,
        PAYMENT_CONFIRMED_PAYLOAD,
        PAYMENT_CONFIRMED,
        identified=all_present("order_id", "payment_id"),
        amount=usable(F.col("payment_value")),
        identity="payment_id",
        lineage=lineage,
        watermark=watermark,
        copy_spread=copy_spread,
        observed=observed,
    )
