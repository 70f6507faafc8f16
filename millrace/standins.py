"""The given tables in the shape of the raw e-commerce tables and streams.

orders stand in for raw orders, lineitem for order items and payments, customer
with its nation and region for customers, events for the event archive and the
two topics. These are projections: no row is left out.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schemas import (
    ORDER_CREATED,
    ORDER_TOPIC,
    PAYMENT_CONFIRMED,
    PAYMENT_TOPIC,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, whether it is one file or a folder of files.

    A file stream takes a folder or a glob, so the name is written as a glob.
    """
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(
        f"{sf_dir}/[{name[0]}]{name[1:]}.parquet"
    )


def raw_orders(orders: DataFrame) -> DataFrame:
    status = F.col("o_orderstatus")
    ordered = F.col("o_orderdate")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(status == "F", "delivered")
        .when(status == "O", " Shipped ")
        .otherwise(status)
        .alias("order_status"),
        ordered.alias("order_purchase_timestamp"),
        ordered.alias("order_approved_at"),
        F.lit(None).cast("timestamp_ntz").alias("order_delivered_carrier_date"),
        F.when(status == "F", ordered).alias("order_delivered_customer_date"),
        (ordered + F.expr("INTERVAL 30 DAYS")).alias("order_estimated_delivery_date"),
    )


def raw_order_items(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_tax").alias("freight_value"),
    )


def raw_payments(lineitem: DataFrame, *more: str) -> DataFrame:
    """Prices less 1,000: some are negative, some below the high-value limit.

    The columns named in ``more`` are kept.
    """
    kind = F.col("l_returnflag")
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(kind == "R", " Credit_Card ")
        .when(kind == "A", "boleto")
        .otherwise(kind)
        .alias("payment_type"),
        F.col("l_quantity").alias("payment_installments"),
        (F.col("l_extendedprice") - 1000).alias("payment_value"),
        *more,
    )


def raw_customers(
    customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """Customers with their nation as city and region as state.

    A customer with a negative balance has no city, so that it counts as unknown.
    """
    places = nation.join(
        region, on=F.col("n_regionkey") == F.col("r_regionkey"), how="left"
    )
    return customer.join(
        places, on=F.col("c_nationkey") == F.col("n_nationkey"), how="left"
    ).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").alias("customer_zip_code_prefix"),
        F.when(F.col("c_acctbal") >= 0, F.col("n_name")).alias("customer_city"),
        F.lower("r_name").alias("customer_state"),
    )


def _event_type() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind == "signup", ORDER_CREATED)
        .when(kind == "purchase", PAYMENT_CONFIRMED)
        .otherwise(kind)
    )


def envelopes(events: DataFrame) -> DataFrame:
    """Archived messages of four partitions. Each event has an offset of its own there;
    every tenth was sent again and is archived twice."""
    again = events.where("event_id % 10 = 0")
    return events.union(again).select(
        F.lit(ORDER_TOPIC).alias("topic"),
        F.expr("event_id % 4").alias("partition"),
        F.expr("event_id div 4").alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        F.struct(
            F.col("event_id").cast("string").alias("order_id"),
            F.col("user_id").cast("string").alias("customer_id"),
            _event_type().alias("event_type"),
            F.col("ts").cast("string").alias("event_time"),
            F.lit(None).cast("string").alias("payment_id"),
            F.col("value").alias("payment_value"),
            F.lit(None).cast("string").alias("delivered_customer_date"),
            F.lit(None).cast("string").alias("invalid_reason"),
        ).alias("value"),
    )


def _records(events: DataFrame, topic: str, *payload: Column) -> DataFrame:
    return _wire(events, topic, F.to_json(F.struct(*payload)))


def _wire(events: DataFrame, topic: str, text: Column) -> DataFrame:
    return events.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        text.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


def order_records(events: DataFrame) -> DataFrame:
    """Wire records of the order topic, one per event of any type."""
    return _records(
        events,
        ORDER_TOPIC,
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        _event_type().alias("event_type"),
        F.col("ts").cast("string").alias("event_time"),
    )


def payment_records(events: DataFrame) -> DataFrame:
    """Wire records of the payment topic, one per event of any type."""
    return _records(
        events,
        PAYMENT_TOPIC,
        F.col("event_id").cast("string").alias("order_id"),
        F.concat(F.lit("P"), F.col("event_id").cast("string")).alias("payment_id"),
        _event_type().alias("event_type"),
        F.col("ts").cast("string").alias("event_time"),
        F.col("value").alias("payment_value"),
    )


def event_orders(events: DataFrame) -> DataFrame:
    """Sign-ups as raw orders that have a time of day, for hourly work.

    Events of other types come along as orders with another status.
    """
    return events.select(
        F.col("event_id").alias("order_id"),
        F.col("user_id").alias("customer_id"),
        F.when(F.col("event_type") == "signup", "delivered")
        .otherwise("created")
        .alias("order_status"),
        F.col("ts").alias("order_purchase_timestamp"),
        F.col("ts").alias("order_approved_at"),
        F.col("ts").alias("order_delivered_customer_date"),
        F.col("ts").alias("order_estimated_delivery_date"),
    )


def event_payments(events: DataFrame) -> DataFrame:
    """Every event as the payment of the order of the same id."""
    return events.select(
        F.col("event_id").alias("order_id"),
        F.lit(1).alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"),
        F.lit(1).alias("payment_installments"),
        F.col("value").alias("payment_value"),
    )


#: Batches that a table of events arrives in; days of one; batches a late event waits.
BATCHES, DAYS_OF_BATCH, BATCHES_LATE = 6, 5, 2


def arrival_batch(events: DataFrame) -> Column:
    """The batch in which an event arrives: by its day, but every twentieth is late."""
    first = F.lit("2024-01-01").cast("date")
    in_time = F.floor(F.date_diff(F.to_date("ts"), first) / DAYS_OF_BATCH)
    late = F.when(F.col("event_id") % 20 == 0, BATCHES_LATE).otherwise(0)
    return F.greatest(F.lit(0), F.least(F.lit(BATCHES - 1), in_time + late)).cast("int")


def write_batch(events: DataFrame, path: str, batches: range) -> None:
    """Add the events of some batches to a folder, one file after the other."""
    batch = arrival_batch(events)
    for number in batches:
        events.where(batch == number).coalesce(1).write.mode("append").parquet(path)


def batch_stream(spark: SparkSession, path: str, events: DataFrame) -> DataFrame:
    """The files of ``write_batch`` as a stream of one file per batch."""
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1)
    return stream.parquet(path)


def faulty_payment_records(events: DataFrame) -> DataFrame:
    """Payment records of which nine in fifty have a fault of one kind each."""
    kind = F.col("event_id") % 50
    payload = {
        "order_id": F.when(kind != 7, F.col("event_id").cast("string")),
        "payment_id": F.concat(F.lit("P"), F.col("event_id").cast("string")),
        "event_type": F.when(kind != 8, _event_type()),
        "event_time": F.when(kind == 6, "soon").otherwise(F.col("ts").cast("string")),
        "payment_value": F.when(kind == 3, "a lot")
        .when(kind == 4, "-1.5")
        .when(kind == 5, "1e15")
        .otherwise(F.col("value").cast("string")),
    }
    text = F.to_json(F.struct(*(value.alias(name) for name, value in payload.items())))
    number = r'"payment_value":"([-0-9.eE]+)"'
    text = F.regexp_replace(text, number, '"payment_value":$1')
    text = F.when(kind == 1, "not json").when(kind == 2, F.substring(text, 1, 20)).when(kind != 9, text)
    return _wire(events, PAYMENT_TOPIC, text)


def payment_records_at(events: DataFrame, moment: str) -> DataFrame:
    """Payment records that all have one event time, as a replay without times sends."""
    return payment_records(events.withColumn("ts", F.lit(moment).cast("timestamp_ntz")))
