"""Streaming flow: two topics to raw archives, windowed facts and the daily mart."""

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import money
from millrace.operators import quality
from millrace.operators.mart import mart_daily_sales
from millrace.schemas import LANDED, ORDER_FACTS, PAYMENT_FACTS
from millrace.sources.published import publish
from millrace.sources.readers import read_sink_or_empty
from millrace.streaming import facts
from millrace.streaming.compaction import compact, drop_replaced
from millrace.streaming.landing import raw_landing
from millrace.streaming.queries import start_parquet_query
from millrace.streaming.wire import parse_order_created, parse_payment_confirmed


@dataclass(frozen=True)
class Topics:
    """Wire-record streams of the two topics, from Kafka or any other source."""

    orders: DataFrame
    payments: DataFrame


@dataclass(frozen=True)
class Folders:
    """Output tables and query checkpoints, both on storage that executors share."""

    tables: str
    checkpoints: str

    def start(self, stream: DataFrame, name: str, **options) -> StreamingQuery:
        return start_parquet_query(
            stream, f"{self.tables}/{name}", f"{self.checkpoints}/{name}", **options
        )


def start_raw_landing(
    topics: Topics,
    folders: Folders,
    every: str | None = "10 seconds",
    retention: str | None = None,
) -> list[StreamingQuery]:
    """Archive both topics by processing date and hour."""
    by_hour = ("ingest_date", "ingest_hour")
    kept = {"every": every, "partition_by": by_hour, "retention": retention}
    return [
        folders.start(raw_landing(records), name, **kept)
        for name, records in (
            ("raw_order_created", topics.orders),
            ("raw_payment_confirmed", topics.payments),
        )
    ]


def start_order_metrics(
    topics: Topics,
    folders: Folders,
    orders_every: str | None = "10 seconds",
    payments_every: str | None = "30 seconds",
    state_partitions: int | None = None,
    copy_spread: int = 1,
) -> list[StreamingQuery]:
    """Order counts per ten minutes and payment revenue per five."""
    orders = facts.order_count_10m(
        parse_order_created(topics.orders, copy_spread=copy_spread)
    )
    payments = facts.payment_revenue_5m(
        parse_payment_confirmed(topics.payments, copy_spread=copy_spread)
    )
    return [
        folders.start(table, name, every=every, state_partitions=state_partitions)
        for table, name, every in (
            (orders, "order_count_10m", orders_every),
            (payments, "payment_revenue_5m", payments_every),
        )
    ]


def start_facts(
    topics: Topics,
    folders: Folders,
    every: str | None = "10 seconds",
    sketch: bool = False,
    state_partitions: int | None = None,
    copy_spread: int = 1,
) -> list[StreamingQuery]:
    """The five-minute facts that the mart is built from."""
    parsing = {"lineage": False, "copy_spread": copy_spread}
    orders = facts.fact_realtime_orders_5m(
        parse_order_created(topics.orders, **parsing), sketch=sketch
    )
    payments = facts.fact_payment_status_5m(
        parse_payment_confirmed(topics.payments, **parsing)
    )
    return [
        folders.start(table, name, every=every, state_partitions=state_partitions)
        for table, name in (
            (orders, "fact_realtime_orders_5m"),
            (payments, "fact_payment_status_5m"),
        )
    ]


def _facts(spark: SparkSession, folders: Folders) -> tuple[DataFrame, DataFrame]:
    """What both fact streams have committed so far, perhaps nothing."""
    return (
        read_sink_or_empty(
            spark, f"{folders.tables}/fact_realtime_orders_5m", ORDER_FACTS
        ),
        read_sink_or_empty(
            spark, f"{folders.tables}/fact_payment_status_5m", PAYMENT_FACTS
        ),
    )


def mart_from_facts(
    spark: SparkSession, folders: Folders, exact_cents=True, sketched_customers=False
) -> DataFrame:
    return mart_daily_sales(
        *_facts(spark, folders),
        exact_cents=exact_cents,
        sketched_customers=sketched_customers,
    )


def build_mart(spark: SparkSession, folders: Folders, path: str, **options) -> int:
    """Write the mart from the facts so far, check it, then make it the published one.

    Readers take it with ``read_published``. A mart that fails its checks, or whose
    write breaks off, gets no version, and the one before it stays. The version.
    """
    _, payments = _facts(spark, folders)
    revenue = {"payment_revenue is not usable": ~money.usable_sum(F.col("payment_revenue"))}
    quality.require_passed(quality.count_failures(payments, revenue))

    def check(written: DataFrame) -> None:
        quality.require_passed(quality.check_serving(written))

    return publish(mart_from_facts(spark, folders, **options), path, check=check)


def compact_landing(
    spark: SparkSession, folders: Folders, archive: str, closed_before: datetime
) -> dict[str, str | None]:
    """Compact the closed hours of both raw archives, and delete the landing files that
    runs before these have replaced. The names of the runs."""
    done = {}
    for name in ("raw_order_created", "raw_payment_confirmed"):
        landing, copied = f"{folders.tables}/{name}", f"{archive}/{name}"
        done[name] = compact(spark, landing, copied, LANDED, closed_before)
        drop_replaced(spark, landing, copied)
    return done
