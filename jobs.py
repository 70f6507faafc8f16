"""Run one step of the flows with spark-submit.

    spark-submit jobs.py staged --raw RAW --curated CURATED --gold GOLD
    spark-submit --packages <Spark's Kafka package> jobs.py facts
        --servers HOST:PORT --tables TABLES --checkpoints CHECKPOINTS

Session settings (master, memory, partitions) come from spark-submit.
"""

import argparse
from datetime import UTC, datetime, timedelta

from pyspark.sql import SparkSession

from millrace import schemas
from millrace.operators.events import order_created_events, payment_confirmed_events
from millrace.operators.staging import MESSAGE_KEY, MESSAGE_POSITION
from millrace.plans import near_realtime, warehouse
from millrace.sources.readers import kafka_stream
from millrace.sources.published import drop_versions
from millrace.sources.sinks import publish_messages
from millrace.streaming.queries import await_any

BATCH = {
    "curated": warehouse.build_curated,
    "staged": warehouse.build_staged,
    "daily-orders-payments": warehouse.build_daily_orders_payments,
    "gold": warehouse.build_gold,
    "validate": warehouse.validate,
}
EVENT_KEYS = {"position": MESSAGE_POSITION, "message": MESSAGE_KEY}
STREAMS = {
    "landing": near_realtime.start_raw_landing,
    "order-metrics": near_realtime.start_order_metrics,
    "facts": near_realtime.start_facts,
}


def _arguments(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in [*BATCH, "amounts", "replay"]:
        job = jobs.add_parser(name)
        if name in ("curated", "staged"):
            job.add_argument("--event-key", choices=EVENT_KEYS, default="position")
        if name == "validate":
            job.add_argument("--matched-days-only", action="store_true")
        if name == "gold":
            job.add_argument("--top-products", type=int, default=10)
        for layer in ("raw", "curated", "gold"):
            job.add_argument(f"--{layer}", default=f"data/{layer}")
        if name == "replay":
            job.add_argument("--servers", required=True)
            job.add_argument("--limit", type=int)
    for name in STREAMS:
        job = jobs.add_parser(name)
        job.add_argument("--servers", required=True)
        job.add_argument("--min-partitions", type=int)
        job.add_argument("--max-offsets-per-trigger", type=int)
        job.add_argument("--fail-on-data-loss", action="store_true")
        job.add_argument("--every", default="10 seconds")
        if name != "landing":
            job.add_argument("--state-partitions", type=int)
            job.add_argument("--copy-spread", type=int, default=1)
        if name == "order-metrics":
            job.add_argument("--payments-every", default="30 seconds")
        if name == "facts":
            job.add_argument("--sketch", action="store_true")
        if name == "landing":
            job.add_argument("--retention")
    mart = jobs.add_parser("mart")
    mart.add_argument("--mart", default="data/serving/mart_daily_sales")
    mart.add_argument("--sketched-customers", action="store_true")
    mart.add_argument("--keep-versions", type=int, default=2)
    compaction = jobs.add_parser("compact")
    compaction.add_argument("--archive", default="data/archive")
    compaction.add_argument("--grace-minutes", type=int, default=10)
    for name in [*STREAMS, "mart", "compact"]:
        jobs.choices[name].add_argument("--tables", default="data/streaming")
        jobs.choices[name].add_argument("--checkpoints", default="data/checkpoints")
    return parser.parse_args(words)


def stream_options(options: argparse.Namespace) -> dict:
    """The options of a stream job as its plan takes them."""
    if options.job == "landing":
        return {"every": options.every, "retention": options.retention}
    stateful = {
        "state_partitions": options.state_partitions,
        "copy_spread": options.copy_spread,
    }
    if options.job == "facts":
        return stateful | {"every": options.every, "sketch": options.sketch}
    return stateful | {
        "orders_every": options.every,
        "payments_every": options.payments_every,
    }


def main() -> None:
    options = _arguments()
    spark = SparkSession.builder.appName(f"millrace {options.job}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if options.job in [*BATCH, "amounts", "replay"]:
        house = warehouse.Warehouse(spark, options.raw, options.curated, options.gold)
        if options.job == "amounts":
            warehouse.amount_report(house).show(truncate=False)
            return
        if options.job in ("curated", "staged"):
            BATCH[options.job](house, EVENT_KEYS[options.event_key])
            return
        if options.job == "validate":
            warehouse.validate(house, not options.matched_days_only)
            return
        if options.job == "gold":
            warehouse.build_gold(house, options.top_products)
            return
        if options.job in BATCH:
            BATCH[options.job](house)
            return
        orders = order_created_events(house.raw_orders(), options.limit)
        paid = payment_confirmed_events(house.raw_payments(), options.limit)
        publish_messages(orders, options.servers, schemas.ORDER_TOPIC)
        publish_messages(paid, options.servers, schemas.PAYMENT_TOPIC)
        return
    folders = near_realtime.Folders(options.tables, options.checkpoints)
    if options.job == "mart":
        near_realtime.build_mart(
            spark, folders, options.mart, sketched_customers=options.sketched_customers
        )
        drop_versions(spark, options.mart, keep=options.keep_versions)
        return
    if options.job == "compact":
        closed_before = datetime.now(UTC) - timedelta(minutes=options.grace_minutes)
        near_realtime.compact_landing(spark, folders, options.archive, closed_before)
        return
    topics = near_realtime.Topics(
        *(
            kafka_stream(
                spark,
                options.servers,
                topic,
                fail_on_data_loss=options.fail_on_data_loss,
                min_partitions=options.min_partitions,
                max_offsets_per_trigger=options.max_offsets_per_trigger,
            )
            for topic in (schemas.ORDER_TOPIC, schemas.PAYMENT_TOPIC)
        )
    )
    STREAMS[options.job](topics, folders, **stream_options(options))
    await_any(spark)


if __name__ == "__main__":
    main()
