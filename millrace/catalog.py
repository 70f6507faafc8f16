"""Every operator as a query over the given tables.

Each query takes the session and the folder of the tables. Raw tables go through
the staging operators first, as they would in production, so the aggregates see
the keys they rely on. Money is added in exact cents, as the operators do by
default, which makes results equal on any engine and any partitioning. Columns that hold the time of the run are
dropped, and dates and timestamps are returned as timestamps without a zone,
which is how the given tables hold them.
"""

from collections.abc import Callable
from datetime import datetime
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from millrace import schemas, standins
from millrace.operators import events as messages
from millrace.operators import gold, payments, quality, staging
from millrace.operators.layout import compare_layouts
from millrace.operators.mart import mart_daily_sales
from millrace.operators.profile import profile_table
from millrace.plans.near_realtime import (
    Folders,
    Topics,
    mart_from_facts,
    start_facts,
    start_order_metrics,
    start_raw_landing,
)
from millrace.sources.published import drop_versions, publish, read_published
from millrace.sources.readers import read_csv, read_events, read_table
from millrace.sources.sinks import write_messages, write_table
from millrace.sources.workspace import new_folder
from millrace.streaming import compaction, facts
from millrace.streaming.landing import raw_landing
from millrace.streaming.queries import late_rows, observed, run_to_end, start_parquet_query, stop_after
from millrace.streaming.wire import REJECTIONS, parse_order_created, parse_payment_confirmed, rejected_payments

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TIME_OF_RUN = ("processed_at", "source_refresh_ts", "ingest_date", "ingest_hour")


def _comparable(result: DataFrame) -> DataFrame:
    kept = result.drop(*TIME_OF_RUN)
    return kept.select(
        *(
            F.col(field.name).cast("timestamp_ntz").alias(field.name)
            if isinstance(field.dataType, (DateType, TimestampType))
            else F.col(field.name)
            for field in kept.schema
        )
    )


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return _comparable(function(spark, sf_dir))

    QUERIES[function.__name__] = run
    return run


# Raw and staged views of the given tables


def _raw_orders(spark, sf_dir):
    return standins.raw_orders(standins.table(spark, sf_dir, "orders"))


def _raw_items(spark, sf_dir):
    return standins.raw_order_items(standins.table(spark, sf_dir, "lineitem"))


def _raw_payments(spark, sf_dir):
    return standins.raw_payments(standins.table(spark, sf_dir, "lineitem"))


def _odd_payments(spark, sf_dir):
    """Payments as text; of every hundred parts a few have no usable price."""
    part = F.col("l_partkey") % 100
    lines = standins.table(spark, sf_dir, "lineitem")
    value = F.col("payment_value").cast("string")
    odd = F.when(part == 1, "NaN").when(part == 2, "Infinity").when(part == 3, "1e15")
    odd = odd.when(part == 4, "a lot").when(part == 5, "-Infinity")
    planted = lines.select(F.struct("*").alias("line"), odd.alias("odd"))
    raw = standins.raw_payments(planted.select("line.*", "odd"), "odd")
    return raw.withColumn("payment_value", F.coalesce("odd", value)).drop("odd")


def _raw_customers(spark, sf_dir):
    names = ("customer", "nation", "region")
    return standins.raw_customers(*(standins.table(spark, sf_dir, n) for n in names))


def _events(spark, sf_dir):
    return standins.table(spark, sf_dir, "events")


def _orders(spark, sf_dir):
    return staging.stage_orders(_raw_orders(spark, sf_dir))


def _payments(spark, sf_dir):
    return staging.stage_payments(_raw_payments(spark, sf_dir))


def _event_orders(spark, sf_dir):
    return staging.stage_orders(standins.event_orders(_events(spark, sf_dir)))


def _event_payments(spark, sf_dir):
    return staging.stage_payments(standins.event_payments(_events(spark, sf_dir)))


def _sales(spark, sf_dir):
    return gold.daily_sales_summary(
        _orders(spark, sf_dir), _payments(spark, sf_dir)
    )


def _estimate_checked(summary: DataFrame) -> DataFrame:
    """Replace the estimate by whether it is within its error bound."""
    exact, estimate = "unique_customer_count", "approx_unique_customer_count"
    close = F.abs(F.col(estimate) - F.col(exact)) <= 0.15 * F.col(exact) + 1
    return summary.withColumn("estimate_is_close", close).drop(estimate)


# Staging


@query
def preview_orders(spark, sf_dir):
    return staging.preview_orders(_raw_orders(spark, sf_dir))


@query
def clean_orders_basic(spark, sf_dir):
    return staging.clean_orders_basic(_raw_orders(spark, sf_dir))


@query
def curate_orders(spark, sf_dir):
    return staging.curate_orders(_raw_orders(spark, sf_dir))


@query
def stage_orders(spark, sf_dir):
    return _orders(spark, sf_dir)


@query
def curate_order_items(spark, sf_dir):
    return staging.curate_order_items(_raw_items(spark, sf_dir))


@query
def stage_order_items(spark, sf_dir):
    return staging.stage_order_items(_raw_items(spark, sf_dir))


@query
def stage_payments(spark, sf_dir):
    return _payments(spark, sf_dir)


@query
def stage_customers(spark, sf_dir):
    return staging.stage_customers(_raw_customers(spark, sf_dir))


@query
def curate_order_events(spark, sf_dir):
    return staging.curate_order_events(standins.envelopes(_events(spark, sf_dir)))


@query
def stage_order_events(spark, sf_dir):
    return staging.stage_order_events(standins.envelopes(_events(spark, sf_dir)))


@query
def stage_order_events_by_key(spark, sf_dir):
    """The archive by message key and offset, as older archives have it."""
    archive = standins.envelopes(_events(spark, sf_dir))
    return staging.stage_order_events(archive, keys=staging.MESSAGE_KEY)


@query
def rejected_amounts(spark, sf_dir):
    """What the payments lose to odd amounts, some of them planted."""
    return quality.rejected_amounts(_odd_payments(spark, sf_dir), "payment_value")


@query
def stage_payments_odd_amounts(spark, sf_dir):
    return staging.stage_payments(_odd_payments(spark, sf_dir))


# Aggregates


@query
def payments_by_order(spark, sf_dir):
    return payments.payments_by_order(_payments(spark, sf_dir))


@query
def payment_facts_by_order(spark, sf_dir):
    return payments.payment_facts_by_order(_payments(spark, sf_dir))


@query
def orders_with_payments(spark, sf_dir):
    per_order = payments.payments_by_order(_payments(spark, sf_dir))
    return payments.orders_with_payments(_orders(spark, sf_dir), per_order)


@query
def daily_orders_payments_summary(spark, sf_dir):
    per_order = payments.payments_by_order(_payments(spark, sf_dir))
    enriched = payments.orders_with_payments(_orders(spark, sf_dir), per_order)
    return gold.daily_orders_payments_summary(enriched)


@query
def daily_sales_summary(spark, sf_dir):
    return _estimate_checked(_sales(spark, sf_dir))


@query
def hourly_order_summary(spark, sf_dir):
    return _estimate_checked(gold.hourly_order_summary(_event_orders(spark, sf_dir)))


@query
def orders_by_city_day(spark, sf_dir):
    customers = staging.stage_customers(_raw_customers(spark, sf_dir))
    return gold.orders_by_city_day(_orders(spark, sf_dir), customers)


@query
def payment_ratio_by_day(spark, sf_dir):
    return gold.payment_ratio_by_day(
        _orders(spark, sf_dir), _payments(spark, sf_dir)
    )


@query
def top_products_by_day(spark, sf_dir):
    items = staging.stage_order_items(_raw_items(spark, sf_dir))
    return gold.top_products_by_day(_orders(spark, sf_dir), items)


@query
def payment_ratio_by_day_of_copies(spark, sf_dir):
    """The same from orders that come twice, counted as distinct ids."""
    orders = _orders(spark, sf_dir)
    return gold.payment_ratio_by_day(
        orders.union(orders), _payments(spark, sf_dir), unique_orders=False
    )


@query
def all_products_by_day(spark, sf_dir):
    """More products per day than Spark limits by itself before the shuffle."""
    items = staging.stage_order_items(_raw_items(spark, sf_dir))
    return gold.top_products_by_day(_orders(spark, sf_dir), items, k=2000)


# Checks and reports


@query
def daily_vs_hourly(spark, sf_dir):
    orders = _event_orders(spark, sf_dir)
    daily = gold.daily_sales_summary(
        orders, _event_payments(spark, sf_dir)
    )
    return quality.daily_vs_hourly(daily, gold.hourly_order_summary(orders))


@query
def validate_gold(spark, sf_dir):
    orders = _event_orders(spark, sf_dir)
    daily = gold.daily_sales_summary(
        orders, _event_payments(spark, sf_dir)
    )
    return quality.validate_gold(daily, gold.hourly_order_summary(orders))


@query
def validate_gold_missing_days(spark, sf_dir):
    """Tables that each lack a day, and staged orders that come twice."""
    orders = _event_orders(spark, sf_dir)
    payments_of_none = _event_payments(spark, sf_dir).limit(0)
    daily = gold.daily_sales_summary(orders, payments_of_none)
    hourly = gold.hourly_order_summary(orders)
    return quality.validate_gold(
        daily.withColumn("delivered_order_count", F.lit(0)).where("day(event_date) <> 5"),
        hourly.where("day(event_date) <> 7"),
        staged_orders=orders.union(orders.where("order_id % 3 = 0")),
    )


@query
def validate_unchecked_daily(spark, sf_dir):
    """The same rules over order rows that break some of them."""
    rows = standins.table(spark, sf_dir, "orders").select(
        F.to_date("o_orderdate").alias("event_date"),
        F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(1).alias(
            "order_count"
        ),
        (F.col("o_totalprice") - 50_000).alias("total_revenue"),
        F.when(F.col("o_orderstatus") == "F", 2).otherwise(0).alias(
            "orders_with_payment"
        ),
        F.when(F.col("o_orderstatus") == "O", 1).otherwise(0).alias(
            "delivered_order_count"
        ),
    )
    hourly = rows.select("event_date", F.lit(1).alias("order_count"))
    return quality.validate_gold(rows, hourly)


@query
def check_serving(spark, sf_dir):
    return quality.check_serving(_batch_mart(spark, sf_dir))


@query
def table_profiles(spark, sf_dir):
    tables = {
        "stg_orders": _orders(spark, sf_dir),
        "stg_order_items": staging.stage_order_items(_raw_items(spark, sf_dir)),
        "stg_payments": _payments(spark, sf_dir),
        "stg_customers": staging.stage_customers(_raw_customers(spark, sf_dir)),
    }
    counts = [
        profile_table(table).row_count.withColumn("table_name", F.lit(name))
        for name, table in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query
def daily_sales_head(spark, sf_dir):
    summary = _estimate_checked(_sales(spark, sf_dir))
    return profile_table(summary, "event_date", rows=30).head


@query
def best_sales_days(spark, sf_dir):
    """A head by descending revenue, equal revenues by date."""
    order = (F.desc("total_revenue"), F.asc("event_date"))
    return profile_table(_estimate_checked(_sales(spark, sf_dir)), *order, rows=30).head


@query
def partition_layouts(spark, sf_dir):
    layouts = {
        "by_event_date": ["event_date"],
        "by_year_month": ["summary_year", "summary_month"],
    }
    folder = new_folder(spark, "layouts")
    write_table(_sales(spark, sf_dir), f"{folder}/summary")
    return compare_layouts(read_table(spark, f"{folder}/summary"), layouts, folder)


# Files in between


@query
def csv_orders_scan(spark, sf_dir):
    path = new_folder(spark, "raw-orders")
    text = _raw_orders(spark, sf_dir).select(
        *(F.col(name).cast("string") for name in schemas.RAW_ORDERS.names)
    )
    text.write.option("header", True).csv(path)
    return staging.curate_orders(read_csv(spark, path, schemas.RAW_ORDERS))


@query
def jsonl_events_scan(spark, sf_dir):
    path = new_folder(spark, "raw-events")
    write_messages(standins.envelopes(_events(spark, sf_dir)), path)
    return staging.stage_order_events(read_events(spark, path))


@query
def partitioned_orders_scan(spark, sf_dir):
    """Curated orders, read back from a layout by year and month."""
    path = new_folder(spark, "curated-orders")
    curated = staging.curate_orders(_raw_orders(spark, sf_dir))
    write_table(curated, path, ["order_year", "order_month"])
    return read_table(spark, path)


@query
def order_created_events(spark, sf_dir):
    return messages.order_created_events(_raw_orders(spark, sf_dir))


@query
def payment_confirmed_events(spark, sf_dir):
    return messages.payment_confirmed_events(_raw_payments(spark, sf_dir))


@query
def first_order_created_events(spark, sf_dir):
    return messages.order_created_events(_raw_orders(spark, sf_dir), limit=100)


@query
def timed_payment_events(spark, sf_dir):
    """Payments with the time at which their line was shipped; a tenth have none."""
    shipped = F.when(F.col("l_partkey") % 10 != 0, F.col("l_shipdate"))
    lines = standins.table(spark, sf_dir, "lineitem").withColumn("shipped", shipped)
    raw = standins.raw_payments(lines, "shipped")
    return messages.payment_confirmed_events(raw, event_time=F.col("shipped"))


# Streams: run over everything there is, then read what they wrote


def _topics(spark, sf_dir) -> Topics:
    events = standins.table_stream(spark, sf_dir, "events")
    return Topics(standins.order_records(events), standins.payment_records(events))


def _stream_folders(spark) -> Folders:
    folder = new_folder(spark, "stream")
    return Folders(f"{folder}/tables", f"{folder}/checkpoints")


def _streamed(spark, stream: DataFrame) -> DataFrame:
    folders = _stream_folders(spark)
    run_to_end(folders.start(stream, "result", every=None))
    return read_table(spark, f"{folders.tables}/result")


def _in_full_cents(windows: DataFrame) -> DataFrame:
    """Revenue to the cent and average to six digits, for comparing engines."""
    digits = {"payment_revenue": 2, "avg_payment_value": 6}
    return windows.withColumns(
        {
            name: F.round(name, places)
            for name, places in digits.items()
            if name in windows.columns
        }
    )


@query
def stream_parse_order_created(spark, sf_dir):
    return _streamed(spark, parse_order_created(_topics(spark, sf_dir).orders))


@query
def stream_parse_payment_confirmed(spark, sf_dir):
    return _streamed(spark, parse_payment_confirmed(_topics(spark, sf_dir).payments))


@query
def stream_order_count_10m(spark, sf_dir):
    orders = parse_order_created(_topics(spark, sf_dir).orders)
    return _streamed(spark, facts.order_count_10m(orders))


@query
def stream_order_count_10m_redelivered(spark, sf_dir):
    """Every record arrives twice; copies are spread over tasks and dropped."""
    records = _topics(spark, sf_dir).orders
    orders = parse_order_created(records.union(records), copy_spread=4)
    return _streamed(spark, facts.order_count_10m(orders))


@query
def stream_payment_revenue_5m(spark, sf_dir):
    paid = parse_payment_confirmed(_topics(spark, sf_dir).payments)
    return _in_full_cents(_streamed(spark, facts.payment_revenue_5m(paid)))


@query
def stream_fact_orders_5m(spark, sf_dir):
    orders = parse_order_created(_topics(spark, sf_dir).orders, lineage=False)
    windows = _streamed(spark, facts.fact_realtime_orders_5m(orders))
    archive = parse_order_created(
        standins.order_records(_events(spark, sf_dir)), lineage=False
    )
    exact = archive.groupBy(
        F.window("event_ts", "5 minutes").getField("start").alias("window_start")
    ).agg(F.count_distinct("customer_id").alias("_exact"))
    estimate = F.col("unique_customer_count")
    close = F.abs(estimate - F.col("_exact")) <= 0.15 * F.col("_exact") + 1
    checked = windows.join(exact, on="window_start", how="left")
    checked = checked.withColumn("estimate_is_close", close)
    return checked.drop("unique_customer_count", "_exact")


@query
def stream_fact_payments_5m(spark, sf_dir):
    paid = parse_payment_confirmed(_topics(spark, sf_dir).payments, lineage=False)
    return _in_full_cents(_streamed(spark, facts.fact_payment_status_5m(paid)))


@query
def stream_order_metrics(spark, sf_dir):
    """Both queries of one session at once: order counts and payment revenue."""
    folders = _stream_folders(spark)
    topics = _topics(spark, sf_dir)
    run_to_end(
        *start_order_metrics(topics, folders, orders_every=None, payments_every=None)
    )
    orders = read_table(spark, f"{folders.tables}/order_count_10m")
    paid = _in_full_cents(read_table(spark, f"{folders.tables}/payment_revenue_5m"))
    return orders.select(
        F.lit("orders").alias("metric"),
        "window_start",
        "window_end",
        F.col("order_created_count").alias("event_count"),
        F.lit(0.0).alias("revenue"),
    ).unionByName(
        paid.select(
            F.lit("payments").alias("metric"),
            "window_start",
            "window_end",
            F.col("payment_confirmed_count").alias("event_count"),
            F.col("payment_revenue").alias("revenue"),
        )
    )


@query
def stream_raw_landing(spark, sf_dir):
    folders = _stream_folders(spark)
    run_to_end(*start_raw_landing(_topics(spark, sf_dir), folders, every=None))
    tables = ("raw_order_created", "raw_payment_confirmed")
    landed = [read_table(spark, f"{folders.tables}/{name}") for name in tables]
    return landed[0].unionByName(landed[1])


@query
def landing_by_hour(spark, sf_dir):
    """A landed archive laid out by the broker's hour, counted per folder."""
    records = standins.order_records(standins.table_stream(spark, sf_dir, "events"))
    folder = new_folder(spark, "landing")
    landed = raw_landing(records, processed_at=F.col("kafka_ingest_ts"))
    run_to_end(
        start_parquet_query(
            landed,
            f"{folder}/table",
            f"{folder}/checkpoint",
            every=None,
            partition_by=("ingest_date", "ingest_hour"),
        )
    )
    hours = read_table(spark, f"{folder}/table").groupBy(
        F.col("ingest_date").alias("landing_date"),
        F.col("ingest_hour").alias("landing_hour"),
    )
    return hours.agg(F.count("*").alias("record_count"))


def _by_landing_date(rows: DataFrame) -> DataFrame:
    """How many records of a day there are, and a sum over what they say."""
    return rows.groupBy(F.col("ingest_date").alias("landing_date")).agg(
        F.count("*").alias("record_count"),
        F.sum(F.crc32(F.col("raw_json").cast("binary"))).alias("text_sum"),
    )


@query
def landing_compacted(spark, sf_dir):
    """A landed archive by the broker's day, in six batches and two compactions.

    Half of the batches land, the first ten days are compacted, the other half lands
    with late records of those days, all is compacted, and what the first run has
    replaced is deleted. Per day: what readers find, whether it is what landed, and
    whether it lies in fewer files.
    """
    events = _events(spark, sf_dir)
    folder = new_folder(spark, "compaction")
    landing, archive = f"{folder}/landing", f"{folder}/archive"
    schema = schemas.LANDED

    def land(batches):
        standins.write_batch(events, f"{folder}/topic", batches)
        records = standins.order_records(standins.batch_stream(spark, f"{folder}/topic", events))
        day = F.date_trunc("day", "kafka_ingest_ts")
        run_to_end(
            start_parquet_query(
                raw_landing(records, processed_at=day),
                landing,
                f"{folder}/checkpoint",
                every=None,
                partition_by=compaction.HOUR,
            )
        )

    def files_of(rows):
        days = rows.groupBy(F.col("ingest_date").alias("landing_date"))
        return days.agg(F.count_distinct("_metadata.file_path").alias("files"))

    land(range(3))
    compaction.compact(spark, landing, archive, schema, datetime(2024, 1, 11))
    land(range(3, standins.BATCHES))
    landed = read_table(spark, landing)
    before = _by_landing_date(landed).join(files_of(landed), "landing_date")
    write_table(before, f"{folder}/before")
    compaction.compact(spark, landing, archive, schema, datetime(2100, 1, 1))
    compaction.drop_replaced(spark, landing, archive)
    found = compaction.read_landed(spark, landing, archive, schema)
    hours = read_table(spark, f"{archive}/hours")
    after = _by_landing_date(found).join(files_of(hours), "landing_date")
    was = read_table(spark, f"{folder}/before").select(
        "landing_date", *(F.col(name).alias(f"old_{name}") for name in ("record_count", "text_sum", "files"))
    )
    same = (F.col("record_count") == F.col("old_record_count")) & (F.col("text_sum") == F.col("old_text_sum"))
    fewer = (F.col("files") < F.col("old_files")) | (F.col("old_files") <= 2)
    return after.join(was, "landing_date").select(
        "landing_date", "record_count", same.alias("rows_are_equal"), fewer.alias("files_are_fewer")
    )


@query
def stream_late_orders(spark, sf_dir):
    """Order counts over six batches in which every twentieth event comes late, with
    the rows of all batches that came too late."""
    events = _events(spark, sf_dir)
    folders = _stream_folders(spark)
    topic = f"{folders.tables}/topic"
    standins.write_batch(events, topic, range(standins.BATCHES))
    orders = parse_order_created(standins.order_records(standins.batch_stream(spark, topic, events)))
    running = folders.start(facts.order_count_10m(orders), "result", every=None)
    run_to_end(running)
    windows = read_table(spark, f"{folders.tables}/result")
    return windows.withColumn("late_rows", F.lit(late_rows(running)).cast("long"))


@query
def stream_late_orders_resumed(spark, sf_dir):
    """The same stream, stopped after two batches and resumed from its checkpoint."""
    events = _events(spark, sf_dir)
    folders = _stream_folders(spark)
    topic = f"{folders.tables}/topic"
    standins.write_batch(events, topic, range(standins.BATCHES))

    def start(every):
        records = standins.order_records(standins.batch_stream(spark, topic, events))
        return folders.start(facts.order_count_10m(parse_order_created(records)), "result", every=every)

    last = stop_after(start("100 milliseconds"), batches=2)
    run_to_end(start(None))
    windows = read_table(spark, f"{folders.tables}/result")
    return windows.withColumn("was_stopped_underway", F.lit(last >= 1))


@query
def stream_rejected_payments(spark, sf_dir):
    """By batch, the payments kept and, by reason, the records left out, as the stream
    itself counts them."""
    events = _events(spark, sf_dir)
    folders = _stream_folders(spark)
    topic = f"{folders.tables}/topic"
    standins.write_batch(events, topic, range(standins.BATCHES))
    records = standins.faulty_payment_records(standins.batch_stream(spark, topic, events))
    parsed = parse_payment_confirmed(records, observed="payments")
    running = folders.start(parsed, "result", every=None)
    run_to_end(running)
    counts = [
        (batch, reason, figures[reason], figures["records"] == sum(figures.values()) - figures["records"])
        for batch, figures in observed(running, "payments")
        for reason in ("kept", *REJECTIONS)
    ]
    return spark.createDataFrame(counts, "batch long, reason string, record_count long, adds_up boolean")


@query
def rejected_payments_by_reason(spark, sf_dir):
    """The records that payment parsing leaves out, over the whole archive."""
    records = standins.faulty_payment_records(_events(spark, sf_dir))
    return rejected_payments(records).groupBy("reason").agg(F.count("*").alias("record_count"))


# Mart


def _batch_facts(spark, sf_dir, sketch=False) -> tuple[DataFrame, DataFrame]:
    """The five-minute facts over the whole archive, with no window held back."""
    events = _events(spark, sf_dir)
    orders = parse_order_created(standins.order_records(events), lineage=False)
    paid = parse_payment_confirmed(standins.payment_records(events), lineage=False)
    return (
        facts.fact_realtime_orders_5m(orders, sketch=sketch),
        facts.fact_payment_status_5m(paid),
    )


def _batch_mart(spark, sf_dir):
    return mart_daily_sales(*_batch_facts(spark, sf_dir))


@query
def mart_daily_sales_from_archive(spark, sf_dir):
    return _batch_mart(spark, sf_dir).drop("unique_customer_count")


def _close(estimate: str, truth: str):
    return F.abs(F.col(estimate) - F.col(truth)) <= 0.15 * F.col(truth) + 1


def _customers(orders: DataFrame) -> DataFrame:
    """Exact customers of each day, once per window and once per day, in one pass."""
    day = "sales_date"
    per_window = orders.groupBy(
        F.to_date("event_ts").alias(day),
        F.window("event_ts", "5 minutes").getField("start").alias("start"),
        "customer_id",
    ).agg(F.count("*").alias("orders"))
    per_customer = per_window.groupBy(day, "customer_id").agg(F.count("*").alias("windows"))
    return per_customer.groupBy(day).agg(
        F.sum("windows").alias("window_customers"), F.count("customer_id").alias("day_customers")
    )


@query
def mart_daily_sales_from_streams(spark, sf_dir):
    """The mart from streamed facts with sketches kept in their state.

    Its customers are estimates, once added up over windows and once merged over the
    day; both are compared with exact counts over the windows that have closed.
    """
    folders = _stream_folders(spark)
    run_to_end(*start_facts(_topics(spark, sf_dir), folders, every=None, sketch=True))
    merged = mart_from_facts(spark, folders, sketched_customers=True)
    merged = merged.withColumnRenamed("unique_customer_count", "merged")
    added = mart_from_facts(spark, folders).select("sales_date", F.col("unique_customer_count").alias("added"))
    closed = read_table(spark, f"{folders.tables}/fact_realtime_orders_5m").select("window_start")
    orders = parse_order_created(standins.order_records(_events(spark, sf_dir)), lineage=False)
    window = F.window("event_ts", "5 minutes").getField("start")
    exact = _customers(orders.withColumn("window_start", window).join(closed, "window_start", "left_semi"))
    rows = merged.join(added, "sales_date").join(exact, "sales_date")
    return rows.withColumns(
        {
            "unique_customer_count_is_close": _close("added", "window_customers"),
            "sketched_customer_count_is_close": _close("merged", "day_customers"),
        }
    ).drop("merged", "added", "window_customers", "day_customers")


@query
def mart_of_flat_replay(spark, sf_dir):
    """The mart when a replay gives all payments one time: none of their windows ever
    closes, the payment stream commits no row, and every day has revenue zero."""
    folders = _stream_folders(spark)
    events = standins.table_stream(spark, sf_dir, "events")
    flat = standins.payment_records_at(events, schemas.REPLAY_EVENT_TIME)
    run_to_end(*start_facts(Topics(standins.order_records(events), flat), folders, every=None))
    return mart_from_facts(spark, folders).drop("unique_customer_count")


@query
def mart_published_twice(spark, sf_dir):
    """The published mart after a first version of half of the facts, a second of all,
    and a third that failed its check."""
    path = new_folder(spark, "mart")
    order_facts, payment_facts = _batch_facts(spark, sf_dir)
    half = F.col("window_start") < F.lit("2024-01-16").cast("timestamp")
    publish(mart_daily_sales(order_facts.where(half), payment_facts.where(half)), path)
    mart = mart_daily_sales(order_facts, payment_facts)
    publish(mart, path, check=lambda written: quality.require_passed(quality.check_serving(written)))

    def refuse(written):
        raise quality.QualityError("refused")

    try:
        publish(mart.limit(0), path, check=refuse)
    except quality.QualityError:
        drop_versions(spark, path, keep=1)
    return read_published(spark, path).drop("unique_customer_count")


@query
def mart_customer_estimates(spark, sf_dir):
    """Both customer counts of the mart against exact counts.

    The additive count is compared with the sum of exact per-window counts, the
    sketched one with the exact distinct customers of the day.
    """
    events = _events(spark, sf_dir)
    orders = parse_order_created(standins.order_records(events), lineage=False)
    path = new_folder(spark, "estimates")
    write_table(facts.fact_realtime_orders_5m(orders, sketch=True), path)
    order_facts = read_table(spark, path)
    no_payments = spark.createDataFrame([], schemas.PAYMENT_FACTS)
    estimates = {"added": False, "merged": True}
    added, merged = (
        mart_daily_sales(order_facts, no_payments, sketched_customers=sketched).select(
            "sales_date", F.col("unique_customer_count").alias(name)
        )
        for name, sketched in estimates.items()
    )
    days = added.join(merged, "sales_date")
    return _customers(orders).join(days, "sales_date").select(
        "sales_date",
        "window_customers",
        "day_customers",
        _close("added", "window_customers").alias("added_is_close"),
        _close("merged", "day_customers").alias("merged_is_close"),
    )
