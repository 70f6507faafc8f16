"""The batch flow from CSV and JSON files to checked gold tables."""

import json

import pytest

import jobs
from millrace.operators.quality import QualityError
from millrace.plans import warehouse
from millrace.plans.warehouse import Warehouse
from millrace.sources.sinks import write_table


@pytest.fixture
def house(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()

    def csv(name, header, *lines):
        (raw / name).mkdir()
        (raw / name / "part.csv").write_text("\n".join([header, *lines]) + "\n")

    csv(
        "orders",
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date",
        "o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 10:05:00,,2018-01-05 00:00:00,2018-01-09 00:00:00",
        "o1,c1,delivered,2018-01-01 10:00:00,2018-01-01 10:05:00,,2018-01-05 00:00:00,2018-01-09 00:00:00",
        "o2,c2,SHIPPED,2018-01-01 11:00:00,,,,",
        "o3,c1,lost,2018-02-03 09:00:00,,,,",
        "o4,c9,created,never,,,,",
    )
    csv(
        "order_items",
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value",
        "o1,1,p1,s1,2018-01-03 00:00:00,10.00,1.00",
        "o1,2,p2,s1,2018-01-03 00:00:00,30.00,1.00",
        "o2,1,p1,s1,2018-01-03 00:00:00,10.00,1.00",
        "o3,1,p3,,2018-02-05 00:00:00,99.00,1.00",
    )
    csv(
        "payments",
        "order_id,payment_sequential,payment_type,payment_installments,payment_value",
        "o1,1,credit_card,1,42.00",
        "o1,2,voucher,1,0.50",
        "o3,1,boleto,1,600.00",
    )
    csv(
        "customers",
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state",
        "c1,u1,01000,Sao Paulo,sp",
    )
    (raw / "order_events").mkdir()
    event = {
        "topic": "t",
        "partition": 0,
        "offset": 1,
        "key": "o1",
        "value": {
            "order_id": "o1",
            "customer_id": "c1",
            "event_type": "order_created",
            "event_time": "2018-01-01T10:00:00",
        },
    }
    (raw / "order_events" / "part.jsonl").write_text(f"{json.dumps(event)}\n" * 2)
    return Warehouse(spark, str(raw), str(tmp_path / "curated"), str(tmp_path / "gold"))


def test_from_raw_files_to_gold(house, spark, tmp_path):
    warehouse.build_curated(house)
    warehouse.build_staged(house)
    warehouse.build_daily_orders_payments(house)
    warehouse.build_gold(house)
    warehouse.validate(house)

    assert house.table("orders").filter("order_year = 2018 and order_month = 1").count() == 2
    assert house.table("order_items").count() == 4
    assert house.table("order_created_events").count() == 1
    assert house.table("stg_order_items").count() == 3
    assert house.table("stg_order_events").first().is_order_created_event == 1
    days = house.gold_table("daily_sales_summary").orderBy("event_date").collect()
    assert [(str(d.event_date), d.order_count, d.total_revenue) for d in days] == [
        ("2018-01-01", 2, 42.5),
        ("2018-02-03", 1, 600.0),
    ]
    summary = house.table("daily_orders_payments_summary").orderBy("event_date").collect()
    assert [d.high_value_payment_order_count for d in summary] == [0, 1]
    hours = house.gold_table("hourly_order_summary")
    assert sorted(r.order_hour for r in hours.collect()) == [9, 10, 11]
    cities = house.gold_table("orders_by_city_day")
    assert {(r.customer_city, r.customer_state) for r in cities.collect()} == {
        ("sao paulo", "SP"),
        ("unknown", "unknown"),
    }
    ratios = house.gold_table("payment_ratio_by_day").orderBy("event_date").collect()
    assert [r.payment_coverage_ratio for r in ratios] == [0.5, 1.0]
    top = house.gold_table("top_products_by_day").orderBy("rank_in_day").collect()
    assert [(r.product_id, r.product_revenue) for r in top] == [("p2", 30.0), ("p1", 20.0)]
    layouts = warehouse.compare_daily_layouts(house, str(tmp_path / "layouts")).collect()
    assert sorted(tuple(r) for r in layouts) == [("by_event_date", 2, 2), ("by_year_month", 3, 2)]


def test_a_broken_gold_table_is_reported(house, spark):
    warehouse.build_staged(house)
    warehouse.build_gold(house)
    hourly = house.gold_table("hourly_order_summary").filter("order_hour <> 11")
    shorter = spark.createDataFrame(
        hourly.collect(), hourly.schema
    )
    write_table(shorter, f"{house.gold}/hourly_order_summary", warehouse.SUMMARY_MONTH)
    with pytest.raises(QualityError, match="daily and hourly order counts differ: 1"):
        warehouse.validate(house)


def test_jobs_run_one_step_each(house, spark, monkeypatch):
    folders = ["--raw", house.raw, "--curated", house.curated, "--gold", house.gold]
    for step in ("curated", "staged", "daily-orders-payments", "gold", "validate"):
        monkeypatch.setattr("sys.argv", ["jobs.py", step, *folders])
        jobs.main()
    assert house.gold_table("daily_sales_summary").count() == 2


def test_stream_jobs_pass_every_option():
    words = ["facts", "--servers", "broker:9092", "--state-partitions", "9", "--copy-spread", "3", "--every", "1 minute", "--sketch"]
    words += ["--max-offsets-per-trigger", "500", "--fail-on-data-loss"]
    options = jobs._arguments(words)
    assert (options.max_offsets_per_trigger, options.fail_on_data_loss) == (500, True)
    assert jobs.stream_options(options) == {
        "state_partitions": 9,
        "copy_spread": 3,
        "every": "1 minute",
        "sketch": True,
    }
    metrics = jobs.stream_options(jobs._arguments(["order-metrics", "--servers", "b:1", "--payments-every", "5 seconds"]))
    assert metrics["payments_every"] == "5 seconds" and metrics["state_partitions"] is None


def test_landing_and_gold_options():
    landing = jobs.stream_options(jobs._arguments(["landing", "--servers", "b:1", "--retention", "7d"]))
    assert landing == {"every": "10 seconds", "retention": "7d"}
    assert jobs._arguments(["gold", "--top-products", "50"]).top_products == 50
    assert jobs._arguments(["compact"]).grace_minutes == 10


def test_the_size_of_the_ranking_comes_from_the_job_line(house, monkeypatch):
    folders = ["--raw", house.raw, "--curated", house.curated, "--gold", house.gold]
    for step in (["staged"], ["gold", "--top-products", "1"]):
        monkeypatch.setattr("sys.argv", ["jobs.py", *step, *folders])
        jobs.main()
    assert {row.rank_in_day for row in house.gold_table("top_products_by_day").collect()} == {1}


def test_the_mart_and_compact_jobs(spark, tmp_path, monkeypatch):
    from millrace.schemas import ORDER_FACTS
    from millrace.sources.published import read_published

    tables = ["--tables", str(tmp_path / "tables"), "--checkpoints", str(tmp_path / "checkpoints")]
    spark.createDataFrame([], ORDER_FACTS).write.parquet(str(tmp_path / "tables" / "fact_realtime_orders_5m"))
    monkeypatch.setattr("sys.argv", ["jobs.py", "compact", *tables, "--archive", str(tmp_path / "archive")])
    jobs.main()
    day = "timestamp'2018-01-01 10:00:00'"
    rows = spark.sql(f"select {day} as window_start, {day} as window_end, 2L as order_created_count, 1L as unique_customer_count, binary('') as customer_sketch, {day} as processed_at")
    rows.write.mode("append").parquet(str(tmp_path / "tables" / "fact_realtime_orders_5m"))
    monkeypatch.setattr("sys.argv", ["jobs.py", "mart", *tables, "--mart", str(tmp_path / "mart"), "--keep-versions", "1"])
    for _ in range(2):
        jobs.main()
    assert [row.order_count for row in read_published(spark, str(tmp_path / "mart")).collect()] == [2]
