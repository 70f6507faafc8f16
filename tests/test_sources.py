import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace import schemas
from millrace.operators.layout import compare_layouts, layout_size
from millrace.sources import readers, sinks, workspace
from millrace.sources.session import session_settings


def test_csv_fields_are_text_and_empty_is_null(spark, tmp_path):
    path = tmp_path / "payments.csv"
    path.write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,voucher,,12.50\n"
        '"o,2",x,,1,\n'
    )
    rows = readers.read_csv(spark, str(path), schemas.RAW_PAYMENTS).collect()
    assert [tuple(r) for r in rows] == [
        ("o1", "1", "voucher", None, "12.50"),
        ("o,2", "x", None, "1", None),
    ]


def test_json_lines_envelopes(spark, tmp_path):
    path = tmp_path / "events.jsonl"
    path.write_text(
        '{"topic":"t","partition":0,"offset":7,"key":"k",'
        '"value":{"order_id":"o1","payment_value":1.5}}\n'
        "not json\n"
    )
    rows = readers.read_events(spark, str(path)).collect()
    assert [(r.offset, r.value.order_id if r.value else None) for r in rows] == [
        (7, "o1"),
        (None, None),
    ]


def test_partitioned_table_round_trip_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    table = spark.range(100).selectExpr(
        "id", "cast(if(id = 0, null, 2000 + id % 3) as int) as y", "cast(id % 2 as int) as m"
    )
    sinks.write_table(table, path, ["y", "m"])
    sinks.write_table(table.filter("id < 50"), path, ["y", "m"])
    back = readers.read_table(spark, path)
    assert back.columns == ["id", "y", "m"]
    assert back.count() == 50
    assert (tmp_path / "t" / "y=__HIVE_DEFAULT_PARTITION__").is_dir()
    sizes = layout_size(spark, path, 2).first()
    assert (sizes.folder_count, sizes.file_count) == (4 + 7, 7)


def test_plain_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(5).coalesce(1), path)
    assert readers.read_table(spark, path).count() == 5
    assert tuple(layout_size(spark, path, 0).first()) == (0, 1)


def test_layouts_are_compared_on_the_same_rows(spark, tmp_path):
    days = spark.range(60).selectExpr(
        "date_add(date'2018-01-01', cast(id as int)) as event_date", "id as n"
    ).selectExpr("*", "year(event_date) as y", "month(event_date) as m")
    layouts = {"by_day": ["event_date"], "by_month": ["y", "m"]}
    report = compare_layouts(days, layouts, str(tmp_path / "layouts"))
    assert sorted(tuple(r) for r in report.collect()) == [("by_day", 60, 60), ("by_month", 4, 3)]


def test_a_missing_or_unwritten_table_is_empty(spark, tmp_path):
    schema = schemas.RAW_PAYMENTS
    missing = readers.read_table_or_empty(spark, str(tmp_path / "none"), schema)
    (tmp_path / "started").mkdir()
    started = readers.read_table_or_empty(spark, str(tmp_path / "started"), schema)
    assert missing.count() == started.count() == 0
    assert missing.schema == schema
    sinks.write_table(spark.range(2), str(tmp_path / "there"))
    assert readers.read_table_or_empty(spark, str(tmp_path / "there"), schema).count() == 2


def test_local_rows(spark):
    table = readers.local_rows(spark, [("O1", 1.5), ("O2", 2.0)], ["order_id", "amount"])
    assert table.dtypes == [("order_id", "string"), ("amount", "double")]


def test_messages_round_trip(spark, tmp_path):
    path = str(tmp_path / "m")
    sinks.write_messages(spark.createDataFrame([("k", "{}")], "key string, value string"), path)
    assert [tuple(r) for r in spark.read.json(path).collect()] == [("k", "{}")]


def test_kafka_needs_its_package(spark):
    with pytest.raises(AnalysisException, match="kafka"):
        readers.kafka_stream(spark, "broker:9092", "topic", min_partitions=64)
    message = spark.createDataFrame([("k", "v")], "key string, value string")
    with pytest.raises(AnalysisException, match="kafka"):
        sinks.publish_messages(message, "broker:9092", "topic")


def test_preview_prints_schema_and_rows(spark, capsys):
    sinks.preview(spark.range(3), rows=2, title="numbers")
    shown = capsys.readouterr().out
    assert "numbers" in shown and "id: long" in shown and "only showing top 2 rows" in shown


def test_new_folders_are_below_the_shared_one(spark):
    first, second = (workspace.new_folder(spark, "x") for _ in range(2))
    assert first.startswith(spark.conf.get(workspace.CHECKPOINT_DIR))
    assert first != second


def test_settings_are_put_back(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), session_settings(spark, {name: "17"}):
        assert spark.conf.get(name) == "17"
        raise ZeroDivisionError
    assert spark.conf.get(name) == before


def test_pruning_reaches_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(9).selectExpr("id", "cast(id % 3 as int) y"), path, ["y"])
    picked = readers.read_table(spark, path).filter("y = 1 and id > 2").select("id")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan
    assert "GreaterThan(id,2)" in plan
    assert picked.agg(F.sum("id")).first()[0] == 4 + 7
