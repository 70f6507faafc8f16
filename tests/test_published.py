import pytest
from pyspark.sql import functions as F

from millrace.sources import files, readers
from millrace.sources.published import drop_versions, publish, read_published, versions


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "mart")


def ids(frame):
    return sorted(row.id for row in frame.collect())


def test_versions_replace_each_other(spark, path):
    assert publish(spark.range(3), path) == 1
    assert publish(spark.range(3, 5), path) == 2
    assert ids(read_published(spark, path)) == [3, 4]
    assert ids(read_published(spark, path, version=1)) == [0, 1, 2]


def test_nothing_is_published_yet(spark, path):
    with pytest.raises(FileNotFoundError, match="no published version"):
        read_published(spark, path)
    assert drop_versions(spark, path) == 0


def test_a_write_that_breaks_off_leaves_the_old_version(spark, path):
    publish(spark.range(3), path)
    broken = spark.range(100).select(F.when(F.col("id") == 77, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        publish(broken, path)
    assert ids(read_published(spark, path)) == [0, 1, 2]
    assert versions(spark, path).count() == 1
    assert publish(spark.range(1), path) == 2


def test_a_refused_table_leaves_the_old_version(spark, path):
    publish(spark.range(3), path)

    def refuse(written):
        assert written.count() == 9
        raise ValueError("refused")

    with pytest.raises(ValueError, match="refused"):
        publish(spark.range(9), path, check=refuse)
    assert ids(read_published(spark, path)) == [0, 1, 2]


def test_a_reader_keeps_its_version_while_another_is_published(spark, path):
    publish(spark.range(3), path)
    reading = read_published(spark, path)
    publish(spark.range(9), path)
    assert reading.count() == 3


def test_old_versions_are_dropped(spark, path):
    for n in range(1, 5):
        publish(spark.range(n).selectExpr("id", "id % 2 as odd"), path, partition_by=["odd"])
    assert drop_versions(spark, path, keep=2) == 2
    assert drop_versions(spark, path, keep=2) == 0
    assert read_published(spark, path).count() == 4
    assert read_published(spark, path, version=3).count() == 3


def test_files(spark, tmp_path):
    (tmp_path / "there").mkdir()
    assert files.exists(spark, str(tmp_path / "there"))
    assert files.remove(spark, str(tmp_path / "there"))
    assert not files.exists(spark, str(tmp_path / "there"))
    assert not files.remove(spark, str(tmp_path / "there"))


def test_a_sink_has_what_its_log_names(spark, topic, drained, tmp_path):
    records = topic()
    records.send("{}", "[]")
    table = drained(records.stream())
    stray = tmp_path / "result" / "part-of-an-unfinished-batch.parquet"
    stray.write_bytes(next((tmp_path / "result").glob("*.parquet")).read_bytes())
    assert readers.read_sink_or_empty(spark, str(tmp_path / "result"), table.schema).count() == 2
    only_files = tmp_path / "unfinished"
    only_files.mkdir()
    (only_files / stray.name).write_bytes(stray.read_bytes())
    assert spark.read.parquet(str(only_files)).count() == 2
    assert readers.read_sink_or_empty(spark, str(only_files), table.schema).count() == 0
    table.write.parquet(str(tmp_path / "batch"))
    assert readers.read_sink_or_empty(spark, str(tmp_path / "batch"), table.schema).count() == 2
    assert readers.read_sink_or_empty(spark, str(tmp_path / "none"), table.schema).schema == table.schema
