import pytest

from millrace import standins


@pytest.mark.parametrize("files", [1, 3])
def test_a_table_streams_whole_from_a_folder_of_files(spark, tmp_path, drained, files):
    table = spark.range(30).selectExpr("id", "id * 2 as twice")
    table.repartition(files).write.parquet(str(tmp_path / "events.parquet"))
    stream = standins.table_stream(spark, str(tmp_path), "events")
    assert drained(stream).count() == 30


def test_a_table_streams_whole_from_one_file(spark, drained):
    small = "/root/testdata/sf0.001"
    rows = standins.table(spark, small, "events").count()
    assert drained(standins.table_stream(spark, small, "events")).count() == rows
