"""Batch sinks: Parquet tables, messages and console previews."""

from collections.abc import Sequence

from pyspark.sql import DataFrame

from millrace.sources.session import session_settings

# Opening a file per folder takes longer than writing a few rows to it, so even a
# small table with many folders is written from all cores.
_USE_ALL_CORES = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}


def write_table(
    table: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Replace a Parquet table, or add to it, optionally in Hive-style folders.

    Rows are rebalanced by the partition columns first. Without that every task
    writes a small file into every folder it has a row for; with it a folder gets
    few files, and a folder that holds a large part of the table is split over
    several tasks of the advisory partition size.
    """
    if not partition_by:
        table.write.mode(mode).parquet(path)
        return
    balanced = table.hint("rebalance", *partition_by)
    with session_settings(table.sparkSession, _USE_ALL_CORES):
        balanced.write.mode(mode).partitionBy(*partition_by).parquet(path)


def publish_messages(messages: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Send ``key`` and ``value`` rows to a topic. Needs Spark's Kafka package."""
    messages.select("key", "value").write.format("kafka").option(
        "kafka.bootstrap.servers", bootstrap_servers
    ).option("topic", topic).save()


def write_messages(messages: DataFrame, path: str) -> None:
    """Archive messages as JSON lines."""
    messages.write.mode("overwrite").json(path)


def preview(table: DataFrame, rows: int = 20, title: str = "") -> None:
    """Print the schema and the first rows."""
    if title:
        print(title)
    table.printSchema()
    table.show(rows, truncate=False)
