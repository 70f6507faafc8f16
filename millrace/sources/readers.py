"""Scans with explicit schemas. Nothing here infers a schema from data."""

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millrace.schemas import event_envelope
from millrace.sources.files import exists


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """CSV with a header row. An empty field is NULL."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_events(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """JSON lines of message envelopes. A malformed line gives a row of NULLs."""
    return spark.read.schema(schema or event_envelope()).json(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, with its partition columns."""
    return spark.read.parquet(path)


def read_table_or_empty(
    spark: SparkSession, path: str, schema: StructType
) -> DataFrame:
    """A Parquet table, or no rows while it has not been written yet.

    A stream creates its folder before its first commit; a folder without files
    also counts as not written.
    """
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return spark.createDataFrame([], schema)
        raise


def read_json_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, or no rows while none have been written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def read_sink_or_empty(
    spark: SparkSession, path: str, schema: StructType
) -> DataFrame:
    """What a streaming query has committed to its Parquet folder, or no rows.

    The sink's log names the files of committed batches. A folder without a log and
    without the mark of a finished batch job holds at most files of an unfinished
    first batch, which no commit has named: they are not rows yet.
    """
    if exists(spark, f"{path}/_spark_metadata"):
        return spark.read.schema(schema).parquet(path)
    if exists(spark, f"{path}/_SUCCESS"):
        return read_table_or_empty(spark, path, schema)
    return spark.createDataFrame([], schema)


def local_rows(
    spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]
) -> DataFrame:
    """A small literal table from tuples and column names."""
    return spark.createDataFrame(list(rows), list(names))


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """One Kafka topic as a stream of wire records. Needs Spark's Kafka package.

    Messages are keyed, so one topic partition can hold a large part of them.
    ``min_partitions`` above the number of topic partitions splits the offset
    range of such a partition over several tasks.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
        "minPartitions": min_partitions,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
    }
    given = {name: value for name, value in options.items() if value is not None}
    return spark.readStream.format("kafka").options(**given).load()
