import json
import os
import sys
from datetime import UTC, datetime
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.streaming.queries import run_to_end, start_parquet_query  # noqa: E402

SMALL_TABLES = "/root/testdata/sf0.001"

WIRE = pa.schema(
    [
        ("key", pa.binary()),
        ("value", pa.binary()),
        ("topic", pa.string()),
        ("partition", pa.int32()),
        ("offset", pa.int64()),
        ("timestamp", pa.timestamp("us", tz="UTC")),
    ]
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    """Rows as a sorted list of dictionaries of the chosen columns."""

    def collect(frame, *columns):
        chosen = frame.select(*columns) if columns else frame
        rows = [row.asDict() for row in chosen.collect()]
        return sorted(rows, key=lambda row: [str(v) for v in row.values()])

    return collect


@pytest.fixture
def text_table(spark):
    """A raw table from dictionaries; a column left out is NULL."""

    def make(schema, *rows):
        values = [tuple(row.get(name) for name in schema.names) for row in rows]
        return spark.createDataFrame(values, schema)

    return make


class Topic:
    """A folder of wire records in which each batch of messages is one file."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.folder = folder
        self.batches = 0
        self.offset = 0
        folder.mkdir()

    def send(self, *messages, partition=0):
        """Add one batch of payloads: dictionaries, or text as it is."""
        records = []
        for message in messages:
            text = message if isinstance(message, str) else json.dumps(message)
            records.append(
                {
                    "key": b"k",
                    "value": text.encode(),
                    "topic": self.folder.name,
                    "partition": partition,
                    "offset": self.offset,
                    "timestamp": datetime(2026, 5, 14, 12, tzinfo=UTC),
                }
            )
            self.offset += 1
        path = self.folder / f"batch-{self.batches:04d}.parquet"
        pq.write_table(pa.Table.from_pylist(records, schema=WIRE), path)
        # The file source takes older files first.
        os.utime(path, (1_000_000 + self.batches, 1_000_000 + self.batches))
        self.batches += 1

    def batch(self):
        return self.spark.read.parquet(str(self.folder))

    def stream(self):
        return (
            self.spark.readStream.schema(self.batch().schema)
            .option("maxFilesPerTrigger", 1)
            .parquet(str(self.folder))
        )


@pytest.fixture
def topic(spark, tmp_path):
    return lambda name="topic": Topic(spark, tmp_path / name)


@pytest.fixture
def drained(spark, tmp_path):
    """Run a stream over everything available and return its table."""

    def run(stream, name="result", **options):
        query = start_parquet_query(
            stream,
            str(tmp_path / name),
            str(tmp_path / f"{name}-checkpoint"),
            every=None,
            state_partitions=2,
            **options,
        )
        run_to_end(query)
        return spark.read.parquet(str(tmp_path / name))

    return run
