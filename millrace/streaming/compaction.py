"""Few large files for the closed hours of a landed archive.

A landing stream adds a file per task, trigger and hour. Compaction copies closed
hours into an archive beside it, a few files per hour, and names the copy in a list of
runs when all of it is there. A reader takes the hours of the named runs, and from the
landing folder the committed files that no named run has replaced; so it sees every
record once, whatever runs meanwhile and wherever a run fails. Replaced files are
deleted by a later step, when no reader can need them any more.
"""

import re
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources.files import remove
from millrace.sources.readers import read_json_or_empty, read_sink_or_empty, read_table_or_empty
from millrace.sources.sinks import write_table

HOUR = ["ingest_date", "ingest_hour"]
_IN_HOUR = re.compile(r"/ingest_date=(\d{4}-\d\d-\d\d)/ingest_hour=(\d+)/[^/]+$")
_RUNS = "run string, number long"
_REPLACED = StructType().add("path", "string").add("run", "string")


def _runs(spark: SparkSession, archive: str) -> DataFrame:
    return read_json_or_empty(spark, f"{archive}/runs", _RUNS)


def _replaced(spark: SparkSession, archive: str) -> DataFrame:
    """Landing files whose records are in the archive, with the run that took them."""
    files = read_table_or_empty(spark, f"{archive}/replaced", _REPLACED)
    return files.join(_runs(spark, archive), "run")


def open_files(spark: SparkSession, landing: str, archive: str, schema: StructType) -> list[str]:
    """Committed files of the landing folder that are not in the archive.

    A list of paths, as long as the time since the last compaction. The sink's log
    names all files ever landed; its ``retention`` option keeps the log short.
    """
    committed = read_sink_or_empty(spark, landing, schema).inputFiles()
    replaced = {row.path for row in _replaced(spark, archive).select("path").collect()}
    return sorted(path for path in committed if path not in replaced)


def _hour_has_ended(path: str, now: datetime) -> bool:
    found = _IN_HOUR.search(path)
    if found is None:
        return False
    start = datetime.fromisoformat(found[1]).replace(hour=int(found[2]))
    return (now.replace(tzinfo=None) - start).total_seconds() >= 3600


def _read_files(spark: SparkSession, landing: str, paths: list[str], schema: StructType) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", landing).parquet(*paths)


def compact(
    spark: SparkSession, landing: str, archive: str, schema: StructType, closed_before: datetime
) -> str | None:
    """Copy the hours that ended by ``closed_before`` into the archive.

    Hours and ``closed_before`` are in the session's time zone; leave enough time for
    the last trigger of an hour to commit. What reaches an hour later is a run's work
    again, and lies beside the hour's first copy. The rows are balanced by hour: an
    hour gets few files, and one with most of the records several. A run that fails
    leaves files without a name, which no reader sees; it can simply be repeated.
    The name of the run, or None without such files.
    """
    closed = [path for path in open_files(spark, landing, archive, schema) if _hour_has_ended(path, closed_before)]
    if not closed:
        return None
    run = uuid.uuid4().hex
    rows = _read_files(spark, landing, closed, schema).withColumn("run", F.lit(run))
    write_table(rows, f"{archive}/hours", [*HOUR, "run"], mode="append")
    replaced = spark.createDataFrame([(path, run) for path in closed], _REPLACED)
    replaced.coalesce(1).write.mode("append").parquet(f"{archive}/replaced")
    number = (_runs(spark, archive).agg(F.max("number")).first()[0] or 0) + 1
    named = spark.createDataFrame([(run, number)], _RUNS)
    named.coalesce(1).write.mode("append").json(f"{archive}/runs")
    return run


def read_landed(spark: SparkSession, landing: str, archive: str, schema: StructType) -> DataFrame:
    """All landed records, each once: the archive, and what is not in it yet."""
    copied = read_table_or_empty(spark, f"{archive}/hours", StructType([*schema]).add("run", "string"))
    copied = copied.join(_runs(spark, archive).select("run"), "run", "left_semi").select(*schema.names)
    return copied.unionByName(_read_files(spark, landing, open_files(spark, landing, archive, schema), schema))


def drop_replaced(spark: SparkSession, landing: str, archive: str, keep_runs: int = 1) -> int:
    """Delete landing files that all but the newest ``keep_runs`` runs have replaced.

    Readers that began before such a run named its copy must have ended. Repeating it
    does no harm. The number of files deleted.
    """
    newest = _runs(spark, archive).agg(F.max("number")).first()[0] or 0
    old = _replaced(spark, archive).where(F.col("number") <= newest - keep_runs)
    return sum(remove(spark, row.path) for row in old.select("path").toLocalIterator())
