"""Tables that are replaced as a whole, without a moment in which there is none.

Below the table's folder every version has a data folder of its own, and one small
file per version names it. That file comes last, by a single rename, so a version is
there in full or not at all, and a failed write leaves the one before it as it was.
"""

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.files import remove
from millrace.sources.readers import read_json_or_empty, read_table
from millrace.sources.sinks import write_table

_VERSIONS = "version long, run string"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """``version`` and ``run``, the name of its data folder, of all versions."""
    return read_json_or_empty(spark, f"{path}/versions", _VERSIONS)


def publish(
    table: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    check: Callable[[DataFrame], None] | None = None,
) -> int:
    """Write the next version of a table and make it the current one.

    ``check`` gets the written rows and raises to refuse them; they stay in their
    folder then, unnamed, and readers keep the version before. One writer at a time.
    """
    spark = table.sparkSession
    run = uuid.uuid4().hex
    write_table(table, f"{path}/data/{run}", partition_by)
    if check:
        check(read_table(spark, f"{path}/data/{run}"))
    number = (versions(spark, path).agg(F.max("version")).first()[0] or 0) + 1
    name = spark.createDataFrame([(number, run)], _VERSIONS)
    name.coalesce(1).write.mode("append").json(f"{path}/versions")
    return number


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The current version of a table, or a given one that is still kept."""
    known = versions(spark, path)
    if version is not None:
        known = known.where(F.col("version") == version)
    newest = known.orderBy(F.desc("version"), "run").first()
    if newest is None:
        raise FileNotFoundError(f"no published version in {path}")
    return read_table(spark, f"{path}/data/{newest.run}")


def drop_versions(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the data of all but the newest versions; how many had data to delete.

    Readers that began with a dropped version fail, so keep as many as a long read
    may need. Names of versions stay.
    """
    old = versions(spark, path).orderBy(F.desc("version")).offset(keep)
    return sum(remove(spark, f"{path}/data/{row.run}") for row in old.collect())
