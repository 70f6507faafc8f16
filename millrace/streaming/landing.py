"""Untouched archive of a topic."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.streaming.wire import as_text


def raw_landing(records: DataFrame, processed_at: Column | None = None) -> DataFrame:
    """Every record as text, stamped with its processing time, date and hour.

    Stateless: no shuffle, and every task writes its own file below the
    ``ingest_date``, ``ingest_hour`` folders.
    """
    stamp = F.current_timestamp() if processed_at is None else processed_at
    return (
        as_text(records)
        .withColumn("processed_at", stamp)
        .withColumns(
            {
                "ingest_date": F.to_date("processed_at"),
                "ingest_hour": F.hour("processed_at"),
            }
        )
    )
