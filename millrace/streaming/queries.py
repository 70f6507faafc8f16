"""Starting streaming queries into Parquet and waiting for them."""

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.sources.session import session_settings

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_settings(
    spark: SparkSession, state_partitions: int | None = None
) -> dict[str, str]:
    """Session options that a stateful query takes over when it first starts.

    Both end up in the query's checkpoint and cannot change later. State lives in
    RocksDB, on local disk with a copy in the checkpoint, so that twenty minutes
    of event ids need not fit in executor heap. Without ``state_partitions`` the
    session's number of shuffle partitions holds: cores are no measure, since a
    cluster may give out its executors only after the query has started.
    """
    chosen = {}
    if state_partitions:
        chosen["spark.sql.shuffle.partitions"] = str(state_partitions)
    return chosen | {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }


def start_parquet_query(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = "10 seconds",
    partition_by: Sequence[str] = (),
    name: str | None = None,
    state_partitions: int | None = None,
    retention: str | None = None,
) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once across restarts.

    ``every`` is the processing-time trigger; None works off what is there and
    then stops. ``retention``, such as "7d", drops older files from the sink's
    log, which otherwise names every file forever; only what has been compacted by
    then is still read.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    if retention:
        writer = writer.option("retention", retention)
    if every is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=every)
    spark = stream.sparkSession
    with session_settings(spark, state_settings(spark, state_partitions)):
        return writer.start()


def run_to_end(*queries: StreamingQuery) -> None:
    """Wait for queries that stop by themselves; a failed one raises."""
    for query in queries:
        query.awaitTermination()


def stop_after(query: StreamingQuery, batches: int, seconds: float = 300) -> int:
    """Stop a query once so many batches are done, in the middle of the next perhaps.

    The number of the last batch that was done by then. What was under way is done
    again when the query is started from its checkpoint. A failed query raises, and
    one that does not get there in ``seconds`` is stopped all the same.
    """
    end = time.monotonic() + seconds

    def last() -> int:
        return -1 if query.lastProgress is None else query.lastProgress.batchId

    while query.isActive and last() + 1 < batches and time.monotonic() < end:
        time.sleep(0.05)
    query.stop()
    if query.exception():
        raise query.exception()
    return last()


def late_rows(query: StreamingQuery) -> int:
    """Rows that the state operators of a query dropped behind the watermark.

    Of the batches that Spark keeps in mind (a hundred, by default); for a query
    that runs on, add up ``numRowsDroppedByWatermark`` in a query listener.
    """
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )


def observed(query: StreamingQuery, name: str) -> list[tuple[int, dict[str, int]]]:
    """The figures that a query observes under a name, batch by batch.

    Batches without new rows have none. Of the batches that Spark keeps in mind.
    """
    return [
        (progress.batchId, progress.observedMetrics[name].asDict())
        for progress in query.recentProgress
        if progress.numInputRows and name in progress.observedMetrics
    ]


def await_any(spark: SparkSession) -> None:
    """Block until any query of the session ends; a failed one raises."""
    spark.streams.awaitAnyTermination()
