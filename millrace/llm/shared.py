"""Helpers of the operators: written tables, components, hashed samples."""

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources.session import session_settings
from millrace.sources.workspace import new_folder

#: Rows in one Arrow batch of texts. Texts may be long, so fewer than Spark's 10,000.
TEXT_ROWS = 1000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def written(
    frame: DataFrame, purpose: str, batch_rows: int = TEXT_ROWS, **options: str
) -> DataFrame:
    """The rows of ``frame``, written to the shared folder and read back.

    Python functions in ``frame`` get Arrow batches of ``batch_rows`` rows.

    Writing cuts the lineage: what reads the result needs no executor that made it.
    """
    spark = frame.sparkSession
    path = new_folder(spark, purpose)
    with session_settings(spark, {ARROW_ROWS: str(batch_rows)}):
        frame.write.options(**options).parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def held_out(doc_id: str = "doc_id") -> Column:
    """The fold that no model learns from: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, most: int
) -> DataFrame:
    """At most ``most`` labelled documents outside the held-out fold, written: doc_id,
    label, text.

    Only labels of given documents count, so the sample is as large as these allow. A
    document with several labels counts with the largest, one with several texts with
    the first in order. The sample takes the smallest hashes of the ids, so it
    doesn't depend on the order of the tables.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(label).alias("label"))
    )
    present = known.join(documents.select("doc_id"), "doc_id", "left_semi")
    chosen = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.join(F.broadcast(chosen), "doc_id")
    return written(texts.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "labelled")


def release() -> None:
    """Give memory that a task no longer needs back to the system.

    A worker process goes on to tasks of other stages. What Python's and Arrow's
    allocators keep for it would add up with what those need.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not this C library
        pass


def releasing(function: Callable[[Iterator[pa.Array]], Iterator[pa.Array]]):
    """An iterator function of a column, and the memory of each task given back."""

    @wraps(function)
    def run(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            yield from function(arrays)
        finally:
            release()

    return run


def map_batches(
    frame: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """``mapInArrow``, and the memory of each task given back at its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            release()

    return frame.mapInArrow(run, schema)


# Connected components


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of one task as stars: each node with the smallest one it reaches."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = node = parent.setdefault(above, above)
        return node

    for batch in batches:
        for u, v in zip(batch["u"].to_pylist(), batch["v"].to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    stars = [(node, top) for node in list(parent) if (top := root(node)) != node]
    for start in range(0, len(stars), 10_000):
        u, v = zip(*stars[start : start + 10_000], strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"]
        )


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    return (
        both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    ).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), "m")
    return moved.union(least).distinct().withColumnRenamed("m", "v")


def _all_stars(links: DataFrame) -> bool:
    ends = links.select(F.col("u").alias("k"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(links.select("v", F.lit(0), F.lit(1)))
    per_node = ends.groupBy("k").agg(F.sum("up").alias("ups"), F.max("down").alias("down"))
    return per_node.where("ups > 1 or (ups = 1 and down = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node that each linked node can reach.

    ``links`` has two long columns, the ends. Nodes without a link to another node
    are not in the result. Links are first contracted within each task, then by
    alternating large and small stars: every step is a minimum with map-side
    combination and a join that Spark may split, so a node with a third of all
    links is no hot spot. The links of a step are written to the shared folder.
    """
    u, v = (F.col(name) for name in links.columns)
    links = links.select(u.alias("u"), v.alias("v")).where("u <> v")
    links = written(map_batches(links, _contract, "u long, v long"), "links")
    while not _all_stars(links):
        links = written(_large_star(links), "links")
        links = written(_small_star(links), "links")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
