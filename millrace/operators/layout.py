"""Comparison of partition layouts by the folders and files they produce."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.sinks import write_table


def layout_size(spark: SparkSession, path: str, depth: int) -> DataFrame:
    """One row: ``folder_count`` and ``file_count`` of a table with ``depth``
    partition columns.

    Lists the data files as a table of paths. File contents are not read, since
    only the path column is used.
    """
    steps = F.split("path", "/")
    leaves = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .groupBy(F.slice(steps, F.size(steps) - depth, depth).alias("leaf"))
        .agg(F.count("*").alias("files"))
    )
    # Every folder above a leaf counts once, the files only at the leaf.
    folders = leaves.select(
        "leaf",
        "files",
        F.explode_outer(
            F.transform("leaf", lambda _, i: F.slice("leaf", 1, i + 1))
        ).alias("folder"),
    )
    at_leaf = F.col("folder").isNull() | (F.col("folder") == F.col("leaf"))
    return (
        folders.groupBy("folder")
        .agg(F.sum(F.when(at_leaf, F.col("files"))).alias("files"))
        .agg(
            F.count("folder").alias("folder_count"),
            F.sum("files").alias("file_count"),
        )
    )


def compare_layouts(
    table: DataFrame, layouts: Mapping[str, Sequence[str]], folder: str
) -> DataFrame:
    """Write the same rows once per layout and report the size of each.

    Returns ``layout``, ``folder_count`` and ``file_count``; ``layouts`` maps a
    name, also the name of the sub-folder, to partition columns.
    """
    spark = table.sparkSession

    def written(name: str, columns: Sequence[str]) -> DataFrame:
        path = f"{folder}/{name}"
        write_table(table, path, columns)
        return layout_size(spark, path, len(columns)).select(
            F.lit(name).alias("layout"), "folder_count", "file_count"
        )

    return reduce(
        DataFrame.unionByName,
        [written(name, columns) for name, columns in layouts.items()],
    )
