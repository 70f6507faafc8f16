"""Single paths on the file system that a table lies on."""

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    system, there = _at(spark, path)
    return system.exists(there)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or a folder with all it holds; False if there is none."""
    system, there = _at(spark, path)
    return system.delete(there, True)
