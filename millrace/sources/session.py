"""Session options for the length of one action."""

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def session_settings(
    spark: SparkSession, settings: Mapping[str, str]
) -> Iterator[None]:
    """Set session options for a block and put the old values back afterwards."""
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
