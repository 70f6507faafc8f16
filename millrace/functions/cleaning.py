"""Cleaning expressions.

Spark 4 runs in ANSI mode, where a plain cast of bad text fails the whole job.
Every conversion here turns a bad value into NULL instead, so that the operator
can drop the row.
"""

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.schemas import UNKNOWN


def text(name: str) -> Column:
    """Text without surrounding spaces. An all-space value becomes ``''``."""
    return F.trim(F.col(name).cast("string")).alias(name)


def lower_text(name: str) -> Column:
    return F.lower(text(name)).alias(name)


def upper_text(name: str) -> Column:
    return F.upper(text(name)).alias(name)


def integer(name: str) -> Column:
    return F.col(name).try_cast("int")


def amount(name: str) -> Column:
    return F.col(name).try_cast("double")


def moment(name: str) -> Column:
    """Timestamp from text in the blank or the ISO ``T`` form, NULL when malformed.

    The text must begin with a full date. A time alone would otherwise be a time of
    the day on which the job runs, and a year alone its first day.
    """
    value = F.col(name)
    dated = value.cast("string").rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}")
    return F.when(dated, value.try_cast("timestamp"))


def flag(condition: Column) -> Column:
    """1 or 0 as INT, so that flags can be summed. NULL counts as 0."""
    return F.when(condition, 1).otherwise(0)


def known_code(code: Column, allowed: Iterable[str]) -> Column:
    """The code when it is on the list, else ``unknown`` (also for NULL)."""
    return F.when(code.isin(*allowed), code).otherwise(UNKNOWN)


def all_present(*names: str) -> Column:
    """True where none of the columns is NULL. Splits and pushes down to the scan."""
    return reduce(and_, [F.col(name).isNotNull() for name in names])


def calendar(column: str, year: str, month: str) -> dict[str, Column]:
    """Year and month columns for a light partition layout."""
    return {year: F.year(column), month: F.month(column)}
