"""Keyed deduplication with a reproducible survivor."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, TimestampNTZType, TimestampType

_HASHABLE_BUFFERS = (NumericType, TimestampType, TimestampNTZType)
_RANK = "_survivor_rank"


def keep_one(
    rows: DataFrame, keys: Sequence[str], prefer: Sequence[Column] = ()
) -> DataFrame:
    """One row per key: the first by ``prefer``, then by every other column.

    ``dropDuplicates`` keeps whichever row arrives first, so a retried task can
    change the result. Here ties are broken by the whole row, NULLs last.

    Copies are dropped before the shuffle as well as after it. Spark turns the
    rank filter into a partial and a final group limit, so a key that holds a
    third of all rows sends at most one row per map task. With a single plain
    column beside the keys, the minimum of that column is the same survivor and
    stays in a hash aggregate, without a sort.
    """
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    if len(rest) == 1 and not prefer:
        only = rest[0]
        if isinstance(rows.schema[only].dataType, _HASHABLE_BUFFERS):
            return rows.groupBy(*keys).agg(F.min(only).alias(only))
    order = [*prefer, *(F.col(c).asc_nulls_last() for c in rest)]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn(_RANK, first).filter(F.col(_RANK) == 1).drop(_RANK)
