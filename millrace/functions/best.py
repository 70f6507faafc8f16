"""The best rows of each group within a task, before a shuffle."""

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ranks(groups: pa.Array) -> np.ndarray:
    """The place of each row in its run of equal groups, from zero; NULLs are equal."""
    codes = pc.dictionary_encode(groups, null_encoding="encode").indices.to_numpy()
    starts = np.flatnonzero(np.diff(codes, prepend=-1))
    return np.arange(len(codes)) - np.repeat(starts, np.diff(np.append(starts, len(codes))))


def keep_best(rows: DataFrame, group: str, order: Sequence[tuple[str, str]], k: int) -> DataFrame:
    """Of each group at most the ``k`` first rows of every task, and all that belong to
    the ``k`` first of the whole group.

    ``order`` holds (column, "ascending" or "descending"); NULLs stand as Spark sorts
    them: first ascending, last descending. Spark sorts each task's rows, spilling what
    memory doesn't hold, and the sorted rows pass by batch after batch, so Python holds
    one batch, whatever the number of groups or ``k``. Ranking the result again gives
    the same ranks as ranking all rows.
    """

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            if not len(batch):
                continue
            groups = batch[group]
            ranks = _ranks(groups)
            if last is not None and groups[0].equals(last):  # the last group goes on
                run = np.flatnonzero(ranks[1:] == 0)
                ranks[: run[0] + 1 if len(run) else len(ranks)] += seen
            last, seen = groups[-1], int(ranks[-1]) + 1
            yield batch.filter(pa.array(ranks < k))

    by = [F.col(name).asc() if direction == "ascending" else F.col(name).desc() for name, direction in order]
    return rows.sortWithinPartitions(F.col(group), *by).mapInArrow(best, rows.schema)
