"""Schema, row count and sorted head of a table."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableProfile:
    schema: StructType
    row_count: DataFrame
    head: DataFrame

    def show(self) -> None:
        print(self.schema.treeString())
        self.row_count.show()
        self.head.show(truncate=False)


def profile_table(
    table: DataFrame, *order_by: str | Column, rows: int = 10
) -> TableProfile:
    """What an analyst looks at first. Nothing runs until a part is shown.

    The head is a top-k by ``order_by``, names or columns such as
    ``F.desc("revenue")``; without keys it is any ``rows`` rows.
    """
    ordered = table.orderBy(*order_by) if order_by else table
    return TableProfile(
        schema=table.schema,
        row_count=table.agg(F.count("*").alias("row_count")),
        head=ordered.limit(rows),
    )
