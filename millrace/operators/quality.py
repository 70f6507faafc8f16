"""Data-quality rules as DataFrames of failed-row counts.

A report has the columns ``check_name`` and ``failed_rows``. All rules over one
table run in a single pass. ``require_passed`` turns a report into an error.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import amount
from millrace.functions.money import LARGEST_AMOUNT


class QualityError(ValueError):
    """At least one rule found bad rows."""


def count_failures(table: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that meet each condition, one report row per rule, in one scan."""
    counted = table.agg(*(F.count_if(bad).alias(name) for name, bad in rules.items()))
    return _as_report(counted)


def _as_report(counts: DataFrame) -> DataFrame:
    """One wide row of counts to one row per check."""
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.coalesce(F.col(f"`{name}`"), F.lit(0)).cast("long").alias("failed_rows"),
        )
        for name in counts.columns
    ]
    return counts.select(F.inline(F.array(*entries)))


def rejected_amounts(raw: DataFrame, *names: str) -> DataFrame:
    """How many values of the raw columns are no usable amounts, and why.

    These cost their row in staging. A missing value is not counted.
    """
    reasons = {}
    for name in names:
        value = amount(name)
        broken = F.col(name).isNotNull() & value.isNull()
        large = F.isnan(value) | (F.abs(value) > LARGEST_AMOUNT)
        reasons[f"{name} is no number"] = broken
        reasons[f"{name} is not finite or too large"] = large
        reasons[f"{name} is negative"] = ~large & (value < 0)
    return count_failures(raw, reasons)


def _both_sides(daily: DataFrame, hourly: DataFrame) -> DataFrame:
    """Every daily row with its day's sum of hours, and the days without daily rows."""
    hours = hourly.groupBy("event_date").agg(
        F.sum("order_count").alias("hourly_order_count"), F.lit(True).alias("_hourly")
    )
    return daily.withColumn("_daily", F.lit(True)).join(
        hours, on="event_date", how="full"
    )


def _difference() -> Column:
    daily, hourly = F.col("order_count"), F.col("hourly_order_count")
    return F.coalesce(daily, F.lit(0)) - F.coalesce(hourly, F.lit(0))


def _on_both_sides() -> Column:
    return F.col("_daily").isNotNull() & F.col("_hourly").isNotNull()


def daily_vs_hourly(
    daily: DataFrame, hourly: DataFrame, include_unmatched=True
) -> DataFrame:
    """Order counts per day next to the sum of the day's hours.

    A day that one side lacks has a count of 0 there. With
    ``include_unmatched=False`` only days on both sides are compared.
    """
    rows = _both_sides(daily.select("event_date", "order_count"), hourly)
    compared = rows if include_unmatched else rows.filter(_on_both_sides())
    return compared.select(
        "event_date",
        *(
            F.coalesce(name, F.lit(0)).alias(name)
            for name in ("order_count", "hourly_order_count")
        ),
        _difference().alias("order_count_diff"),
    )


def validate_gold(
    daily: DataFrame,
    hourly: DataFrame,
    include_unmatched=True,
    staged_orders: DataFrame | None = None,
) -> DataFrame:
    """Six rules on the daily table and its reconciliation with the hourly one, in
    one pass over both.

    An empty daily table fails, and so do days that only one table has, unless
    ``include_unmatched=False``. With ``staged_orders`` a seventh rule checks what
    the order counts rely on, that an order id comes once.
    """
    orders, in_daily = F.col("order_count"), F.col("_daily").isNotNull()
    rules = {
        "daily event_date is null": F.col("event_date").isNull(),
        "daily order_count is not positive": orders <= 0,
        "daily total_revenue is negative": F.col("total_revenue") < 0,
        "orders_with_payment exceeds order_count": F.col("orders_with_payment")
        > orders,
        "delivered_order_count exceeds order_count": F.col("delivered_order_count")
        > orders,
    }
    differs = _difference() != 0
    if not include_unmatched:
        differs = differs & _on_both_sides()
    counted = _both_sides(daily, hourly).agg(
        F.when(F.count("_daily") == 0, 1).otherwise(0).alias("daily table is empty"),
        *(F.count_if(in_daily & bad).alias(name) for name, bad in rules.items()),
        F.count_if(differs).alias("daily and hourly order counts differ"),
    )
    report = _as_report(counted)
    if staged_orders is None:
        return report
    ids = staged_orders.groupBy("order_id").count()
    repeated = {"order_id is not unique": F.col("count") > 1}
    return report.union(count_failures(ids, repeated))


def check_serving(mart: DataFrame) -> DataFrame:
    """The mart is not empty, its date is a unique key and revenue is not negative."""
    dates = mart.groupBy("sales_date").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("total_revenue") < 0).alias("negative"),
    )
    rows = F.col("rows")
    return _as_report(
        dates.agg(
            F.when(F.count("*") == 0, 1).otherwise(0).alias("mart is empty"),
            F.sum(F.when(F.col("sales_date").isNull(), rows)).alias(
                "sales_date is null"
            ),
            F.sum("negative").alias("total_revenue is negative"),
            F.count_if(rows > 1).alias("sales_date is duplicated"),
        )
    )


def require_passed(report: DataFrame) -> None:
    """Raise ``QualityError`` that names every failed rule and its row count.

    A report has a handful of rows, one per rule, so collecting it is bounded.
    """
    failed = report.filter(F.col("failed_rows") > 0).collect()
    if failed:
        found = "; ".join(f"{row.check_name}: {row.failed_rows}" for row in failed)
        raise QualityError(found)
