"""Daily sales mart from the five-minute facts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import money


def mart_daily_sales(
    order_facts: DataFrame,
    payment_facts: DataFrame,
    refreshed_at: Column | None = None,
    exact_cents=True,
    sketched_customers=False,
) -> DataFrame:
    """Per day with orders: counts, revenue and average order value.

    Days that have payments only are left out. A window whose revenue is negative or
    not finite adds nothing, and ``build_mart`` refuses such facts; the limit of one
    price doesn't hold for the sum of a window. ``unique_customer_count`` adds up
    the windows, so a customer counts once per window. When the order facts carry
    ``customer_sketch``, ``sketched_customers=True`` merges the sketches instead
    and estimates the day's distinct customers.
    """
    day = F.to_date("window_start").alias("sales_date")
    if sketched_customers:
        customers = F.hll_sketch_estimate(F.hll_union_agg("customer_sketch"))
    else:
        customers = F.sum("unique_customer_count")
    order_days = order_facts.groupBy(day).agg(
        F.sum("order_created_count").alias("order_count"),
        customers.alias("unique_customer_count"),
    )
    counted = F.when(money.usable_sum(F.col("payment_revenue")), F.col("payment_revenue"))
    revenue = money.addend_of_sum(counted, exact_cents)
    payment_days = payment_facts.groupBy(day).agg(
        F.sum("payment_confirmed_count").alias("payment_confirmed_count"),
        F.sum(revenue).alias("_revenue"),
    )
    nothing = 0 if exact_cents else 0.0
    days = order_days.join(payment_days, on="sales_date", how="left").fillna(
        {"payment_confirmed_count": 0, "_revenue": nothing}
    )
    summed, count = F.col("_revenue"), F.col("order_count")
    return days.select(
        "sales_date",
        "order_count",
        "unique_customer_count",
        "payment_confirmed_count",
        F.round(money.from_addend(summed, exact_cents), 2).alias("total_revenue"),
        money.per_head(summed, count, exact_cents).alias("avg_order_value"),
        (F.current_timestamp() if refreshed_at is None else refreshed_at).alias(
            "source_refresh_ts"
        ),
    )
