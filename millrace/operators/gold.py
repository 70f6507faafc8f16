"""Daily, hourly, city, coverage and product aggregates.

Two habits keep these cheap and safe on skewed data:

* Distinct customers are counted in two grouping steps, (period, customer) and
  then (period). Each step combines on the map side, so neither a busy day nor a
  busy customer ends up as raw rows in one task, and no row is multiplied the way
  several distinct counts in one step multiply it.
* Orders and items are grouped down before they are joined, so a customer or an
  order that holds a large part of all rows enters the join as a few rows.

``staged_orders`` has one row per order id, as ``stage_orders`` returns it; order
counts are then row counts. For a table without that guarantee pass
``unique_orders=False``, which counts distinct ids at the cost of a wider plan.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import money
from millrace.functions.best import keep_best
from millrace.functions.cleaning import calendar
from millrace.operators.payments import (
    payment_facts_by_order,
    sequenced_payments_by_order,
)
from millrace.schemas import UNKNOWN

GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _with_summary_calendar(summary: DataFrame) -> DataFrame:
    return summary.withColumns(
        calendar("event_date", "summary_year", "summary_month")
    )


def _count_orders_and_customers(
    orders: DataFrame,
    period: Sequence[str],
    sums: dict[str, Column],
    approximate: bool,
    unique_orders: bool,
) -> DataFrame:
    """Per period: orders, distinct customers and the given sums."""
    customer = F.col("customer_id")
    if not unique_orders:
        estimate = F.approx_count_distinct(customer)
        return orders.groupBy(*period).agg(
            F.count_distinct("order_id").alias("order_count"),
            F.count_distinct(customer).alias("unique_customer_count"),
            *([estimate.alias("approx_unique_customer_count")] if approximate else []),
            F.count("*").alias("_rows"),
            *(F.sum(column).alias(name) for name, column in sums.items()),
        )
    per_customer = orders.groupBy(*period, "customer_id").agg(
        F.count("order_id").alias("_orders"),
        F.count("*").alias("_rows"),
        *(F.sum(column).alias(name) for name, column in sums.items()),
    )
    # The sketch sees each customer once per period: copies do not change it,
    # and this keeps its buffer out of the much larger first step.
    estimate = F.approx_count_distinct(customer)
    return per_customer.groupBy(*period).agg(
        F.sum("_orders").alias("order_count"),
        F.count(customer).alias("unique_customer_count"),
        *([estimate.alias("approx_unique_customer_count")] if approximate else []),
        F.sum("_rows").alias("_rows"),
        *(F.sum(name).alias(name) for name in sums),
    )


def daily_orders_payments_summary(
    enriched_orders: DataFrame, exact_cents=True, unique_orders=True
) -> DataFrame:
    """Per day: orders, customers, payment coverage and totals, by date.

    ``enriched_orders`` comes from ``orders_with_payments``.
    """
    days = _count_orders_and_customers(
        enriched_orders,
        ["event_date"],
        {
            "orders_with_payment": F.col("has_payment"),
            "_paid": money.addend(F.col("payment_total_value"), exact_cents),
            "delivered_order_count": F.col("is_delivered"),
            "high_value_payment_order_count": F.col("has_high_value_payment"),
        },
        approximate=False,
        unique_orders=unique_orders,
    )
    return days.select(
        "event_date",
        "order_count",
        "unique_customer_count",
        "orders_with_payment",
        F.round(money.from_addend(F.col("_paid"), exact_cents), 2).alias(
            "total_payment_value"
        ),
        "delivered_order_count",
        "high_value_payment_order_count",
        money.share(
            F.col("orders_with_payment"), F.col("order_count"), exact_cents
        ).alias("payment_coverage_ratio"),
    ).orderBy("event_date")


def daily_sales_summary(
    staged_orders: DataFrame,
    staged_payments: DataFrame,
    exact_cents=True,
    unique_orders=True,
) -> DataFrame:
    """Per day: orders, customers (exact and estimated), revenue and ratios.

    An order is paid when any of its payments is above zero. The average runs
    over all orders of the day, unpaid ones included.
    """
    paid = payment_facts_by_order(staged_payments, exact_cents).drop("payment_count")
    orders = staged_orders.join(paid, on="order_id", how="left").fillna(
        {"payment_total_value": 0.0, "has_payment": 0}
    )
    days = _count_orders_and_customers(
        orders,
        ["event_date"],
        {
            "_revenue": money.addend(F.col("payment_total_value"), exact_cents),
            "orders_with_payment": F.col("has_payment"),
            "delivered_order_count": F.col("is_delivered"),
        },
        approximate=True,
        unique_orders=unique_orders,
    )
    revenue, order_count = F.col("_revenue"), F.col("order_count")
    return _with_summary_calendar(
        days.select(
            "event_date",
            "order_count",
            "unique_customer_count",
            "approx_unique_customer_count",
            F.round(money.from_addend(revenue, exact_cents), 2).alias("total_revenue"),
            money.per_head(revenue, F.col("_rows"), exact_cents).alias(
                "avg_revenue_per_order"
            ),
            "orders_with_payment",
            "delivered_order_count",
            money.share(
                F.col("orders_with_payment"), order_count, exact_cents
            ).alias("payment_coverage_ratio"),
            money.share(
                F.col("delivered_order_count"), order_count, exact_cents
            ).alias("delivered_order_ratio"),
        )
    )


def hourly_order_summary(staged_orders: DataFrame, unique_orders=True) -> DataFrame:
    """Per hour of purchase: orders and customers, exact and estimated."""
    orders = staged_orders.filter(F.col("order_purchase_ts").isNotNull()).select(
        F.date_trunc("hour", "order_purchase_ts").alias("order_hour_ts"),
        "order_id",
        "customer_id",
    )
    hours = _count_orders_and_customers(
        orders,
        ["order_hour_ts"],
        {},
        approximate=True,
        unique_orders=unique_orders,
    )
    # Date and hour follow from the hour's timestamp: no need to group by them.
    return _with_summary_calendar(
        hours.select(
            "order_hour_ts",
            F.to_date("order_hour_ts").alias("event_date"),
            F.hour("order_hour_ts").alias("order_hour"),
            "order_count",
            "unique_customer_count",
            "approx_unique_customer_count",
        )
    )


def orders_by_city_day(
    staged_orders: DataFrame, staged_customers: DataFrame, unique_orders=True
) -> DataFrame:
    """Per day, city and state: orders and customers.

    Orders of unlisted customers count under ``unknown``.
    """
    places = staged_customers.select("customer_id", "customer_city", "customer_state")
    unlisted = {"customer_city": UNKNOWN, "customer_state": UNKNOWN}
    place = ["event_date", "customer_city", "customer_state"]
    if unique_orders:
        per_customer = staged_orders.groupBy("event_date", "customer_id").agg(
            F.count("order_id").alias("_orders")
        )
        located = per_customer.join(places, on="customer_id", how="left")
        cities = located.fillna(unlisted).groupBy(*place).agg(
            F.sum("_orders").alias("order_count"),
            F.count("customer_id").alias("unique_customer_count"),
        )
    else:
        located = staged_orders.join(places, on="customer_id", how="left")
        cities = located.fillna(unlisted).groupBy(*place).agg(
            F.count_distinct("order_id").alias("order_count"),
            F.count_distinct("customer_id").alias("unique_customer_count"),
        )
    return _with_summary_calendar(cities)


def payment_ratio_by_day(
    staged_orders: DataFrame,
    staged_payments: DataFrame,
    exact_cents=True,
    unique_orders=True,
) -> DataFrame:
    """Per day: orders, and those with a numbered payment."""
    orders = staged_orders.join(
        sequenced_payments_by_order(staged_payments), on="order_id", how="left"
    ).fillna({"has_payment": 0})
    covered = F.when(F.col("has_payment") == 1, F.col("order_id"))
    count = F.count if unique_orders else F.count_distinct
    days = orders.groupBy("event_date").agg(
        count("order_id").alias("order_count"),
        count(covered).alias("orders_with_payment"),
    )
    ratio = money.share(
        F.col("orders_with_payment"), F.col("order_count"), exact_cents
    )
    return _with_summary_calendar(days.withColumn("payment_coverage_ratio", ratio))


def top_products_by_day(
    staged_orders: DataFrame,
    staged_items: DataFrame,
    k: int = 10,
    exact_cents=True,
    unique_orders=True,
) -> DataFrame:
    """Per day: the ``k`` products with the highest revenue, freight excluded.

    Equal revenues rank by product id. At most ``k`` products of a day leave a map
    task, however many it holds: up to ``spark.sql.optimizer.windowGroupLimitThreshold``
    Spark pushes the rank filter below the shuffle itself; for a larger ``k`` each
    task sorts its products and passes on the ``k`` best of every day, batch by batch,
    and the shuffle brings those together.
    """
    price = F.col("price_amount")
    per_order = staged_items.groupBy("order_id", "product_id").agg(
        money.total(price, exact_cents).alias("_revenue")
    )
    sales = per_order.join(
        staged_orders.select("order_id", "event_date"), on="order_id", how="inner"
    )
    count = F.count if unique_orders else F.count_distinct
    products = sales.groupBy("event_date", "product_id").agg(
        count("order_id").alias("order_count"),
        F.round(money.total(F.col("_revenue"), exact_cents), 2).alias(
            "product_revenue"
        ),
    )
    by_revenue = Window.partitionBy("event_date").orderBy(
        F.col("product_revenue").desc(), F.col("product_id").asc()
    )
    if k > int(products.sparkSession.conf.get(GROUP_LIMIT)):
        order = [("product_revenue", "descending"), ("product_id", "ascending")]
        products = keep_best(products, "event_date", order, k)
    ranked = products.withColumn("rank_in_day", F.row_number().over(by_revenue))
    return _with_summary_calendar(ranked.filter(F.col("rank_in_day") <= k))
