"""Batch flow: raw files to curated, staged and gold tables, and their checks.

Each step reads the tables before it from storage and writes one table, so steps
can run as separate applications and a lost step is repeated on its own.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from millrace import schemas
from millrace.operators import gold, payments, quality, staging
from millrace.operators.layout import compare_layouts
from millrace.sources.readers import read_csv, read_events, read_table
from millrace.sources.sinks import write_table

SUMMARY_MONTH = ("summary_year", "summary_month")
DAY = ("event_date",)


@dataclass(frozen=True)
class Warehouse:
    """Folders of the layers; a table is a sub-folder named after it."""

    spark: SparkSession
    raw: str
    curated: str
    gold: str

    def raw_orders(self) -> DataFrame:
        return read_csv(self.spark, f"{self.raw}/orders", schemas.RAW_ORDERS)

    def raw_order_items(self) -> DataFrame:
        return read_csv(self.spark, f"{self.raw}/order_items", schemas.RAW_ORDER_ITEMS)

    def raw_payments(self) -> DataFrame:
        return read_csv(self.spark, f"{self.raw}/payments", schemas.RAW_PAYMENTS)

    def raw_customers(self) -> DataFrame:
        return read_csv(self.spark, f"{self.raw}/customers", schemas.RAW_CUSTOMERS)

    def raw_order_events(self) -> DataFrame:
        return read_events(self.spark, f"{self.raw}/order_events")

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.curated}/{name}")

    def gold_table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.gold}/{name}")


def build_curated(
    house: Warehouse, event_key: Sequence[str] = staging.MESSAGE_POSITION
) -> None:
    """Orders, order items and order events of the curated layer."""
    month = ("order_year", "order_month")
    orders = staging.curate_orders(house.raw_orders())
    write_table(orders, f"{house.curated}/orders", month)
    items = staging.curate_order_items(house.raw_order_items())
    write_table(items, f"{house.curated}/order_items")
    events = staging.curate_order_events(house.raw_order_events(), event_key)
    write_table(
        events, f"{house.curated}/order_created_events", ("event_year", "event_month")
    )


def build_staged(
    house: Warehouse, event_key: Sequence[str] = staging.MESSAGE_POSITION
) -> None:
    """The five staged tables. ``amount_report`` tells what bad amounts cost."""
    orders = staging.stage_orders(house.raw_orders())
    write_table(orders, f"{house.curated}/stg_orders", DAY)
    paid = staging.stage_payments(house.raw_payments())
    write_table(paid, f"{house.curated}/stg_payments")
    items = staging.stage_order_items(house.raw_order_items())
    write_table(items, f"{house.curated}/stg_order_items")
    customers = staging.stage_customers(house.raw_customers())
    write_table(customers, f"{house.curated}/stg_customers")
    events = staging.stage_order_events(house.raw_order_events(), event_key)
    write_table(events, f"{house.curated}/stg_order_events", DAY)


def build_daily_orders_payments(house: Warehouse, exact_cents=True) -> None:
    """The first daily summary, from orders joined with their payments."""
    per_order = payments.payments_by_order(house.table("stg_payments"), exact_cents)
    enriched = payments.orders_with_payments(house.table("stg_orders"), per_order)
    write_table(
        gold.daily_orders_payments_summary(enriched, exact_cents),
        f"{house.curated}/daily_orders_payments_summary",
    )


def build_gold(house: Warehouse, top_products: int = 10, exact_cents=True) -> None:
    """The five gold tables, each laid out by year and month."""
    orders = house.table("stg_orders")
    paid = house.table("stg_payments")
    tables = {
        "daily_sales_summary": gold.daily_sales_summary(orders, paid, exact_cents),
        "hourly_order_summary": gold.hourly_order_summary(orders),
        "orders_by_city_day": gold.orders_by_city_day(
            orders, house.table("stg_customers")
        ),
        "payment_ratio_by_day": gold.payment_ratio_by_day(orders, paid, exact_cents),
        "top_products_by_day": gold.top_products_by_day(
            orders, house.table("stg_order_items"), top_products, exact_cents=exact_cents
        ),
    }
    for name, table in tables.items():
        write_table(table, f"{house.gold}/{name}", SUMMARY_MONTH)


def amount_report(house: Warehouse) -> DataFrame:
    """Raw amounts that staging rejects, by column and reason."""
    items = quality.rejected_amounts(
        house.raw_order_items(), "price", "freight_value"
    )
    return items.union(quality.rejected_amounts(house.raw_payments(), "payment_value"))


def validate(house: Warehouse, include_unmatched=True) -> None:
    """Raise when a gold rule finds bad rows."""
    report = quality.validate_gold(
        house.gold_table("daily_sales_summary"),
        house.gold_table("hourly_order_summary"),
        include_unmatched,
        house.table("stg_orders"),
    )
    quality.require_passed(report)


def compare_daily_layouts(house: Warehouse, folder: str) -> DataFrame:
    """Folders and files of the daily table by date and by month."""
    return compare_layouts(
        house.gold_table("daily_sales_summary"),
        {"by_event_date": DAY, "by_year_month": SUMMARY_MONTH},
        folder,
    )
