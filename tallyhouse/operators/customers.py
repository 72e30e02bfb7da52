"""Customer aggregates and the customer dimension."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import as_double, band_label, surrogate_key
from ..schemas import (
    FREQUENCY_BANDS,
    FREQUENCY_OTHER,
    RECENCY_BANDS,
    RECENCY_OTHER,
    VALUE_BANDS,
    VALUE_OTHER,
)

Stage = Callable[[DataFrame], DataFrame]


def registered_sales(silver: DataFrame) -> DataFrame:
    """Valid lines of known customers, without returns and cancelled invoices."""
    return silver.where(
        F.col("customer_id").isNotNull()
        & F.col("is_valid_transaction")
        & ~F.col("is_return")
        & ~F.col("is_cancelled")
    )


def invoice_totals(sales: DataFrame) -> DataFrame:
    """Lines summed per customer, country and invoice: the common base of both customer
    aggregates, far smaller than the lines and free of distinct counts."""
    return sales.groupBy("customer_id", "country", "invoice_number").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("line_total").alias("value"),
        F.sum("quantity").alias("units"),
        F.min("invoice_date").alias("first_date"),
        F.max("invoice_date").alias("last_date"),
    )


def customer_country_totals(totals: DataFrame) -> DataFrame:
    """Lifetime measures per customer and country. Every group row is one distinct order."""
    summed = totals.groupBy("customer_id", "country").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.sum("lines").alias("total_line_items"),
        F.sum("value").alias("total_lifetime_value"),
        F.sum("units").alias("total_units_purchased"),
        F.min("first_date").alias("first_purchase_date"),
        F.max("last_date").alias("last_purchase_date"),
    )
    return summed.select(
        "customer_id",
        "country",
        "total_orders",
        "total_line_items",
        "total_lifetime_value",
        (as_double("total_lifetime_value") / F.col("total_line_items")).alias("avg_line_item_value"),
        "total_units_purchased",
        "first_purchase_date",
        "last_purchase_date",
        F.datediff("last_purchase_date", "first_purchase_date").alias("customer_tenure_days"),
    )


def order_values(totals: DataFrame) -> DataFrame:
    """Value of each order of a customer, over all its countries."""
    return totals.groupBy("customer_id", "invoice_number").agg(F.sum("value").alias("order_value"))


def customer_order_stats(orders: DataFrame) -> DataFrame:
    value = F.col("order_value")
    return orders.groupBy("customer_id").agg(
        (as_double(F.sum(value)) / F.count(value)).alias("avg_order_value"),
        F.max(value).alias("max_order_value"),
        F.min(value).alias("min_order_value"),
        F.stddev_samp(as_double(value)).alias("stddev_order_value"),
    )


def customer_transactions(silver: DataFrame, *, stage: Stage = lambda df: df) -> DataFrame:
    """Customer and country aggregate with per-customer order statistics.

    `stage` is applied to the invoice totals, which both branches read.
    """
    totals = stage(invoice_totals(registered_sales(silver)))
    stats = customer_order_stats(order_values(totals))
    orders, tenure = F.col("total_orders"), as_double("customer_tenure_days")
    return (
        customer_country_totals(totals)
        .join(stats, "customer_id", "left")
        .withColumn("avg_days_between_orders", F.when(orders > 1, tenure / (orders - 1)))
    )


def main_country(customers: DataFrame) -> DataFrame:
    """One row per customer: the country with most orders, then most value, then first name.

    An aggregate, not a window: it combines before the shuffle.
    """
    rank = F.struct(-F.col("total_orders"), -F.col("total_lifetime_value"), F.col("country"))
    rest = F.struct(*[c for c in customers.columns if c != "customer_id"])
    return (
        customers.groupBy("customer_id").agg(F.min_by(rest, rank).alias("_main")).select("customer_id", "_main.*")
    )


def with_segments(customers: DataFrame, as_of: date | Column) -> DataFrame:
    """Frequency, value and recency bands and their combined letter code."""
    today = as_of if isinstance(as_of, Column) else F.lit(as_of)
    idle_days = F.datediff(today, F.col("last_purchase_date"))
    banded = customers.select(
        "*",
        band_label("total_orders", FREQUENCY_BANDS, FREQUENCY_OTHER).alias("frequency_segment"),
        band_label("total_lifetime_value", VALUE_BANDS, VALUE_OTHER).alias("value_segment"),
        band_label(idle_days, RECENCY_BANDS, RECENCY_OTHER, descending=False).alias("recency_segment"),
    )
    letters = [F.substring(c, 1, 1) for c in ("recency_segment", "frequency_segment", "value_segment")]
    return banded.withColumn("rfm_segment", F.concat_ws("-", *letters))


def build_dim_customer(
    silver: DataFrame, as_of: date, updated_at: datetime | None = None, *, stage: Stage = lambda df: df
) -> DataFrame:
    """Customer dimension: one current row per customer."""
    customers = with_segments(main_country(customer_transactions(silver, stage=stage)), as_of)
    return customers.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "country",
        "total_orders",
        "total_line_items",
        "total_units_purchased",
        "total_lifetime_value",
        "avg_order_value",
        "max_order_value",
        "min_order_value",
        "avg_line_item_value",
        "avg_days_between_orders",
        "first_purchase_date",
        "last_purchase_date",
        "customer_tenure_days",
        "frequency_segment",
        "value_segment",
        "recency_segment",
        "rfm_segment",
        F.lit(updated_at or datetime.now()).cast("timestamp").alias("updated_at"),
        F.lit(True).alias("is_current"),
    )
