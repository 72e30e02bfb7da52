"""Exploratory reports over the raw lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from ..functions import as_double
from ..schemas import SOURCE_COLUMNS
from .insights import median
from .scores import distinct_row, merge_rows

Stage = Callable[[DataFrame], DataFrame]


def monthly_revenue(lines: DataFrame, at: str = "invoice_date", amount: str = "revenue") -> DataFrame:
    """Revenue per calendar month, with the month's first day."""
    months = (
        lines.where(F.col(at).isNotNull())
        .groupBy(F.trunc(at, "MM").alias("month_start"))
        .agg(F.sum(amount).alias("revenue"))
    )
    return months.select(
        F.year("month_start").alias("year"), F.month("month_start").alias("month"), "month_start", "revenue"
    )


def revenue_by(lines: DataFrame, key: str, top: int | None = 10) -> DataFrame:
    """Revenue per key value, highest first; ties by key."""
    summed = lines.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("revenue").alias("revenue"))
    ranked = summed.orderBy(F.desc_nulls_last("revenue"), key)
    return ranked.limit(top) if top else ranked


def customers_per_country(lines: DataFrame) -> DataFrame:
    known = lines.where(F.col("customer_id").isNotNull() & F.col("country").isNotNull())
    return known.groupBy("country").agg(F.countDistinct("customer_id").alias("customers"))


def customer_revenue_summary(lines: DataFrame, *, stage: Stage) -> DataFrame:
    """Number of customers and mean and median revenue per customer."""
    per_customer = stage(
        lines.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.coalesce(F.sum("revenue"), F.lit(0)).alias("revenue"))
    )
    totals = per_customer.agg(
        F.count(F.lit(1)).alias("total_customers"),
        (as_double(F.sum("revenue")) / F.count(F.lit(1))).alias("mean_revenue"),
    )
    return merge_rows(totals, median(per_customer, "revenue", "median_revenue", stage=stage))


def product_totals(lines: DataFrame) -> DataFrame:
    """Revenue, quantity and earliest description per product.

    Lines are first summed per product and description, so picking the description ranks
    a handful of rows per product.
    """
    named = (
        lines.where(F.col("stock_code").isNotNull())
        .groupBy("stock_code", "description")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.sum("quantity").alias("quantity"),
            F.min("invoice_date").alias("first_at"),
        )
    )
    described = F.col("description").isNotNull()
    rank = F.when(described, F.struct(F.col("first_at").isNull(), "first_at", "description"))
    return named.groupBy("stock_code").agg(
        F.sum("revenue").alias("revenue"),
        F.sum("quantity").alias("quantity"),
        F.min_by("description", rank).alias("first_description"),
    )


def top_products(lines: DataFrame, top: int = 10) -> DataFrame:
    """Products by revenue with the first 30 characters of a description."""
    ranked = product_totals(lines).orderBy(F.desc_nulls_last("revenue"), "stock_code").limit(top)
    label = F.coalesce(F.substring("first_description", 1, 30), F.lit("No Description"))
    return ranked.select("stock_code", "revenue", "quantity", label.alias("description"))


def issue_counts(lines: DataFrame) -> DataFrame:
    """Lines with each of four problems, with their share of all lines."""
    tests = {
        "negative_quantity": F.col("quantity") < 0,
        "zero_or_negative_price": F.col("unit_price") <= 0,
        "missing_customer": F.col("customer_id").isNull(),
        "missing_description": F.col("description").isNull(),
    }
    counted = lines.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(t).alias(name) for name, t in tests.items()])
    return counted.unpivot(["rows"], list(tests), "issue", "records").select(
        "issue", "records", (F.col("records") / F.col("rows") * 100).alias("percentage")
    )


def exploration_summary(lines: DataFrame, profiles: DataFrame) -> DataFrame:
    """One record: rows and columns, span, revenue, distinct keys, number of issues, missing values of each column.

    Distinct and missing counts come from the column profiles; the mean order value sums
    each invoice first.
    """
    at = F.col("invoice_date")
    totals = lines.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.min(at).alias("first_date"),
        F.max(at).alias("last_date"),
        as_double(F.sum("revenue")).alias("total_revenue"),
        (as_double(F.sum("revenue")) / F.count("revenue")).alias("revenue_per_line"),
        (
            F.max((F.col("quantity") < 0).cast("int"))
            + F.max((F.col("unit_price") <= 0).cast("int"))
            + F.max(F.col("customer_id").isNull().cast("int"))
            + F.max(F.col("description").isNull().cast("int"))
        ).alias("data_quality_issues"),
        F.lit(len(SOURCE_COLUMNS)).alias("total_columns"),
    )
    nulls = lambda c: F.max(F.when(F.col("column_name") == c, F.col("null_count")))
    missing = profiles.agg(*[nulls(c).alias(f"missing_{c.removesuffix('_id')}") for c in SOURCE_COLUMNS])
    orders = lines.where(F.col("invoice").isNotNull()).groupBy("invoice").agg(F.sum("revenue").alias("value"))
    order_value = orders.agg((as_double(F.sum("value")) / F.count("value")).alias("avg_order_value"))
    names = {"unique_customers": "customer_id", "unique_products": "stock_code", "countries": "country"}
    distinct = distinct_row(profiles, names)
    return merge_rows(totals, order_value, distinct, missing)


def as_json(report: DataFrame) -> DataFrame:
    """Each report row as one JSON text."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("report"))


def described_products(lines: DataFrame) -> DataFrame:
    """Products in all, and products with any description."""
    products = lines.where(F.col("stock_code").isNotNull()).groupBy("stock_code").agg(F.count("description").alias("described"))
    return products.agg(
        F.count(F.lit(1)).alias("total_products"), F.count_if(F.col("described") > 0).alias("described_products")
    )
