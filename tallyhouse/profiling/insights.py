"""Business figures of the profiled lines."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import as_double
from ..operators.running import exact_quantiles
from .columns import aggregate
from .scores import merge_rows

Stage = Callable[[DataFrame], DataFrame]

HOME_COUNTRY = "United Kingdom"


def with_revenue(lines: DataFrame) -> DataFrame:
    return lines.withColumn("revenue", F.col("quantity") * F.col("unit_price"))


def median(values: DataFrame, column: str, name: str, *, stage: Stage) -> DataFrame:
    """Exact median of a column as a one-row frame; equal values are counted first."""
    counts = stage(
        values.where(F.col(column).isNotNull())
        .groupBy(as_double(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(column).alias("column_name"), "value", "n")
    )
    return exact_quantiles(counts, {name: 0.5}, stage=stage).select(name)


REVENUE_AGGREGATES = {
    "total_revenue": "cast(sum(revenue) as double)",
    "average_transaction_value": "try_divide(cast(sum(revenue) as double), count(revenue))",
    "highest_single_transaction": "cast(max(revenue) as double)",
    "negative_revenue_transactions": "count_if(revenue < 0)",
}


def revenue_analysis(lines: DataFrame, *, stage: Stage) -> DataFrame:
    """Total, mean, exact median and highest line revenue and the number of negative lines."""
    priced = with_revenue(lines).select("revenue")
    middle = median(priced, "revenue", "median_transaction_value", stage=stage)
    return merge_rows(aggregate(priced, REVENUE_AGGREGATES), middle)


def customer_analysis(customers: DataFrame) -> DataFrame:
    """Customer coverage and lines per customer, from (value, n) rows of the customer ids,
    with one row for the lines without an id."""
    summed = customers.selectExpr(
        "count(value) as total_customers",
        "coalesce(sum(n) filter (where value is not null), 0) as transactions_with_customer_id",
        "coalesce(sum(n) filter (where value is null), 0) as anonymous_transactions",
        "max(n) filter (where value is not null) as max_transactions_by_single_customer",
        "count_if(value is not null and n > 1) as repeat_customers",
    )
    return summed.selectExpr(
        "*",
        "try_divide(transactions_with_customer_id * 100, transactions_with_customer_id + anonymous_transactions) "
        "as customer_id_coverage",
        "try_divide(transactions_with_customer_id, total_customers) as avg_transactions_per_customer",
    )


def _labelled(rows: DataFrame, section: str, label: Column | str, n: Column | str) -> DataFrame:
    text = F.col(label) if isinstance(label, str) else label
    number = F.col(n) if isinstance(n, str) else n
    return rows.select(F.lit(section).alias("section"), text.cast("string").alias("label"), number.cast("bigint").alias("n"))


def _stack(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _metrics(one_row: DataFrame) -> DataFrame:
    """A one-row frame as (section, label, n) rows, one per column."""
    pairs = ", ".join(f"'{c}', cast({c} as bigint)" for c in one_row.columns)
    return one_row.selectExpr(f"stack({len(one_row.columns)}, {pairs}) as (section, n)").selectExpr(
        "section", "cast(null as string) as label", "n"
    )


def geographic_analysis(countries: DataFrame, home: str = HOME_COUNTRY, top: int = 10) -> DataFrame:
    """Countries by lines, and home against all others (a missing country is not home),
    from (value, n) rows."""
    at_home = F.col("value").eqNullSafe(home)
    totals = countries.agg(
        F.count("value").alias("total_countries"),
        F.coalesce(F.sum(F.when(at_home, F.col("n"))), F.lit(0)).alias("home_transactions"),
        F.coalesce(F.sum(F.when(~at_home, F.col("n"))), F.lit(0)).alias("international_transactions"),
    )
    leaders = countries.where(F.col("value").isNotNull()).orderBy(F.desc("n"), "value").limit(top)
    return _stack(_metrics(totals), _labelled(leaders, "top_country", "value", "n"))


def product_analysis(products: DataFrame, top: int = 10) -> DataFrame:
    """Products by lines, and products seen once, from (value, n) rows."""
    known = products.where(F.col("value").isNotNull())
    totals = known.agg(
        F.count(F.lit(1)).alias("total_products"), F.count_if(F.col("n") == 1).alias("single_transaction_products")
    )
    leaders = known.orderBy(F.desc("n"), "value").limit(top)
    return _stack(_metrics(totals), _labelled(leaders, "popular_product", "value", "n"))


def temporal_analysis(hourly: DataFrame, top_hours: int = 5) -> DataFrame:
    """Lines by hour, weekday, month and weekend, from rows per day and hour."""
    day, n = F.col("day"), F.col("n")
    dated = hourly.where(day.isNotNull())
    weekend = F.coalesce(F.dayofweek(day).isin(1, 7), F.lit(False))

    def by(label: Column) -> DataFrame:
        return dated.groupBy(label.alias("label")).agg(F.sum("n").alias("n"))

    hours = by(F.col("hour")).orderBy(F.desc("n"), "label").limit(top_hours)
    halves = hourly.agg(
        F.coalesce(F.sum(F.when(weekend, n)), F.lit(0)).alias("weekend_transactions"),
        F.coalesce(F.sum(F.when(~weekend, n)), F.lit(0)).alias("weekday_transactions"),
    )
    return _stack(
        _labelled(hours, "peak_hour", "label", "n"),
        _labelled(by(F.date_format(day, "EEEE")), "weekday", "label", "n"),
        _labelled(by(F.date_format(day, "MMMM")), "month", "label", "n"),
        _metrics(halves),
    )
