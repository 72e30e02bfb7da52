"""Sales fact and its daily summary."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import packed_key, surrogate_key, unpacked_key
from .joins import lookup_join, surrogate_lookup
from .running import is_one_of

# A day of up to so many lines is summed from one shuffle of its lines.
DAY_ROWS = 2_000_000


def build_fact_sales(
    silver: DataFrame,
    dim_date: DataFrame,
    dim_product: DataFrame,
    dim_customer: DataFrame,
    dim_geography: DataFrame | None = None,
    loaded_at: datetime | None = None,
    carry: dict[str, str] | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    **join_limits,
) -> DataFrame:
    """One row per line inside the calendar, with the keys of its dimensions.

    Lines without a known customer keep a NULL customer key. Each dimension is cut to its
    two key columns before the lookup; with `stage`, a large one whose keys are hashes of
    its natural keys needs no shuffle of lines. `carry` maps extra output names to line columns.
    """
    measures = [
        "bronze_id",
        "invoice_number",
        "stock_code",
        "customer_id",
        "invoice_date",
        "quantity",
        "unit_price",
        "line_total",
        "is_return",
        "is_cancelled",
        "is_valid_transaction",
    ]
    if dim_geography is not None:
        measures.append("country")
    carry = carry or {}
    lines = silver.select(*measures, *carry.values())
    dates = dim_date.select(F.col("full_date").alias("invoice_date"), "date_key")
    lookups = [(dim_product, "stock_code", "product_key"), (dim_customer, "customer_id", "customer_key")]
    if dim_geography is not None:
        lookups.append((dim_geography, "country", "geography_key"))
    keyed = lookup_join(lines, dates, "invoice_date", "inner", measured=silver, **join_limits)
    for dim, natural, surrogate in lookups:
        if stage:
            keyed = surrogate_lookup(keyed, dim, natural, surrogate, stage=stage, measured=silver, **join_limits)
        else:
            keyed = lookup_join(keyed, dim.select(natural, surrogate), natural, measured=silver, **join_limits)
    places = [] if dim_geography is None else ["geography_key"]
    return keyed.select(
        surrogate_key("bronze_id").alias("sale_key"),
        "date_key",
        "product_key",
        "customer_key",
        *places,
        "invoice_number",
        "quantity",
        "unit_price",
        "line_total",
        F.lit(0).alias("discount_amount"),
        F.col("line_total").alias("net_amount"),
        "is_return",
        "is_cancelled",
        "is_valid_transaction",
        F.col("bronze_id").alias("source_bronze_id"),
        F.lit(loaded_at or datetime.now()).cast("timestamp").alias("loaded_at"),
        *[F.col(column).alias(name) for name, column in carry.items()],
    )


def fact_sales_daily(fact: DataFrame, *, day_rows: int = DAY_ROWS) -> DataFrame:
    """Sales per day, product and country.

    Quantity and sales cover lines that are not returns; total_returns counts return
    lines; net is sales less the absolute amount of the returns. Lines are shuffled once, by
    their group, and distinct customers and invoices counted from their order in it. A group
    is part of a day, so only days with more than `day_rows` lines can have a large one: these
    are combined by customer and by invoice before each shuffle, a group of any size.
    """
    days = fact.groupBy("date_key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > day_rows)
    # At most one day for every `day_rows` lines, and few hundred days a year.
    large = [r["date_key"] for r in days.collect()]
    if not large:
        daily = _daily_by_order(fact)
    else:
        is_large = is_one_of("date_key", large)
        daily = _daily_by_order(fact.where(~is_large)).unionByName(_daily_combined(fact.where(is_large)))
    net = F.col("total_sales_amount") - F.col("total_return_amount")
    return daily.withColumn("net_sales_amount", net)


DAY_KEYS = ("date_key", "product_key", "geography_key")


def _daily_measures() -> dict[str, Column]:
    returned = F.col("is_return")
    return {
        "total_quantity": F.sum(F.when(~returned, F.col("quantity")).otherwise(0)),
        "total_sales_amount": F.sum(F.when(~returned, F.col("line_total")).otherwise(0)),
        "total_returns": F.count_if(returned),
        "total_return_amount": F.sum(F.when(returned, F.abs("line_total")).otherwise(0)),
    }


def _daily_by_order(fact: DataFrame) -> DataFrame:
    """One shuffle of the lines by group; windows and sums then stay where the lines are."""
    lines = fact.select(
        "date_key", packed_key("product_key").alias("product_key"), packed_key("geography_key").alias("geography_key"),
        packed_key("customer_key").alias("customer_key"), "invoice_number", "is_return", "quantity", "line_total",
    ).repartition(*DAY_KEYS)

    def begins(column: str) -> Column:
        """1 for the first line of each value of the column in its group, 0 for others and for NULL."""
        before = F.lag(column).over(Window.partitionBy(*DAY_KEYS).orderBy(column))
        return (F.col(column).isNotNull() & ~F.col(column).eqNullSafe(before)).cast("bigint")

    marked = lines.withColumn("_customer", begins("customer_key")).withColumn("_invoice", begins("invoice_number"))
    daily = marked.groupBy(*DAY_KEYS).agg(
        *[m.alias(n) for n, m in _daily_measures().items()],
        F.sum("_customer").alias("unique_customers"), F.sum("_invoice").alias("unique_invoices"),
    )
    return daily.withColumns({c: unpacked_key(c) for c in ("product_key", "geography_key")})


def _daily_combined(fact: DataFrame) -> DataFrame:
    """Customers and invoices counted from one row each per group, summed up beside the measures."""
    measures = _daily_measures()
    by_customer = fact.groupBy(*DAY_KEYS, "customer_key").agg(*[m.alias(n) for n, m in measures.items()])
    kinds = dict(by_customer.dtypes)
    customers = by_customer.withColumn("unique_customers", F.col("customer_key").isNotNull().cast("bigint"))
    invoices = fact.select(*DAY_KEYS, "invoice_number").distinct().select(
        *DAY_KEYS, F.col("invoice_number").isNotNull().cast("bigint").alias("unique_invoices")
    )
    return customers.drop("customer_key").unionByName(invoices, allowMissingColumns=True).groupBy(*DAY_KEYS).agg(
        *[F.sum(n).cast(kinds[n]).alias(n) for n in measures],
        F.sum("unique_customers").alias("unique_customers"),
        F.sum("unique_invoices").alias("unique_invoices"),
    )
