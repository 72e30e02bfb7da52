"""Product aggregates and the product dimension."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import as_double, band_label, keyword_label, safe_divide, surrogate_key
from ..schemas import (
    CATEGORY_MISSING,
    CATEGORY_OTHER,
    CATEGORY_RULES,
    TIER_BANDS,
    TIER_LOW,
    TIER_NONE,
    UNKNOWN_PRODUCT,
)
from .running import GROUP_ROWS, is_one_of, large_keys


def product_measures(silver: DataFrame, *, valid_only: bool = True, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Sales and return measures per stock code.

    With `valid_only` no return line gets in, so the return measures are zero;
    `valid_only=False` counts returns for real. Lines are shuffled once, by product, and
    customers and countries counted from their order in it. Products with more than
    `group_rows` lines are summed by customer and country before each shuffle instead, so
    a hot product is spread.
    """
    lines = silver.where(F.col("is_valid_transaction")) if valid_only else silver
    large = large_keys(lines, "stock_code", group_rows)
    if not large:
        figures = _figures_by_order(lines)
    else:
        is_large = is_one_of("stock_code", large)
        figures = _figures_by_order(lines.where(~is_large)).unionByName(_figures_combined(lines.where(is_large)))
    summed = figures.select(
        "stock_code", "unique_customers", "total_transactions", "total_units_sold", "total_units_returned",
        F.col("total_revenue").cast("decimal(25,2)").alias("total_revenue"),
        (as_double("_prices") / F.col("_priced")).alias("avg_unit_price"),
        "return_count", "countries_sold_in", *DAYS,
    )
    units = F.col("total_units_sold")
    return summed.select(
        "*",
        F.when(units > 0, as_double("total_units_returned") / units * 100).otherwise(0.0).alias("return_rate_percent"),
        F.coalesce(F.datediff("last_sale_date", "first_sale_date"), F.lit(0)).alias("days_available"),
        safe_divide("total_units_sold", "total_transactions").alias("avg_units_per_transaction"),
    )


DAYS = {"first_sale_date": F.min, "last_sale_date": F.max}


def _line_sums() -> dict[str, Column]:
    sold, returned = ~F.col("is_return"), F.col("is_return")
    price = F.when(sold, F.col("unit_price"))
    return {
        "total_units_sold": F.sum(F.when(sold, F.col("quantity")).otherwise(0)),
        "total_units_returned": F.sum(F.when(returned, F.abs("quantity")).otherwise(0)),
        "total_revenue": F.sum(F.when(sold, F.col("line_total")).otherwise(0)),
        "_prices": F.sum(price),
        "_priced": F.count(price),
        "total_transactions": F.count(F.lit(1)),
        "return_count": F.count_if(returned),
    }


def _figures_by_order(lines: DataFrame) -> DataFrame:
    """One shuffle of the lines by product; windows and sums then stay where the lines are."""
    narrow = lines.select(
        "stock_code", "customer_id", "country", "is_return", "quantity", "unit_price", "line_total", "invoice_date"
    ).repartition("stock_code")

    def begins(column: str, *then: str) -> Column:
        before = F.lag(column).over(Window.partitionBy("stock_code").orderBy(column, *then))
        return F.col(column).isNotNull() & ~F.col(column).eqNullSafe(before)

    # A customer's sales come before the returns: one whose first line is a return bought nothing.
    marked = narrow.withColumn("_buyer", begins("customer_id", "is_return") & ~F.col("is_return"))
    marked = marked.withColumn("_place", begins("country"))
    return marked.groupBy("stock_code").agg(
        F.count_if("_buyer").alias("unique_customers"), F.count_if("_place").alias("countries_sold_in"),
        *[m.alias(n) for n, m in _line_sums().items()], *[f("invoice_date").alias(n) for n, f in DAYS.items()],
    )


def _figures_combined(lines: DataFrame) -> DataFrame:
    """Lines summed once by product, customer and country; customers and countries counted from those sums.

    All state is of fixed width, so this stays a hash aggregation.
    """
    sums = _line_sums() | {"_sold": F.count_if(~F.col("is_return"))}
    groups = lines.groupBy("stock_code", "customer_id", "country").agg(
        *[c.alias(n) for n, c in sums.items()], *[f("invoice_date").alias(n) for n, f in DAYS.items()]
    )
    again = [F.sum(n).alias(n) for n in sums] + [f(n).alias(n) for n, f in DAYS.items()]
    customers = groups.groupBy("stock_code", "customer_id").agg(*again)
    buyers = F.count_if(F.col("customer_id").isNotNull() & (F.col("_sold") > 0))
    figures = customers.groupBy("stock_code").agg(buyers.alias("unique_customers"), *again)
    places = groups.select("stock_code", "country").distinct().groupBy(F.col("stock_code").alias("_code")).agg(
        F.count("country").alias("countries_sold_in")
    )
    joined = figures.join(places, F.col("stock_code").eqNullSafe(F.col("_code")))
    # Sums of sums are wider decimals; the figures of other products have these kinds.
    kinds = {"total_revenue": "decimal(25,2)", "_prices": "decimal(20,2)"}
    return joined.drop("_code", "_sold").withColumns({n: F.col(n).cast(k) for n, k in kinds.items()})


def product_metrics(silver: DataFrame, *, valid_only: bool = True) -> DataFrame:
    """`product_measures` with the lexically greatest description of the same lines."""
    lines = silver.where(F.col("is_valid_transaction")) if valid_only else silver
    names = lines.select("stock_code", "product_description").distinct()
    greatest = names.groupBy("stock_code").agg(F.max("product_description").alias("product_description"))
    return greatest.join(product_measures(silver, valid_only=valid_only), "stock_code")


def latest_description(silver: DataFrame) -> DataFrame:
    """Every stock code with its newest description, NULL if it never had one.

    Descriptions repeat on nearly every line, so each one's newest time is taken first
    (hash aggregation, fixed-width state) and only those few rows are ranked. Of two
    descriptions with the same newest time the lexically greater one wins.
    """
    seen = silver.groupBy("stock_code", "product_description").agg(F.max("invoice_timestamp").alias("last_seen"))
    rank = F.when(F.col("product_description").isNotNull(), F.struct("last_seen", "product_description"))
    return seen.groupBy("stock_code").agg(F.max_by("product_description", rank).alias("product_description"))


def with_category(products: DataFrame) -> DataFrame:
    """Category from description keywords and tier from revenue."""
    revenue = F.col("total_revenue")
    low = F.when(revenue > 0, TIER_LOW).otherwise(TIER_NONE)
    tier = band_label(revenue, TIER_BANDS, "")
    return products.select(
        "*",
        keyword_label("product_description", CATEGORY_RULES, CATEGORY_MISSING, CATEGORY_OTHER).alias(
            "product_category"
        ),
        F.when(tier != "", tier).otherwise(low).alias("performance_tier"),
    )


def build_dim_product(silver: DataFrame, updated_at: datetime | None = None) -> DataFrame:
    """Product dimension: all stock codes, with zero measures for those never validly sold."""
    names = latest_description(silver.where(F.col("stock_code").isNotNull()))
    metrics = product_measures(silver)
    zeros = (
        "unique_customers",
        "total_transactions",
        "total_units_sold",
        "total_units_returned",
        "total_revenue",
        "avg_unit_price",
        "return_count",
        "countries_sold_in",
        "return_rate_percent",
        "days_available",
        "avg_units_per_transaction",
    )
    joined = names.join(metrics, "stock_code", "left").fillna(0, subset=list(zeros))
    return with_category(joined).select(
        surrogate_key("stock_code").alias("product_key"),
        "stock_code",
        F.coalesce("product_description", F.lit(UNKNOWN_PRODUCT)).alias("product_description"),
        "product_category",
        "performance_tier",
        "avg_unit_price",
        "unique_customers",
        "total_transactions",
        "total_units_sold",
        "total_units_returned",
        "total_revenue",
        "return_count",
        "return_rate_percent",
        "countries_sold_in",
        "first_sale_date",
        "last_sale_date",
        "days_available",
        "avg_units_per_transaction",
        F.lit(updated_at or datetime.now()).cast("timestamp").alias("updated_at"),
        F.lit(True).alias("is_current"),
    )


def description_quality(products: DataFrame) -> DataFrame:
    """Whether a product has a usable description, and its length."""
    text = F.col("product_description")
    return products.select(
        "stock_code",
        "product_description",
        F.coalesce(F.length(text) > 0, F.lit(False)).alias("has_valid_description"),
        F.coalesce(F.length(text), F.lit(0)).alias("description_length"),
    )
