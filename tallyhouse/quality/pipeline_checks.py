"""End-to-end validation of the star schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import as_double, packed_key

PASS, FAIL = "✅ PASS", "❌ FAIL"  # fixed values


def key_usage(fact: DataFrame) -> DataFrame:
    """Rows per dimension key of the fact: (dimension, packed key, n), from one pass.

    Counting first turns the later joins into joins of distinct keys, however hot one is.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("dimension"), packed_key(c).alias("key"))
            for c in ("product_key", "date_key", "customer_key")
        ]
    )
    return fact.select(F.inline(pairs)).groupBy("dimension", "key").agg(F.count(F.lit(1)).alias("n"))


def orphan_counts(fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Counts of the four integrity checks, one row: NULL product keys, unknown product
    keys, dates without a calendar row (NULL included), unknown customer keys."""
    dims = {"product_key": dim_product, "date_key": dim_date, "customer_key": dim_customer}
    known = reduce(
        DataFrame.unionByName,
        [d.select(F.lit(c).alias("dimension"), packed_key(c).alias("key")) for c, d in dims.items()],
    )
    lost = key_usage(fact).join(known, ["dimension", "key"], "left_anti")
    missing = F.col("key").isNull()

    def total(dimension: str, test: Column) -> Column:
        return F.coalesce(F.sum(F.when((F.col("dimension") == dimension) & test, F.col("n"))), F.lit(0))

    return lost.agg(
        total("product_key", missing).alias("product_key"),
        total("product_key", ~missing).alias("product_key_invalid"),
        total("date_key", F.lit(True)).alias("date_key"),
        total("customer_key", ~missing).alias("customer_key_invalid"),
    )


def referential_integrity(
    fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame, dim_customer: DataFrame, *, only_failing: bool = True
) -> DataFrame:
    """Integrity checks with their orphans and the total; passes when no row comes back."""
    counts = orphan_counts(fact, dim_product, dim_date, dim_customer)
    long = counts.unpivot([], counts.columns, "dimension", "orphan_count")
    summary = long.withColumn("total_orphans", F.sum("orphan_count").over(Window.partitionBy()))
    return summary.where(F.col("orphan_count") > 0) if only_failing else summary


def pipeline_checks(
    fact: DataFrame, dim_product: DataFrame, dim_date: DataFrame, dim_customer: DataFrame
) -> DataFrame:
    """The seven end-to-end checks as (check_name, failed_records, status)."""
    expected = F.col("quantity") * F.col("unit_price")
    required = ("date_key", "quantity", "unit_price", "line_total")
    measures = fact.agg(
        F.count_if(F.abs(F.col("line_total") - expected) > 0.01).alias("Revenue Calculation Check"),
        F.count_if(F.col("unit_price") < 0).alias("Negative Unit Prices"),
        F.count_if(reduce(Column.__or__, [F.col(c).isNull() for c in required])).alias("NULL Required Fields (Fact)"),
    )
    orphans = orphan_counts(fact, dim_product, dim_date, dim_customer).select(
        F.col("product_key").alias("Orphaned Product Keys"),
        F.col("product_key_invalid").alias("Referential Integrity - Products"),
        F.col("customer_key_invalid").alias("Referential Integrity - Customers"),
        F.col("date_key").alias("Referential Integrity - Dates"),
    )
    rows = _long(orphans).unionByName(_long(measures))
    return rows.withColumn("status", F.when(F.col("failed_records") == 0, PASS).otherwise(FAIL))


def _long(one_row: DataFrame) -> DataFrame:
    quoted = [F.col(f"`{c}`").alias(c) for c in one_row.columns]
    pairs = F.array(
        *[F.struct(F.lit(c).alias("check_name"), q.alias("failed_records")) for c, q in zip(one_row.columns, quoted)]
    )
    return one_row.select(F.inline(pairs))


def orphan_summary(fact: DataFrame) -> DataFrame:
    """Lines and invoices without a product key."""
    lost = fact.where(F.col("product_key").isNull())
    return lost.agg(
        F.count(F.lit(1)).alias("total_orphans"), F.countDistinct("invoice_number").alias("affected_invoices")
    )


def unmatched_codes(silver: DataFrame, dim_product: DataFrame, top: int | None = 10) -> DataFrame:
    """Stock codes of the lines that the product dimension lacks, most frequent first."""
    used = silver.groupBy("stock_code").agg(F.count(F.lit(1)).alias("occurrence_count"))
    lost = used.where(F.col("stock_code").isNotNull()).join(dim_product.select("stock_code"), "stock_code", "left_anti")
    ranked = lost.orderBy(F.desc("occurrence_count"), "stock_code")
    return ranked.limit(top) if top else ranked


def layer_summary(
    bronze: DataFrame,
    silver: DataFrame,
    dim_customer: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    fact: DataFrame,
) -> DataFrame:
    """Record count and three measures of each table, as text."""
    rows = F.count(F.lit(1))

    def summary(df: DataFrame, layer: str, table: str, second: Column, third: Column, fourth: Column) -> DataFrame:
        measures = {"record_count": rows, "metric_2": second, "metric_3": third, "metric_4": fourth}
        return df.agg(*[m.cast("string").alias(name) for name, m in measures.items()]).select(
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), *measures
        )

    mean_value = as_double(F.sum("total_lifetime_value")) / rows
    parts = [
        summary(
            bronze, "BRONZE", "online_retail_raw",
            F.countDistinct("load_batch_id"), F.min("load_timestamp"), F.max("load_timestamp"),
        ),
        summary(
            silver, "SILVER", "stg_bronze__online_retail",
            F.countDistinct("invoice_number"), F.min("invoice_date"), F.max("invoice_date"),
        ),
        summary(
            dim_customer, "GOLD", "dim_customer",
            F.round(mean_value, 2).cast("decimal(20,2)"), F.min("first_purchase_date"), F.max("last_purchase_date"),
        ),
        summary(
            dim_product, "GOLD", "dim_product",
            F.sum("total_revenue"), F.min("first_sale_date"), F.max("last_sale_date"),
        ),
        summary(dim_date, "GOLD", "dim_date", F.min("year_number"), F.min("full_date"), F.max("full_date")),
        summary(fact, "GOLD", "fact_sales", F.sum("line_total"), F.min("date_key"), F.max("date_key")),
    ]
    return reduce(DataFrame.unionByName, parts)
