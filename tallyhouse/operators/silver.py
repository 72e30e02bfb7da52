"""Silver: typed, trimmed line items with quality flags, and the rows that were refused."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import day_of_week, null_if_token, surrogate_key
from ..schemas import LINE_ORDER, LINEAGE_COLUMNS, NULL_TOKENS, QUANTITY_BOUNDS
from .running import number_rows

# Shapes of text that may become a number.
INTEGER_TEXT = r"^-?[0-9]+\z"
PRICE_TEXT = r"^[0-9]+\.?[0-9]*\z"


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def typed_lines(bronze: DataFrame, null_tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Every bronze line with typed columns, date parts and flags; nothing is dropped.

    Text that does not fit its type becomes NULL. Lines marked as deleted are left out.
    """
    if "is_deleted" in bronze.columns:
        bronze = bronze.where(~F.col("is_deleted"))
    lineage = [c for c in LINEAGE_COLUMNS if c in bronze.columns]
    stamp = null_if_token(F.trim("invoice_date"), null_tokens)
    typed = bronze.select(
        "bronze_id",
        F.trim("invoice").alias("invoice_number"),
        F.trim("stock_code").alias("stock_code"),
        null_if_token(F.trim("description"), null_tokens).alias("product_description"),
        F.when(F.col("quantity").rlike(INTEGER_TEXT), F.col("quantity").try_cast("int")).alias("quantity"),
        F.when(F.col("unit_price").rlike(PRICE_TEXT), F.col("unit_price").try_cast("decimal(10,2)")).alias(
            "unit_price"
        ),
        stamp.try_cast("timestamp_ntz").alias("invoice_timestamp"),
        null_if_token("customer_id", null_tokens).alias("customer_id"),
        F.trim(F.upper("country")).alias("country"),
        *lineage,
    )
    quantity, price, at = F.col("quantity"), F.col("unit_price"), F.col("invoice_timestamp")
    complete = ("invoice_number", "stock_code", "quantity", "unit_price", "invoice_timestamp", "country")
    description = F.col("product_description")
    return typed.select(
        "*",
        (quantity * price).try_cast("decimal(15,2)").alias("line_total"),
        F.to_date(at).alias("invoice_date"),
        F.year(at).alias("invoice_year"),
        F.month(at).alias("invoice_month"),
        day_of_week(at).alias("invoice_day_of_week"),
        F.hour(at).alias("invoice_hour"),
        _flag(quantity < 0).alias("is_return"),
        _flag(F.col("invoice_number").startswith("C")).alias("is_cancelled"),
        reduce(Column.__and__, [F.col(c).isNotNull() for c in complete]).alias("is_complete_record"),
        F.col("customer_id").isNotNull().alias("has_customer_id"),
        _flag(F.length(description) > 0).alias("has_product_description"),
        _flag((quantity > 0) & (price > 0)).alias("is_valid_transaction"),
    )


def line_rules(bounds: tuple[int, int] = QUANTITY_BOUNDS) -> dict[str, Column]:
    """Reason for refusal -> condition a clean line meets."""
    quantity, price = F.col("quantity"), F.col("unit_price")
    return {
        "missing_invoice": F.col("invoice_number").isNotNull(),
        "missing_stock_code": F.col("stock_code").isNotNull() & (F.col("stock_code") != ""),
        "missing_timestamp": F.col("invoice_timestamp").isNotNull(),
        "missing_quantity": quantity.isNotNull(),
        "zero_quantity": quantity.isNull() | (quantity != 0),
        "quantity_out_of_bounds": quantity.isNull() | quantity.between(*bounds),
        "missing_price": price.isNotNull(),
        "negative_price": price.isNull() | (price >= 0),
    }


def clean_transactions(
    bronze: DataFrame, null_tokens: Sequence[str] = NULL_TOKENS, bounds: tuple[int, int] = QUANTITY_BOUNDS
) -> DataFrame:
    """The silver line items: the lines that meet every rule of `line_rules`.

    A comparison with NULL is not true, so each NULL test folds into its range test.
    """
    quantity = F.col("quantity")
    return typed_lines(bronze, null_tokens).where(
        F.col("invoice_number").isNotNull()
        & (F.col("stock_code") != "")
        & F.col("invoice_timestamp").isNotNull()
        & quantity.between(*bounds)
        & (quantity != 0)
        & (F.col("unit_price") >= 0)
    )


def rejected_transactions(
    bronze: DataFrame, null_tokens: Sequence[str] = NULL_TOKENS, bounds: tuple[int, int] = QUANTITY_BOUNDS
) -> DataFrame:
    """The refused lines, each with every reason that applies."""
    rules = line_rules(bounds)
    reasons = F.array_compact(F.array(*[F.when(~met, F.lit(name)) for name, met in rules.items()]))
    typed = typed_lines(bronze, null_tokens).where(~reduce(Column.__and__, rules.values()))
    return typed.withColumn("reject_reasons", reasons)


def retail_transactions(silver: DataFrame, *, stage: Callable[[DataFrame], DataFrame], **numbering) -> DataFrame:
    """The silver table form: invoice line numbers and generated columns.

    Lines of an invoice are numbered as they stand in their files, load by load; where the
    lines have no place (a source that is not a file), by bronze_id.
    """
    order = [c for c in LINE_ORDER if c in silver.columns]
    if "source_row" not in order:
        order = ["bronze_id"]
    narrow = silver.select(
        "bronze_id",
        F.col("invoice_number").alias("invoice"),
        "stock_code",
        F.col("product_description").alias("description"),
        "quantity",
        "invoice_timestamp",
        "unit_price",
        "customer_id",
        "country",
        "line_total",
        "is_return",
        "is_cancelled",
        "has_customer_id",
        F.col("has_product_description").alias("has_valid_description"),
        *[c for c in order if c != "bronze_id"],
    )
    return number_rows(narrow, ["invoice"], order, "invoice_line_number", stage=stage, **numbering)


def transactions_table(silver: DataFrame, updated_at: datetime, *, stage: Callable[[DataFrame], DataFrame], **numbering) -> DataFrame:
    """`retail_transactions` with its key, source batch and audit columns, as the silver table is stored.

    loaded_at is the load that brought the line, updated_at the run that numbered it. All
    lines are current: one that came again has replaced the old one.
    """
    numbered = retail_transactions(silver, stage=stage, **numbering)
    return numbered.select(
        surrogate_key("bronze_id").alias("transaction_id"),
        *[c for c in numbered.columns if c not in LINE_ORDER],
        "bronze_id",
        F.col("load_batch_id").alias("source_batch_id"),
        F.col("load_timestamp").alias("loaded_at"),
        F.lit(updated_at).cast("timestamp").alias("updated_at"),
        F.lit(True).alias("is_current"),
    )
