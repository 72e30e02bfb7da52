"""The column tests of the layer tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from ..schemas import (
    BATCH_STATES,
    FREQUENCY_BANDS,
    FREQUENCY_OTHER,
    QUANTITY_BOUNDS,
    RECENCY_BANDS,
    RECENCY_OTHER,
    VALUE_BANDS,
    VALUE_OTHER,
)
from .checks import (
    RowCheck,
    accepted_range,
    accepted_values,
    failing_by_test,
    not_null,
    repeated_rows,
    row_check_results,
    unique_result,
)


def _labels(bands, other) -> list[str]:
    return [label for _, label in bands] + [other]


# Columns that must be unique, and not NULL, per table.
UNIQUE_COLUMNS = {
    "online_retail_raw": ("bronze_id",),
    "ingestion_log": ("batch_id",),
    "stg_bronze__online_retail": ("bronze_id",),
    "dim_customer": ("customer_key", "customer_id"),
}

REQUIRED_COLUMNS = {
    "online_retail_raw": (
        "bronze_id", "invoice", "stock_code", "invoice_date", "country",
        "source_file_name", "load_timestamp", "load_batch_id",
    ),
    "ingestion_log": ("batch_id",),
    "stg_bronze__online_retail": (
        "bronze_id", "invoice_number", "stock_code", "quantity", "unit_price",
        "invoice_timestamp", "invoice_date", "country", "line_total",
    ),
    "dim_customer": ("customer_key", "customer_id", "total_lifetime_value"),
}


def value_checks(table: str) -> list[RowCheck]:
    return {
        "ingestion_log": [accepted_values("status", BATCH_STATES)],
        "stg_bronze__online_retail": [
            accepted_range("quantity", *QUANTITY_BOUNDS),
            accepted_range("unit_price", 0, 50000),
        ],
        "dim_customer": [
            accepted_range("total_lifetime_value", 0),
            accepted_values("frequency_segment", _labels(FREQUENCY_BANDS, FREQUENCY_OTHER)),
            accepted_values("value_segment", _labels(VALUE_BANDS, VALUE_OTHER)),
            accepted_values("recency_segment", _labels(RECENCY_BANDS, RECENCY_OTHER)),
        ],
    }.get(table, [])


def row_checks(table: str) -> list[RowCheck]:
    return [not_null(c) for c in REQUIRED_COLUMNS.get(table, ())] + value_checks(table)


def row_suite(df: DataFrame, table: str) -> DataFrame:
    """All row tests of a table in one pass."""
    return row_check_results(df, table, row_checks(table))


def failing_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of every failed test of the given tables; see `failing_by_test`."""
    parts = [failing_by_test(df, t, row_checks(t)) for t, df in tables.items()]
    parts += [repeated_rows(df, t, c) for t, df in tables.items() for c in UNIQUE_COLUMNS[t]]
    return reduce(DataFrame.unionByName, parts)


def unique_suite(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [unique_result(df, t, c) for t, df in tables.items() for c in UNIQUE_COLUMNS[t]]
    return reduce(DataFrame.unionByName, parts)


def run_suite(tables: dict[str, DataFrame]) -> DataFrame:
    """Result rows of every test of the given tables."""
    rows = reduce(DataFrame.unionByName, [row_suite(df, t) for t, df in tables.items()])
    return rows.unionByName(unique_suite(tables))
