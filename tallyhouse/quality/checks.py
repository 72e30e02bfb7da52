"""Data tests: failing rows, one-pass result rows, freshness and table contracts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import broadcast_if_small

RESULT_COLUMNS = (
    "check_type",
    "table_name",
    "column_name",
    "check_passed",
    "records_checked",
    "records_failed",
    "failure_percentage",
)


@dataclass(frozen=True)
class RowCheck:
    """A rule each row meets on its own; `ok` is true for rows that pass."""

    check_type: str
    column: str
    ok: Column

    @property
    def failed(self) -> Column:
        return ~F.coalesce(self.ok, F.lit(False))


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, F.col(column).isNotNull())


def accepted_values(column: str, values: Sequence) -> RowCheck:
    """NULL passes: it is not_null's business."""
    c = F.col(column)
    return RowCheck("accepted_values", column, c.isNull() | c.isin(*values))


def accepted_range(column: str, low=None, high=None, *, inclusive: bool = True) -> RowCheck:
    c = F.col(column)
    ok = F.lit(True)
    if low is not None:
        ok = ok & ((c >= low) if inclusive else (c > low))
    if high is not None:
        ok = ok & ((c <= high) if inclusive else (c < high))
    return RowCheck("accepted_range", column, c.isNull() | ok)


def expression_is_true(name: str, expression: Column | str) -> RowCheck:
    return RowCheck("expression_is_true", name, F.expr(expression) if isinstance(expression, str) else expression)


def failing_rows(df: DataFrame, check: RowCheck) -> DataFrame:
    """The rows a check refuses; the test passes when there are none."""
    return df.where(check.failed)


def failing_by_test(df: DataFrame, table: str, checks: Sequence[RowCheck]) -> DataFrame:
    """(table_name, test_name, row): every row that fails a test, once for each such test, from one scan.

    The row is JSON, so that rows of all tables and tests fit one table.
    """
    failed = F.array_compact(F.array(*[F.when(c.failed, F.lit(f"{c.check_type}_{c.column}")) for c in checks]))
    bad = df.where(reduce(Column.__or__, [c.failed for c in checks], F.lit(False)))
    return bad.select(F.lit(table).alias("table_name"), F.explode(failed).alias("test_name"), _as_json(df))


def repeated_rows(df: DataFrame, table: str, column: str) -> DataFrame:
    """The same for the `unique` test: all rows that share their value with another."""
    shared = broadcast_if_small(repeated_keys(df, column).select(F.col(column).alias("_shared")))
    rows = df.join(shared, F.col(column) == F.col("_shared"), "left_semi")
    return rows.select(F.lit(table).alias("table_name"), F.lit(f"unique_{column}").alias("test_name"), _as_json(df))


def _as_json(df: DataFrame) -> Column:
    return F.to_json(F.struct(*df.columns)).alias("row")


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once (the `unique` test)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def missing_parents(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent row, with their row counts (the `relationships` test).

    Child rows are counted per value before the join, so a hot value is one row by then.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    known = parent.select(F.col(parent_column).alias(column))
    return used.join(known, column, "left_anti")


def row_check_results(df: DataFrame, table: str, checks: Sequence[RowCheck]) -> DataFrame:
    """Result rows of all row checks of a table from one aggregation over it."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(c.failed).alias(f"_failed_{i}") for i, c in enumerate(checks)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(c.check_type).alias("check_type"),
                F.lit(c.column).alias("column_name"),
                F.col(f"_failed_{i}").alias("records_failed"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return _results(counts.select("_rows", F.inline(entries)), table)


def unique_result(df: DataFrame, table: str, column: str) -> DataFrame:
    """Result row of a `unique` test: failed records are the rows that share their value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    shared = F.col(column).isNotNull() & (F.col("n") > 1)
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum(F.when(shared, F.col("n"))), F.lit(0)).alias("records_failed"),
    )
    return _results(
        totals.select("*", F.lit("unique").alias("check_type"), F.lit(column).alias("column_name")), table
    )


def at_least_one_result(df: DataFrame, table: str, column: str) -> DataFrame:
    """Passes when the column has any value; an empty table fails."""
    totals = df.agg(F.count(F.lit(1)).alias("_rows"), F.count(column).alias("_present"))
    return _results(
        totals.select(
            "_rows",
            "_present",
            F.lit("at_least_one").alias("check_type"),
            F.lit(column).alias("column_name"),
            F.when(F.col("_present") > 0, 0).otherwise(F.col("_rows")).cast("bigint").alias("records_failed"),
        ),
        table,
        passed=F.col("_present") > 0,
    )


def relationship_result(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    rows = child.agg(F.count(column).alias("_rows"))
    lost = missing_parents(child, column, parent, parent_column).agg(
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("records_failed")
    )
    both = rows.select("_rows", F.lit(0).cast("bigint").alias("records_failed")).unionByName(
        lost.select(F.lit(0).cast("bigint").alias("_rows"), "records_failed")
    )
    totals = both.agg(F.sum("_rows").alias("_rows"), F.sum("records_failed").alias("records_failed"))
    return _results(
        totals.select("*", F.lit("relationships").alias("check_type"), F.lit(column).alias("column_name")), table
    )


def _results(rows: DataFrame, table: str, passed: Column | None = None) -> DataFrame:
    failed, checked = F.col("records_failed"), F.col("_rows")
    return rows.select(
        "check_type",
        F.lit(table).alias("table_name"),
        "column_name",
        (passed if passed is not None else failed == 0).alias("check_passed"),
        checked.alias("records_checked"),
        failed.alias("records_failed"),
        F.when(checked > 0, failed * 100.0 / checked).otherwise(0.0).cast("double").alias("failure_percentage"),
    )


def lines_reach(source: DataFrame, target: DataFrame, table: str) -> DataFrame:
    """One result row: source lines (bronze_id) that no row of the target (source_bronze_id) stands for."""
    held = target.select(F.col("source_bronze_id").alias("held")).distinct()
    lost = source.join(held, F.col("bronze_id") == F.col("held"), "left").agg(
        F.count_if(F.col("held").isNull()).alias("records_failed"), F.count(F.lit(1)).alias("_rows")
    )
    return _results(lost.withColumn("check_type", F.lit("lines_reach")).withColumn("column_name", F.lit("source_bronze_id")), table)


def check_log(results: DataFrame, batch_id: str, checked_at: datetime) -> DataFrame:
    """Result rows in the form of the data_quality_checks table."""
    return results.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(checked_at).cast("timestamp").alias("check_timestamp"),
        *RESULT_COLUMNS[:-1],
        F.round("failure_percentage", 2).cast("decimal(5,2)").alias("failure_percentage"),
    )


def freshness(df: DataFrame, table: str, column: str, as_of: datetime, warn_days: int, error_days: int) -> DataFrame:
    """One row: newest load time, its age in days, and pass, warn or error."""
    newest = df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("max_loaded_at"))
    seconds = F.timestamp_diff("SECOND", F.col("max_loaded_at"), F.lit(as_of).cast("timestamp_ntz"))
    aged = newest.select("max_loaded_at", seconds.alias("age_seconds"))
    age = F.col("age_seconds")
    status = (
        F.when(age.isNull() | (age > error_days * 86400), "error").when(age > warn_days * 86400, "warn").otherwise("pass")
    )
    return aged.select(F.lit(table).alias("table_name"), "max_loaded_at", "age_seconds", status.alias("status"))


def enforce_contract(
    df: DataFrame, required: Sequence[str] = (), checks: dict[str, Column] | None = None, defaults: dict | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split rows into accepted and rejected by a table's NOT NULL and CHECK rules.

    Defaults fill NULLs first. As in SQL, a CHECK that comes out NULL is not violated.
    Rejected rows name every broken rule.
    """
    if defaults:
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})
    broken = {f"{c} is null": F.col(c).isNull() for c in required}
    broken |= {name: F.coalesce(~rule, F.lit(False)) for name, rule in (checks or {}).items()}
    any_broken = reduce(Column.__or__, broken.values(), F.lit(False))
    reasons = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in broken.items()]))
    return df.where(~any_broken), df.where(any_broken).withColumn("broken_rules", reasons)


# CHECK rules of the silver line table.
def silver_contract() -> dict[str, Column]:
    return {
        "chk_quantity_not_zero": F.col("quantity") != 0,
        "chk_unit_price_not_negative": F.col("unit_price") >= 0,
        "chk_invoice_not_empty": F.length("invoice_number") > 0,
        "chk_stock_code_not_empty": F.length("stock_code") > 0,
        "chk_country_not_empty": F.length("country") > 0,
    }


SILVER_REQUIRED = ("invoice_number", "stock_code", "quantity", "invoice_timestamp", "unit_price", "country")
