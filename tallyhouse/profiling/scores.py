"""Dataset overview, quality scores, issues, recommendations and metric rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import row_fingerprint
from .columns import UNFIT, aggregate, profiled_columns

# Columns that may hold at most 5 % NULLs.
CRITICAL_COLUMNS = ("invoice", "stock_code", "quantity", "unit_price", "country")
CRITICAL_NULL_PERCENT = 5


def merge_rows(*frames: DataFrame) -> DataFrame:
    """One-row frames with different columns side by side, without a join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


OVERVIEW_AGGREGATES = {
    "total_records": "count(*)",
    "min_date": "min(invoice_date)",
    "max_date": "max(invoice_date)",
    "latest_load": "max(load_timestamp)",
    "oldest_load": "min(load_timestamp)",
}

DISTINCT_NAMES = {
    "unique_invoices": "invoice",
    "unique_products": "stock_code",
    "unique_customers": "customer_id",
    "unique_countries": "country",
}


def distinct_row(profiles: DataFrame, names: dict[str, str]) -> DataFrame:
    """Distinct counts of some profiled columns as one row."""
    return profiles.selectExpr(
        *[f"max(case when column_name = '{c}' then unique_count end) as {name}" for name, c in names.items()]
    )


def overview_row(totals: DataFrame, profiles: DataFrame, n_columns: int) -> DataFrame:
    """Size, date span, distinct keys and load freshness, one row."""
    figures = totals.selectExpr(
        "total_records",
        f"{n_columns} as total_columns",
        "min_date",
        "max_date",
        "floor(timestampdiff(SECOND, min_date, max_date) / 86400) as date_span_days",
        "latest_load",
        "oldest_load",
    )
    return merge_rows(figures, distinct_row(profiles, DISTINCT_NAMES))


def overview(df: DataFrame, profiles: DataFrame) -> DataFrame:
    return overview_row(aggregate(df, OVERVIEW_AGGREGATES), profiles, len(profiled_columns(df.columns)))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Second and later copies of exactly equal rows, as one number."""
    prints = df.select(*row_fingerprint(columns or df.columns))
    groups = prints.groupBy(*prints.columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_records"))


def _missing(column: str, columns: Sequence[str]) -> str:
    unfit = column + UNFIT
    return f"{column} is null and {unfit} is null" if unfit in columns else f"{column} is null"


def quality_aggregates(columns: Sequence[str]) -> dict[str, str]:
    return {
        "total_records": "count(*)",
        "negative_prices": "count_if(unit_price < 0)",
        "zero_quantities": "count_if(quantity = 0)",
        **{f"null_{c}": f"count_if({_missing(c, columns)})" for c in profiled_columns(columns)},
    }


def quality_counts(df: DataFrame) -> DataFrame:
    """The counts that the scores, issues and recommendations are made of, one row."""
    return merge_rows(aggregate(df, quality_aggregates(df.columns)), duplicate_rows(df))


def _null_columns(counts: DataFrame) -> list[str]:
    return [c[len("null_") :] for c in counts.columns if c.startswith("null_")]


def _rows_that_fire(rules: Sequence[tuple[str, Sequence[str]]], names: Sequence[str]) -> str:
    """SQL array of the rules whose test is true, as structs with the given field names."""
    rows = []
    for test, values in rules:
        fields = ", ".join(f"{value} as {name}" for name, value in zip(names, values))
        rows.append(f"case when {test} then struct({fields}) end")
    return f"array_compact(array({', '.join(rows)}))"


def _issues() -> str:
    rules = []
    for c in CRITICAL_COLUMNS:
        percent = f"null_{c} / total_records * 100"
        text = f"format_string('High null percentage in critical column: %.1f%%', {percent})"
        rules.append((f"{percent} > {CRITICAL_NULL_PERCENT}", ("'completeness'", "'critical'", f"'{c}'", text)))
    for count, kind, severity, column, what in (
        ("negative_prices", "validity", "high", "'unit_price'", "records with negative prices"),
        ("zero_quantities", "validity", "medium", "'quantity'", "records with zero quantity"),
        ("duplicate_records", "consistency", "medium", "cast(null as string)", "duplicate records"),
    ):
        rules.append((f"{count} > 0", (f"'{kind}'", f"'{severity}'", column, f"format_string('Found %d {what}', {count})")))
    return _rows_that_fire(rules, ("type", "severity", "column_name", "description"))


def quality_issues(counts: DataFrame) -> DataFrame:
    return counts.where("total_records > 0").selectExpr(f"inline({_issues()})")


def quality_scores(counts: DataFrame) -> DataFrame:
    """Completeness, validity, consistency and their mean, with issue counts by severity."""
    columns = _null_columns(counts)
    null_cells = " + ".join(f"null_{c}" for c in columns)
    cells, checks = f"(total_records * {len(columns)})", "(total_records * 2)"
    scored = counts.where("total_records > 0").selectExpr(
        "total_records",
        f"({cells} - ({null_cells})) / {cells} * 100 as completeness_score",
        f"({checks} - negative_prices - zero_quantities) / {checks} * 100 as validity_score",
        "case when duplicate_records > 0 then 90.0D else 100.0D end as consistency_score",
        f"{_issues()} as issues",
    )
    levels = [
        f"cast(size(filter(issues, i -> i.severity = '{level}')) as bigint) as {level}_issues"
        for level in ("critical", "high", "medium", "low")
    ]
    return scored.selectExpr(
        "total_records",
        "(completeness_score + validity_score + consistency_score) / 3 as overall_score",
        "completeness_score",
        "validity_score",
        "consistency_score",
        *levels,
    )


def recommendations(counts: DataFrame) -> DataFrame:
    """Advice rows for the rules that fire."""
    high_nulls = ", ".join(
        f"case when null_{c} / total_records * 100 > 10 then '{c}' end" for c in _null_columns(counts)
    )
    names, missing = f"concat_ws(', ', {high_nulls})", "null_customer_id / total_records * 100"
    # Rule texts and limits.
    rules = [
        (
            f"{names} <> ''",
            ("'Data Quality'", "'High'", f"concat('High null rates in columns: ', {names})",
             "'Investigate data sources and implement validation at ingestion point'"),
        ),
        (
            "negative_prices > 0",
            ("'Business Rules'", "'Critical'", "'Negative unit prices detected'",
             "'Implement price validation constraints and investigate source system'"),
        ),
        (
            "zero_quantities > 0",
            ("'Data Validation'", "'Medium'", "'Zero quantity transactions found'",
             "'Clarify business rules for zero-quantity transactions or filter them out'"),
        ),
        (
            f"{missing} > 20",
            ("'Customer Analytics'", "'Medium'", f"format_string('%.1f%% of transactions lack customer IDs', {missing})",
             "'Improve customer identification processes for better analytics'"),
        ),
        (
            "total_records > 500000",
            ("'Performance'", "'Medium'", "'Large dataset detected'",
             "'Consider implementing data partitioning and archiving strategies'"),
        ),
    ]
    fired = _rows_that_fire(rules, ("category", "priority", "issue", "recommendation"))
    return counts.where("total_records > 0").selectExpr(f"inline({fired})")


def metric_rows(scores: DataFrame, latest_load: DataFrame, table: str) -> DataFrame:
    """Eight metric rows tagged with the newest successful load (one-row `latest_load`)."""
    sources = {
        "total_records": "total_records",
        "overall_quality_score": "overall_score",
        "completeness_score": "completeness_score",
        "validity_score": "validity_score",
        "consistency_score": "consistency_score",
        "critical_issues": "critical_issues",
        "high_issues": "high_issues",
        "medium_issues": "medium_issues",
    }
    figures = scores.select(*[F.col(c).cast("double").alias(name) for name, c in sources.items()])
    tagged = merge_rows(figures, latest_load.select(F.col("batch_id").alias("load_id")))
    return (
        tagged.where(F.col("load_id").isNotNull())
        .unpivot(["load_id"], list(sources), "metric_name", "metric_value")
        .select(
            "load_id",
            F.lit(table).alias("table_name"),
            "metric_name",
            "metric_value",
            F.lit("Data profiling metric from automated assessment").alias("metric_description"),
        )
    )
