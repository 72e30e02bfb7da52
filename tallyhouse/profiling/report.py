"""The whole profile: every section, over intermediates that are computed once."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, functions as F

from ..schemas import SOURCE_COLUMNS
from . import columns, insights, scores

Stage = Callable[[DataFrame], DataFrame]


def profile_sections(lines: DataFrame, *, stage: Stage, home: str = insights.HOME_COUNTRY) -> dict[str, DataFrame]:
    """Section name -> its rows. `lines` is a frame of `profile_lines`.

    The lines are scanned for the distinct value counts, the hourly counts, the duplicate
    count, and once for all plain totals; these four are staged, and every section reads
    them only.
    """
    priced = insights.with_revenue(lines)
    # Three independent jobs: submitted together, they share the cluster.
    with ThreadPoolExecutor(3) as pool:
        counts, hours, copies = pool.map(
            stage,
            (
                columns.value_counts(priced, (*SOURCE_COLUMNS, "revenue")),
                columns.hourly_counts(lines),
                scores.duplicate_rows(lines),
            ),
        )
    quarters = columns.quartiles(counts, (*columns.NUMERIC_COLUMNS, "revenue"), stage=stage)
    middle = quarters.get("revenue", {}).get("median")
    revenue = insights.REVENUE_AGGREGATES | {
        "median_transaction_value": "cast(null as double)" if middle is None else f"max({middle!r}D)"
    }
    quality_names = scores.quality_aggregates(lines.columns)
    plain = scores.OVERVIEW_AGGREGATES | quality_names | columns.numeric_aggregates(quarters) | revenue
    totals = stage(columns.aggregate(priced, plain))
    quality = scores.merge_rows(totals.select(*quality_names), copies)
    profiles = columns.column_profiles(lines, counts.where("column_name <> 'revenue'"))
    return {
        "dataset_overview": scores.overview_row(totals, profiles, len(columns.profiled_columns(lines.columns))),
        "column_profiles": profiles,
        "numeric_profiles": columns.numeric_rows(totals),
        "text_profiles": columns.text_profiles(counts),
        "datetime_profiles": columns.datetime_profile(hours),
        "top_values": columns.top_values(counts, 10, columns.TEXT_COLUMNS),
        "data_quality": scores.quality_scores(quality),
        "quality_issues": scores.quality_issues(quality),
        "revenue_analysis": totals.select(*revenue),
        "customer_analysis": insights.customer_analysis(columns.frequency(counts, "customer_id")),
        "geographic_analysis": insights.geographic_analysis(columns.frequency(counts, "country"), home),
        "product_analysis": insights.product_analysis(columns.frequency(counts, "stock_code")),
        "temporal_analysis": insights.temporal_analysis(hours),
        "recommendations": scores.recommendations(quality),
    }


def tidy(sections: dict[str, DataFrame]) -> DataFrame:
    """All sections as (section, column_name, metric, value) text rows."""
    return _union([_tidy_section(name, df) for name, df in sections.items()])


def _union(frames: list[DataFrame]) -> DataFrame:
    """Union by halves: a chain would have Spark analyse the growing plan once per frame."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return _union(frames[:half]).unionByName(_union(frames[half:]))


# Sections that are rows already: (column_name, metric, value) expressions.
ROW_SECTIONS = {
    "top_values": ("column_name", "value", "n"),
    "geographic_analysis": ("section", "label", "n"),
    "product_analysis": ("section", "label", "n"),
    "temporal_analysis": ("section", "label", "n"),
    "quality_issues": ("column_name", "concat_ws('/', severity, type)", "description"),
    "recommendations": ("category", "priority", "concat_ws(': ', issue, recommendation)"),
}


def _tidy_section(name: str, df: DataFrame) -> DataFrame:
    section = f"'{name}' as section"
    if name in ROW_SECTIONS:
        column, metric, value = ROW_SECTIONS[name]
        return df.selectExpr(
            section, f"{column} as column_name", f"{metric} as metric", f"cast({value} as string) as value"
        )
    metrics = [c for c in df.columns if c != "column_name"]
    column = "column_name" if "column_name" in df.columns else "cast(null as string)"
    pairs = ", ".join(f"'{m}', cast({m} as string)" for m in metrics)
    return df.selectExpr(section, f"{column} as column_name", f"stack({len(metrics)}, {pairs}) as (metric, value)")


def as_json(sections: dict[str, DataFrame]) -> DataFrame:
    """The profile as one row per section with its rows as JSON texts.

    Every section is a report of a few rows by now; `top_values` is ten rows per column.
    """
    parts = [
        df.select(F.lit(name).alias("section"), F.to_json(F.struct(*df.columns)).alias("row"))
        for name, df in sections.items()
    ]
    return _union(parts)
