"""Calendar: date rows and the date dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import day_of_week, iso_week


def date_spine(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day from `start` up to, not including, `end`."""
    return _days(spark.range(1), F.lit(str(start)).cast("date"), F.lit(str(end)).cast("date"))


def spanning_spine(lines: DataFrame, column: str = "invoice_date") -> DataFrame:
    """Every day of the calendar years that `column` touches."""
    span = lines.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    start = F.trunc("first", "YEAR")
    return _days(span.where(F.col("first").isNotNull()), start, F.add_months(F.trunc("last", "YEAR"), 12))


def _days(one_row: DataFrame, start: Column, end: Column) -> DataFrame:
    days = F.sequence(start, F.date_sub(end, 1), F.expr("interval 1 day"))
    return one_row.select(F.explode(F.when(start < end, days)).alias("full_date"))


def build_dim_date(days: DataFrame, as_of: date) -> DataFrame:
    """Date dimension over the rows of a spine; fiscal periods equal calendar periods."""
    day = F.col("full_date")
    year, month, quarter = F.year(day), F.month(day), F.quarter(day)
    return days.select(
        "full_date",
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        year.alias("year_number"),
        month.alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "MMM").alias("month_abbr"),
        F.dayofmonth(day).alias("day_of_month"),
        F.dayofyear(day).alias("day_of_year"),
        day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_of_week_name"),
        F.weekofyear(day).alias("week_of_year"),
        quarter.alias("quarter_number"),
        F.concat(F.lit("Q"), quarter.cast("string")).alias("quarter_name"),
        iso_week(day).alias("iso_week"),
        day_of_week(day).isin(0, 6).alias("is_weekend"),
        (day == F.lit(as_of)).alias("is_current_day"),
        year.alias("fiscal_year"),
        quarter.alias("fiscal_quarter"),
        month.alias("fiscal_month"),
    )


def with_date_flags(dim_date: DataFrame, as_of: date, holidays: DataFrame | None = None) -> DataFrame:
    """Holiday and current-period flags. `holidays` holds (full_date, holiday_name)."""
    day, today = F.col("full_date"), F.lit(as_of)

    def same(unit: str) -> Column:
        return F.trunc(day, unit) == F.trunc(today, unit)

    flagged = dim_date.select(
        "*",
        same("MM").alias("is_current_month"),
        same("QUARTER").alias("is_current_quarter"),
        same("YEAR").alias("is_current_year"),
    )
    if holidays is None:
        named = flagged.withColumn("holiday_name", F.lit(None).cast("string"))
    else:
        named = flagged.join(holidays.select("full_date", "holiday_name"), "full_date", "left")
    return named.withColumn("is_holiday", F.col("holiday_name").isNotNull())
