"""Column profiles. Distinct values are counted once; every distinct-based figure reads
those counts, and everything else comes from one plain aggregation."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import as_double, null_if_token
from ..operators.running import exact_quantiles, number_rows, running_total
from ..schemas import SOURCE_COLUMNS

Stage = Callable[[DataFrame], DataFrame]

MISSING_TOKENS = ("nan", "None", "NaN")  # an empty text is a value here, and is counted
AUDIT_COLUMNS = ("load_timestamp", "source_file_name")
NUMERIC_COLUMNS = ("quantity", "unit_price")
TEXT_COLUMNS = ("invoice", "stock_code", "description", "customer_id", "country")
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}

# Numbers are exact decimals: twelve digits before the point and six behind it.
NUMBER = "decimal(18,6)"
# Beside each numeric column: the text of values that are there and are no such number.
UNFIT = "_unfit"

# Text shapes the text profile counts.
BLANK_TEXT = r"(?U)^\s*\z"
PADDED_TEXT = r"(?U)(^\s)|(\s\z)"
SPECIAL_TEXT = r"(?U)[^\w\s-]"


def exact_number(text: Column) -> Column:
    """A text as a decimal that loses nothing of it (to double precision), else NULL."""
    number = text.try_cast(NUMBER)
    return F.when(number.cast("double") == text.try_cast("double"), number)


def profile_lines(bronze: DataFrame) -> DataFrame:
    """Bronze lines as the profiler sees them: text as loaded, numbers and times typed.

    A number is kept exactly or not at all: what is out of range, has more digits behind the
    point, or is no number at all stands as text in the column's `_unfit` twin. It is not
    missing, and has a count of its own in the numeric profile.
    """
    text = {c: null_if_token(c, MISSING_TOKENS).alias(c) for c in SOURCE_COLUMNS}
    unfit = []
    for c in NUMERIC_COLUMNS:
        number = exact_number(text[c])
        unfit.append(F.when(number.isNull(), text[c]).alias(c + UNFIT))
        text[c] = number.alias(c)
    text["invoice_date"] = F.col("invoice_date").try_cast("timestamp_ntz").alias("invoice_date")
    return bronze.select(*text.values(), *AUDIT_COLUMNS, *unfit)


def profiled_columns(names: Sequence[str]) -> list[str]:
    return [c for c in names if not c.endswith(UNFIT)]


def recent_rows(df: DataFrame, n: int, *, stage: Stage, time: str = "load_timestamp", tie: str = "bronze_id") -> DataFrame:
    """The n newest rows by load time, ties in order of a unique column.

    Load times newer than the boundary are taken whole; only the rows of the boundary load
    are numbered, so no task ever gathers n rows from every partition.
    """
    age = -F.unix_micros(F.col(time).cast("timestamp"))
    loads = df.groupBy(age.alias("_age")).agg(F.count(F.lit(1)).alias("n")).withColumn("_all", F.lit(0))
    reached = running_total(loads, ["_all"], ["_age"], F.col("n"), "_upto", stage=stage)
    edge = reached.where(F.col("_upto") >= n).agg(F.min(F.struct("_age", "_upto", "n")).alias("b")).first()["b"]
    if edge is None:
        return df
    aged = df.withColumn("_age", age)
    tied = number_rows(aged.where(F.col("_age") == edge["_age"]), ["_age"], [tie], "_rank", stage=stage)
    kept = tied.where(F.col("_rank") <= n - (edge["_upto"] - edge["n"])).drop("_rank")
    return aged.where(F.col("_age") < edge["_age"]).unionByName(kept).drop("_age")


def value_counts(df: DataFrame, columns: Sequence[str] = SOURCE_COLUMNS) -> DataFrame:
    """(column_name, value, n) of every distinct value, NULL included, in one shuffle."""
    value = lambda c: F.coalesce(F.col(c).cast("string"), c + UNFIT) if c + UNFIT in df.columns else F.col(c).cast("string")
    texts = df.select(*[value(c).alias(c) for c in columns])
    return texts.unpivot([], list(columns), "column_name", "value").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def column_profiles(df: DataFrame, counts: DataFrame) -> DataFrame:
    """Null and distinct counts and the type of each counted column."""
    types = dict(df.dtypes)
    missing = F.col("value").isNull()
    summed = counts.groupBy("column_name").agg(
        F.sum("n").alias("rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_count"),
        F.count("value").alias("unique_count"),
    )
    type_of = F.create_map(*[F.lit(x) for pair in types.items() for x in pair])
    return summed.select(
        "column_name",
        F.element_at(type_of, F.col("column_name")).alias("data_type"),
        (F.col("rows") - F.col("null_count")).alias("non_null_count"),
        "null_count",
        (F.col("null_count") / F.col("rows") * 100).alias("null_percentage"),
        "unique_count",
        (F.col("unique_count") / F.col("rows") * 100).alias("unique_percentage"),
    )


def top_values(counts: DataFrame, k: int = 10, columns: Sequence[str] | None = None) -> DataFrame:
    """The k most frequent values of each column, ties by value."""
    present = counts.where(F.col("value").isNotNull())
    if columns is not None:
        present = present.where(F.col("column_name").isin(*columns))
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), F.col("value"))
    return present.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def frequency(counts: DataFrame, column: str) -> DataFrame:
    """(value, n) of one column out of `value_counts`, the NULL row included."""
    return counts.where(F.col("column_name") == column).select("value", "n")


def quartiles(
    counts: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, *, stage: Stage
) -> dict[str, dict[str, float]]:
    """Column -> its quartiles: at most one row per profiled column is fetched."""
    fits = ~F.col("column_name").isin(*NUMERIC_COLUMNS) | exact_number(F.col("value")).isNotNull()
    chosen = counts.where(F.col("column_name").isin(*columns) & F.col("value").isNotNull() & fits)
    values = chosen.select("column_name", F.col("value").cast("double").alias("value"), "n")
    rows = exact_quantiles(values, QUARTILES, stage=stage).collect()
    return {row["column_name"]: row.asDict() for row in rows}


def numeric_aggregates(
    quarters: dict[str, dict[str, float]], columns: Sequence[str] = NUMERIC_COLUMNS
) -> dict[str, str]:
    """Name -> SQL aggregate of every numeric measure, named column__measure.

    The quartiles are known by now, so the outlier fences are literals. Outliers are only
    reported for a column with more than one distinct value; their percentage is over all
    rows.
    """
    found = {}
    for c in columns:
        known = quarters.get(c)
        quarter = {q: f"{known[q]!r}D" if known else "cast(null as double)" for q in QUARTILES}
        reach = f"1.5D * ({quarter['q3']} - {quarter['q1']})"
        outside = f"cast({c} as double) < {quarter['q1']} - {reach} or cast({c} as double) > {quarter['q3']} + {reach}"
        outliers = f"case when min({c}) < max({c}) then count_if({outside}) end"
        measures = {
            "min_value": f"cast(min({c}) as double)",
            "max_value": f"cast(max({c}) as double)",
            "mean": f"try_divide(cast(sum({c}) as double), count({c}))",
            "median": f"max({quarter['median']})",
            "std_dev": f"stddev_samp(cast({c} as double))",
            "q1": f"max({quarter['q1']})",
            "q3": f"max({quarter['q3']})",
            "zero_count": f"count_if({c} = 0)",
            "negative_count": f"count_if({c} < 0)",
            "positive_count": f"count_if({c} > 0)",
            "outlier_count": outliers,
            "outlier_percentage": f"try_divide({outliers}, count(*)) * 100",
            "unfit_count": f"count({c}{UNFIT})",
        }
        found |= {f"{c}__{name}": sql for name, sql in measures.items()}
    return found


NUMERIC_MEASURES = (
    "min_value", "max_value", "mean", "median", "std_dev", "q1", "q3",
    "zero_count", "negative_count", "positive_count", "outlier_count", "outlier_percentage",
    "unfit_count",
)


def aggregate(df: DataFrame, aggregates: dict[str, str]) -> DataFrame:
    """One row of named SQL aggregates, from one pass."""
    return df.selectExpr(*[f"{sql} as {name}" for name, sql in aggregates.items()])


def numeric_rows(totals: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS) -> DataFrame:
    """The row of `numeric_aggregates` as one row per column."""
    values = ", ".join(f"'{c}', " + ", ".join(f"{c}__{m}" for m in NUMERIC_MEASURES) for c in columns)
    return totals.selectExpr(f"stack({len(columns)}, {values}) as (column_name, {', '.join(NUMERIC_MEASURES)})")


def numeric_profiles(
    df: DataFrame, quarters: dict[str, dict[str, float]], columns: Sequence[str] = NUMERIC_COLUMNS
) -> DataFrame:
    """Range, moments, quartiles, sign counts and IQR outliers of numeric columns."""
    return numeric_rows(aggregate(df, numeric_aggregates(quarters, columns)), columns)


def text_profiles(counts: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """Lengths and suspicious shapes of text columns; NULL counts for none of them.

    Each distinct value is examined once and weighted with its rows.
    """
    text, n = F.col("value"), F.col("n")

    def rows(test: Column) -> Column:
        return F.coalesce(F.sum(F.when(test, n)), F.lit(0))

    present = counts.where(F.col("column_name").isin(*columns) & text.isNotNull())
    return present.groupBy("column_name").agg(
        (as_double(F.sum(F.length(text) * n)) / F.sum(n)).alias("avg_length"),
        F.min(F.length(text)).alias("min_length"),
        F.max(F.length(text)).alias("max_length"),
        rows(text == "").alias("empty_string_count"),
        rows(text.rlike(BLANK_TEXT)).alias("whitespace_only_count"),
        rows(text.rlike(PADDED_TEXT)).alias("has_leading_trailing_spaces"),
        rows(text.rlike(SPECIAL_TEXT)).alias("has_special_characters"),
    )


def hourly_counts(df: DataFrame, column: str = "invoice_date") -> DataFrame:
    """Rows per day and hour; NULL times form one group. Bounded by the calendar."""
    at = F.col(column)
    return df.groupBy(F.to_date(at).alias("day"), F.hour(at).alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.min(at).alias("first_at"), F.max(at).alias("last_at")
    )


def datetime_profile(hourly: DataFrame, column: str = "invoice_date") -> DataFrame:
    """Span, distinct date parts, weekend and business-hour rows, from `hourly_counts`."""
    day = F.col("day")
    weekend, business = F.dayofweek(day).isin(1, 7), F.col("hour").between(9, 17)
    span = F.floor(F.timestamp_diff("SECOND", F.col("min_date"), F.col("max_date")) / 86400)
    summed = hourly.agg(
        F.min("first_at").alias("min_date"),
        F.max("last_at").alias("max_date"),
        F.countDistinct(F.year(day)).alias("unique_years"),
        F.countDistinct(F.month(day)).alias("unique_months"),
        F.countDistinct(F.dayofmonth(day)).alias("unique_days"),
        F.countDistinct("hour").alias("unique_hours"),
        F.coalesce(F.sum(F.when(weekend, F.col("n"))), F.lit(0)).alias("weekend_transactions"),
        F.coalesce(F.sum(F.when(business, F.col("n"))), F.lit(0)).alias("business_hours_transactions"),
    )
    return summed.select(
        F.lit(column).alias("column_name"),
        "min_date",
        "max_date",
        span.cast("bigint").alias("date_range_days"),
        *summed.columns[2:],
    )


def summary_stats(df: DataFrame, counts: DataFrame, numeric: DataFrame) -> DataFrame:
    """Count, distinct, most frequent value and numeric statistics of every column."""
    profiles = column_profiles(df, counts)
    top = top_values(counts, 1).select("column_name", F.col("value").alias("top"), F.col("n").alias("freq"))
    stats = numeric.select("column_name", "mean", "std_dev", "min_value", "q1", "median", "q3", "max_value")
    return (
        profiles.select("column_name", "data_type", F.col("non_null_count").alias("count"), "unique_count")
        .join(top, "column_name", "left")
        .join(stats, "column_name", "left")
    )
