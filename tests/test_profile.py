"""Score formulas against published figures of the source data, and report shapes."""

from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.profiling import columns, exploration, insights, report, scores
from tallyhouse.quality import checks, pipeline_checks
from test_layers import star


def test_published_scores(spark):
    rows, columns_ = 536639, 10
    counts = spark.range(1).select(
        F.lit(rows).cast("bigint").alias("total_records"),
        F.lit(2).cast("bigint").alias("negative_prices"),
        F.lit(0).cast("bigint").alias("zero_quantities"),
        F.lit(0).cast("bigint").alias("duplicate_records"),
        *[
            F.lit({"description": 1454, "customer_id": 135037}.get(c, 0)).cast("bigint").alias(f"null_{c}")
            for c in (*columns.SOURCE_COLUMNS, "load_timestamp", "source_file_name")
        ],
    )
    found = scores.quality_scores(counts).first()
    assert abs(found.completeness_score - 97.45655831946615) < 1e-9
    assert abs(found.validity_score - 99.99981365498967) < 1e-9
    assert found.consistency_score == 100
    assert abs(found.overall_score - 99.15212399148527) < 1e-9
    assert [r.severity for r in scores.quality_issues(counts).collect()] == ["high"]
    advice = {(r.category, r.priority) for r in scores.recommendations(counts).collect()}
    assert advice == {
        ("Data Quality", "High"),
        ("Business Rules", "Critical"),
        ("Customer Analytics", "Medium"),
        ("Performance", "Medium"),
    }


def raw(spark):
    rows = [
        ("1", "A", " bag ", "2", "2011-01-01 10:00:00", "1.5", "7", "France"),
        ("1", "B", "", "4", "2011-01-01 10:00:00", "2.5", "7", "France"),
        ("2", "A", "nan", "-6", "2011-01-03 09:00:00", "3.5", "nan", "Spain"),
        ("3", "C!", "  ", "100", "nan", "-1", "8", "United Kingdom"),
        ("3", "C!", "  ", "100", "nan", "-1", "8", "United Kingdom"),
    ]
    names = ", ".join(f"{c} string" for c in columns.SOURCE_COLUMNS)
    df = spark.createDataFrame(rows, names)
    return columns.profile_lines(
        df.withColumn("load_timestamp", F.lit("2011-02-01").cast("timestamp")).withColumn("source_file_name", F.lit("f"))
    )


def test_text_and_time_profiles(spark):
    lines = raw(spark)
    counts = columns.value_counts(lines)
    text = {r.column_name: r for r in columns.text_profiles(counts).collect()}
    d = text["description"]
    assert (d.empty_string_count, d.whitespace_only_count, d.has_leading_trailing_spaces) == (1, 3, 3)
    assert text["stock_code"].has_special_characters == 2 and d.avg_length == (5 + 0 + 2 + 2) / 4
    when = columns.datetime_profile(columns.hourly_counts(lines)).first()
    assert (when.weekend_transactions, when.business_hours_transactions, when.date_range_days) == (2, 3, 1)
    profiles = {r.column_name: r for r in columns.column_profiles(lines, counts).collect()}
    assert (profiles["customer_id"].null_count, profiles["customer_id"].unique_count) == (1, 2)
    assert profiles["quantity"].data_type == "decimal(18,6)"


def test_numbers_are_exact_or_apart(spark, area):
    rows = [
        ("1", "A", "x", "3", "2011-01-01 10:00:00", "0.001", "7", "France"),
        ("2", "A", "x", "2", "2011-01-01 10:00:00", "12345678901.5", "7", "France"),
        ("3", "A", "x", "1", "2011-01-01 10:00:00", "10000000000000", "7", "France"),
        ("4", "A", "x", "1", "2011-01-01 10:00:00", "0.0000001", "7", "France"),
        ("5", "A", "x", "ten", "2011-01-01 10:00:00", "nan", "7", "France"),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns.SOURCE_COLUMNS))
    lines = columns.profile_lines(
        df.withColumn("load_timestamp", F.lit("2011-02-01").cast("timestamp")).withColumn("source_file_name", F.lit("f"))
    )
    counts = columns.value_counts(lines)
    profiles = {r.column_name: r for r in columns.column_profiles(lines, counts).collect()}
    assert (profiles["unit_price"].null_count, profiles["unit_price"].unique_count) == (1, 4)
    assert profiles["quantity"].null_count == 0
    quarters = columns.quartiles(counts, stage=area.stage)
    numeric = {r.column_name: r for r in columns.numeric_profiles(lines, quarters).collect()}
    price = numeric["unit_price"]
    assert (price.positive_count, price.zero_count, price.unfit_count, numeric["quantity"].unfit_count) == (2, 0, 2, 1)
    assert (price.min_value, price.max_value) == (0.001, 12345678901.5)
    assert abs(price.median - (0.001 + 12345678901.5) / 2) < 1e-4
    priced = insights.with_revenue(lines)
    assert priced.agg(F.sum("revenue")).first()[0] == Decimal("24691357803.003")
    assert {r.issue: r.records for r in exploration.issue_counts(lines).collect()}["zero_or_negative_price"] == 0
    quality = scores.quality_counts(lines).first()
    assert (quality.null_unit_price, quality.null_quantity, quality.duplicate_records) == (1, 0, 0)


def test_report_has_every_section(spark, area):
    sections = report.profile_sections(raw(spark), stage=area.stage)
    rows = report.tidy(sections).collect()
    assert {r.section for r in rows} == set(sections)
    value = {(r.section, r.column_name, r.metric): r.value for r in rows}
    assert value[("dataset_overview", None, "total_records")] == "5"
    assert float(value[("revenue_analysis", None, "median_transaction_value")]) == -21.0
    assert value[("numeric_profiles", "quantity", "median")] == "4.0"
    assert value[("customer_analysis", None, "repeat_customers")] == "2"
    assert float(value[("data_quality", None, "consistency_score")]) == 90.0
    assert report.as_json(sections).where("section = 'recommendations'").count() >= 2


def test_profile_of_nothing(spark, area):
    rows = report.tidy(report.profile_sections(raw(spark).limit(0), stage=area.stage)).collect()
    value = {(r.section, r.metric): r.value for r in rows}
    assert value[("dataset_overview", "total_records")] == "0"


def test_duplicates_count_later_copies(spark):
    assert scores.duplicate_rows(raw(spark)).first()[0] == 1


def test_exploration(spark, area):
    lines = insights.with_revenue(raw(spark))
    found = exploration.customer_revenue_summary(lines, stage=area.stage).first()
    assert (found.total_customers, found.mean_revenue, found.median_revenue) == (2, (13 - 200) / 2, (13 - 200) / 2)
    top = exploration.top_products(lines).first()
    assert (top.stock_code, float(top.revenue)) == ("B", 10.0)
    issues = {r.issue: r.records for r in exploration.issue_counts(lines).collect()}
    assert issues == {"negative_quantity": 1, "zero_or_negative_price": 2, "missing_customer": 1, "missing_description": 1}
    assert '"total_records":5' in exploration.as_json(
        exploration.exploration_summary(lines, columns.column_profiles(lines, columns.value_counts(lines)))
    ).first()[0]


def test_integrity_checks_find_planted_orphans(spark):
    silver, (days, goods, people, places) = star(spark)
    from tallyhouse.operators.fact import build_fact_sales

    sales = build_fact_sales(silver, days, goods, people)
    assert pipeline_checks.referential_integrity(sales, goods, days, people).count() == 0
    lost = sales.withColumn("product_key", F.when(F.col("source_bronze_id") != "1", F.col("product_key")))
    found = pipeline_checks.referential_integrity(lost, goods.where("stock_code <> 'B'"), days, people.limit(0)).collect()
    assert {(r.dimension, r.orphan_count, r.total_orphans) for r in found} == {
        ("product_key", 1, 6),
        ("product_key_invalid", 1, 6),
        ("customer_key_invalid", 4, 6),
    }
    assert pipeline_checks.orphan_summary(lost).first().total_orphans == 1
    status = {r.check_name: r.status for r in pipeline_checks.pipeline_checks(lost, goods, days, people).collect()}
    assert len(status) == 7 and status["Orphaned Product Keys"] == "❌ FAIL"
    codes = pipeline_checks.unmatched_codes(silver, goods.where("stock_code <> 'A'")).collect()
    assert [tuple(r) for r in codes] == [("A", 5)]


def test_column_tests(spark):
    df = spark.createDataFrame([("a", 1), ("a", 5), (None, None)], "k string, v int")
    rules = [checks.not_null("k"), checks.accepted_values("k", ["b"]), checks.accepted_range("v", 0, 4)]
    found = {r.check_type: (r.records_checked, r.records_failed) for r in checks.row_check_results(df, "t", rules).collect()}
    assert found == {"not_null": (3, 1), "accepted_values": (3, 2), "accepted_range": (3, 1)}
    assert checks.failing_rows(df, rules[2]).first().v == 5
    assert checks.unique_result(df, "t", "k").first().records_failed == 2
    assert [tuple(r) for r in checks.repeated_keys(df, "k").collect()] == [("a", 2)]
    parent = spark.createDataFrame([("b",)], "id string")
    assert checks.relationship_result(df, "t", "k", parent, "id").first().records_failed == 2
    assert not checks.at_least_one_result(df.limit(0), "t", "k").first().check_passed
