"""Bronze and silver rules, and the models, on small hand-made rows."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tallyhouse.operators import calendar, customers, fact, geography, history, products
from tallyhouse.operators.bronze import LoadBatch, as_text, current_log, dedupe_records, load_log_entry, rename_headers, to_bronze
from tallyhouse.operators.incremental import newer_than, upsert_rows
from tallyhouse.operators.silver import clean_transactions, rejected_transactions, typed_lines

FIELDS = "bronze_id, invoice, stock_code, description, quantity, invoice_date, unit_price, customer_id, country"
SCHEMA = ", ".join(f"{c.strip()} string" for c in FIELDS.split(","))

LINES = [
    ("1", "536365", " 85123A ", " WHITE HEART ", "6", "2010-12-01 08:26:00", "2.55", "17850.0", " United Kingdom"),
    ("2", "536365", "71053", "nan", "-2", "2010-12-01 08:26:00", "3.", "17850.0", "United Kingdom"),
    ("3", "C536379", "D", "Discount", "1", "2010-12-01 09:41:00", "27.505", "nan", "France"),
    ("4", "536370", "22728", "CLOCK", "0", "2010-12-01 08:45:00", "3.75", "12583.0", "France"),
    ("5", "536370", "22729", "CLOCK", "12345678901", "2010-12-01 08:45:00", "3.75", "12583.0", "France"),
    ("6", "536370", "22730", "CLOCK", "80995", "2010-12-01 08:45:00", "-3.75", "12583.0", "France"),
    ("7", "536370", "  ", "CLOCK", "1", "nan", ".5", "12583.0", "France"),
    ("8", "536380", "22728", None, "4\n", "2010-12-02 08:45:00", "1e3", None, "France"),
]


def lines(spark, data=LINES):
    return spark.createDataFrame(data, SCHEMA)


def test_typing_rules(spark):
    typed = {r.bronze_id: r for r in typed_lines(lines(spark)).collect()}
    assert typed["1"].stock_code == "85123A" and typed["1"].product_description == "WHITE HEART"
    assert typed["1"].line_total == Decimal("15.30") and typed["1"].country == "UNITED KINGDOM"
    assert typed["1"].invoice_day_of_week == 3 and typed["1"].invoice_hour == 8
    assert typed["2"].unit_price == Decimal("3.00") and typed["2"].is_return and not typed["2"].is_valid_transaction
    assert typed["2"].product_description is None and not typed["2"].has_product_description
    assert typed["3"].unit_price == Decimal("27.51") and typed["3"].is_cancelled and typed["3"].customer_id is None
    assert typed["5"].quantity is None  # matches the pattern, does not fit an int
    assert typed["6"].unit_price is None  # a sign does not match
    assert typed["7"].unit_price is None and typed["7"].invoice_timestamp is None
    assert typed["8"].quantity is None and typed["8"].unit_price is None  # line break, exponent
    assert not typed["8"].is_complete_record


def test_clean_and_rejected_split_the_lines(spark):
    clean = {r.bronze_id for r in clean_transactions(lines(spark)).collect()}
    reasons = {r.bronze_id: set(r.reject_reasons) for r in rejected_transactions(lines(spark)).collect()}
    assert clean == {"1", "2", "3"}
    assert reasons == {
        "4": {"zero_quantity"},
        "5": {"missing_quantity"},
        "6": {"quantity_out_of_bounds", "missing_price"},
        "7": {"missing_stock_code", "missing_timestamp", "missing_price"},
        "8": {"missing_quantity", "missing_price"},
    }


def test_deleted_lines_are_left_out(spark):
    marked = lines(spark).withColumn("is_deleted", F.col("bronze_id") == "1")
    assert {r.bronze_id for r in clean_transactions(marked).collect()} == {"2", "3"}


def test_headers_and_missing_columns(spark):
    raw = spark.createDataFrame([(1, "x", 3.5)], "INVOICENO int, `Customer ID` string, UnitPrice double")
    row = as_text(rename_headers(raw)).first().asDict()
    assert row["invoice"] == "1" and row["customer_id"] == "x" and row["unit_price"] == "3.5"
    assert row["stock_code"] is None and len(row) == 8


def test_bronze_rows(spark):
    batch = LoadBatch(started_at=datetime(2011, 1, 1, 5), batch_id="B1", created_by="me")
    found = to_bronze(lines(spark).drop("bronze_id").withColumn("source_file_name", F.lit("f.csv")).withColumn("source_file_path", F.lit("/f.csv")), batch)
    kept = found.collect()
    assert len({r.bronze_id for r in kept}) == len(LINES)
    assert {(r.load_batch_id, r.ingestion_process_id, r.is_deleted, r.load_date) for r in kept} == {
        ("B1", "BRONZE_INGESTION_B1", False, date(2011, 1, 1))
    }
    assert LoadBatch().batch_id.startswith("BATCH_")


def test_dedupe_keeps_the_first_load(spark):
    df = spark.createDataFrame(
        [("a", "h", datetime(2011, 1, 2)), ("b", "h", datetime(2011, 1, 1)), ("c", "g", datetime(2011, 1, 3))],
        "bronze_id string, record_hash string, load_timestamp timestamp",
    )
    assert {r.bronze_id for r in dedupe_records(df).collect()} == {"b", "c"}


def test_dedupe_cuts_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", "h", datetime(2011, 1, 2))], "bronze_id string, record_hash string, load_timestamp timestamp")
    plan = dedupe_records(df)._jdf.queryExecution().sparkPlan().toString()
    assert "WindowGroupLimit" in plan


def test_log_shows_the_latest_state(spark):
    batch = LoadBatch(started_at=datetime(2011, 1, 1), batch_id="B1", created_by="me")
    log = load_log_entry(spark, batch, "RUNNING").unionByName(
        load_log_entry(spark, batch, "SUCCESS", event_time=datetime(2011, 1, 1, 1), records_inserted=5)
    )
    row = current_log(log).first()
    assert (row.batch_id, row.status, row.records_inserted) == ("B1", "SUCCESS", 5)


def shop(spark):
    def line(i, invoice, code, name, q, at, price, who, where):
        return (str(i), invoice, code, name, str(q), at, str(price), who, where)

    return lines(
        spark,
        [
            line(1, "1", "A", "old bag", 2, "2011-01-01 10:00:00", 10, "7", "France"),
            line(2, "1", "B", "plate", 1, "2011-01-01 10:00:00", 5, "7", "France"),
            line(3, "2", "A", "new bag", 3, "2011-03-01 10:00:00", 10, "7", "Spain"),
            line(4, "3", "A", None, 1, "2011-04-01 10:00:00", 10, None, "Spain"),
            line(5, "C4", "A", None, 5, "2011-04-02 10:00:00", 10, "7", "Spain"),
            line(6, "5", "A", None, -2, "2011-04-03 10:00:00", 10, "8", "Spain"),
            line(7, "6", "C", None, -1, "2013-04-03 10:00:00", 4, "8", "Spain"),
        ],
    )


def star(spark):
    silver = clean_transactions(shop(spark))
    dims = (
        calendar.build_dim_date(calendar.date_spine(spark, "2009-12-01", "2012-12-31"), date(2011, 5, 1)),
        products.build_dim_product(silver),
        customers.build_dim_customer(silver, date(2011, 5, 1)),
        geography.build_dim_geography(silver),
    )
    return silver, dims


def test_customer_dimension(spark):
    _, dims = star(spark)
    (row,) = dims[2].collect()
    # One order in each country: Spain has the greater value.
    assert (row.customer_id, row.country, row.total_orders, row.total_lifetime_value) == ("7", "SPAIN", 1, Decimal("30.00"))
    assert row.avg_order_value == 27.5 and row.max_order_value == Decimal("30.00")
    assert row.avg_days_between_orders is None
    assert (row.frequency_segment, row.value_segment, row.recency_segment, row.rfm_segment) == (
        "One-time", "Low-Value", "Active", "A-O-L",
    )


def test_product_dimension(spark):
    _, dims = star(spark)
    found = {r.stock_code: r for r in dims[1].collect()}
    assert set(found) == {"A", "B", "C"}
    assert found["A"].product_description == "new bag" and found["A"].product_category == "Bags & Accessories"
    # Valid lines include the cancelled invoice, not the return.
    assert (found["A"].total_transactions, found["A"].total_units_sold, found["A"].total_units_returned) == (4, 11, 0)
    assert found["A"].countries_sold_in == 2 and found["A"].unique_customers == 1
    assert found["C"].product_description == "UNKNOWN PRODUCT" and found["C"].performance_tier == "No Sales"
    assert found["C"].total_revenue == 0 and found["C"].first_sale_date is None


def test_real_return_rates(spark):
    silver, _ = star(spark)
    row = products.product_metrics(silver, valid_only=False).where("stock_code = 'A'").first()
    assert (row.return_count, row.total_units_returned) == (1, 2) and abs(row.return_rate_percent - 200 / 11) < 1e-12


def test_calendar_end_is_exclusive(spark):
    days = calendar.date_spine(spark, "2009-12-01", "2012-12-31")
    assert days.count() == 1126 and str(days.agg(F.max("full_date")).first()[0]) == "2012-12-30"
    assert calendar.date_spine(spark, "2010-01-01", "2010-01-01").count() == 0


def test_fact_keeps_lines_inside_the_calendar(spark):
    silver, dims = star(spark)
    sales = fact.build_fact_sales(silver, *dims)
    kept = {r.source_bronze_id: r for r in sales.collect()}
    assert set(kept) == {"1", "2", "3", "4", "5", "6"}  # line 7 is later than the calendar
    assert kept["4"].customer_key is None and kept["4"].product_key is not None
    assert kept["6"].customer_key is None  # a customer with returns only is not in the dimension
    assert all(r.geography_key and r.net_amount == r.line_total for r in kept.values())
    plain = fact.build_fact_sales(silver, *dims[:3])
    assert "geography_key" not in plain.columns and len(plain.columns) == 15
    salted = fact.build_fact_sales(silver, *dims, broadcast_limit=0, hot_rows=2)
    assert sorted(r.sale_key for r in salted.collect()) == sorted(r.sale_key for r in kept.values())


def test_daily_summary_adds_up(spark):
    silver, dims = star(spark)
    sales = fact.build_fact_sales(silver, *dims)
    daily = fact.fact_sales_daily(sales)
    assert daily.agg(F.sum("net_sales_amount")).first()[0] == sales.agg(F.sum("line_total")).first()[0]
    assert daily.agg(F.sum("total_returns")).first()[0] == 1


def test_history_opens_closes_and_repeats(spark):
    first = spark.createDataFrame([("A", "x"), ("B", "y"), ("C", None)], "k string, v string")
    second = spark.createDataFrame([("A", "x"), ("B", "z"), ("C", "now"), ("D", "w")], "k string, v string")
    start = history.scd2_start(first, "k", ["v"], date(2011, 1, 1))
    after = history.scd2_apply(start, second, "k", ["v"], date(2011, 2, 1))
    found = {(r.k, r.version_number): (r.v, r.is_current, r.expiration_date) for r in after.collect()}
    closed = date(2011, 2, 1)
    assert found == {
        ("A", 1): ("x", True, None),
        ("B", 1): ("y", False, closed),
        ("B", 2): ("z", True, None),
        ("C", 1): (None, False, closed),
        ("C", 2): ("now", True, None),
        ("D", 1): ("w", True, None),
    }
    again = history.scd2_apply(after, second, "k", ["v"], date(2011, 3, 1))
    assert sorted(map(str, again.collect())) == sorted(map(str, after.collect()))
    gone = history.scd2_apply(after, second.where("k <> 'A'"), "k", ["v"], date(2011, 3, 1))
    assert gone.where("k = 'A' and is_current").count() == 1

    sales = spark.createDataFrame([("B", date(2011, 1, 15)), ("B", date(2011, 2, 1)), ("X", date(2011, 2, 1))], "k string, d date")
    dated = {(r.k, r.d): r.version_number for r in history.as_of_version(sales, after, "k", "d").collect()}
    assert dated == {("B", date(2011, 1, 15)): 1, ("B", date(2011, 2, 1)): 2, ("X", date(2011, 2, 1)): None}
    salted = history.as_of_version(sales, after, "k", "d", broadcast_limit=0, hot_rows=1)
    assert {(r.k, r.d): r.version_number for r in salted.collect()} == dated


def test_watermarks(spark):
    target = spark.createDataFrame([(1, datetime(2011, 1, 5)), (2, datetime(2011, 1, 9))], "id int, loaded timestamp")
    lines_ = spark.createDataFrame([(3, datetime(2011, 1, 9)), (4, datetime(2011, 1, 10))], "id int, loaded timestamp")
    assert [r.id for r in newer_than(lines_, target, "loaded").collect()] == [4]
    assert newer_than(lines_, target.limit(0), "loaded").count() == 2
    # Business date against load clock: a line sold before the last load is skipped.
    sold = spark.createDataFrame([(5, date(2011, 1, 3)), (6, date(2011, 2, 1))], "id int, invoice_date date")
    assert [r.id for r in newer_than(sold, target, "invoice_date", "loaded").collect()] == [6]


def test_upsert_rows(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    delta = spark.createDataFrame([("b", 20), ("c", 30)], "k string, v int")
    assert {tuple(r) for r in upsert_rows(target, delta, "k").collect()} == {("a", 1), ("b", 20), ("c", 30)}


def test_snapshots_in_any_order_give_one_history(spark):
    import random

    from tallyhouse.operators.history import scd2_apply, scd2_from_snapshots, scd2_start

    rng, days = random.Random(6), [date(2011, 1, d) for d in (1, 3, 5, 6, 9)]
    rows = [(f"k{k}", rng.choice("ab"), d) for d in days for k in range(30) if rng.random() < 0.8]
    frame = lambda part: spark.createDataFrame(part, "k string, v string, snapshot_date date")
    history = None
    for d in days:
        now = frame([r for r in rows if r[2] == d]).drop("snapshot_date")
        history = scd2_start(now, "k", ["v"], d) if history is None else scd2_apply(history, now, "k", ["v"], d)
    want = sorted(map(str, history.select("k", "v", "effective_date", "expiration_date", "is_current", "version_number").collect()))
    rng.shuffle(rows)
    found = scd2_from_snapshots(frame(rows), "k", ["v"])
    assert sorted(map(str, found.collect())) == want and found.where("version_number > 2").count() > 3
    # Without its third day, which then comes late, a key's version is split.
    part = frame([("k", "a", days[0]), ("k", "a", days[4])])
    assert scd2_from_snapshots(part, "k", ["v"]).count() == 1
    late = scd2_from_snapshots(part.union(frame([("k", "b", days[2])])), "k", ["v"]).orderBy("version_number").collect()
    assert [(r.v, r.effective_date, r.expiration_date) for r in late] == [
        ("a", days[0], days[2]), ("b", days[2], days[4]), ("a", days[4], None)
    ]
