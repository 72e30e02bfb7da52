"""Files to gold tables: batches, increments, re-runs, sinks, streams."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.bronze import LoadBatch, current_log
from tallyhouse.operators.incremental import upsert_table
from tallyhouse.plans import pipeline
from tallyhouse.quality import checks
from tallyhouse.session import shared_folder
from tallyhouse.sources import (
    Lake,
    compare_tables,
    convert_to_parquet,
    dataset_card,
    read_source,
    source_files,
    write_json_report,
)
from tallyhouse.streaming import bronze_stream, land_stream

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country"
FIRST = [
    '536365,85123A,"WHITE ""HEART"" HOLDER, LARGE",6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom',
    "536365,71053,WHITE METAL LANTERN,6,2010-12-01 08:26:00,3.39,17850.0,United Kingdom",
    "C536379,D,Discount,-1,2010-12-01 09:41:00,27.50,14527.0,United Kingdom",
    "536370,22728,ALARM CLOCK,24,2011-01-04 08:45:00,3.75,12583.0,France",
    "536371,22728,ALARM CLOCK,0,2011-01-04 08:45:00,3.75,12583.0,France",
]
SECOND = [
    "536390,22728,ALARM CLOCK,10,2010-12-20 10:00:00,3.75,,Spain",
    "536391,85123A,LUNCH BAG,2,2011-02-01 10:00:00,2.55,17850.0,United Kingdom",
]


@pytest.fixture
def files(tmp_path):
    for name, rows in (("first", FIRST), ("second", SECOND)):
        (tmp_path / f"{name}.csv").write_text("\n".join([HEADER, *rows]) + "\n")
    return tmp_path


@pytest.fixture
def lake(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.create_layers()
    yield lake
    for layer in ("bronze", "silver", "gold", "test_results"):
        spark.sql(f"DROP DATABASE IF EXISTS {layer} CASCADE")


def facts(lake):
    kept = ("sale_key", "date_key", "product_key", "customer_key", "geography_key", "quantity", "line_total")
    return sorted(map(tuple, lake.read("fact_sales").select(*kept).collect()), key=repr)


def test_pipeline_in_two_batches_equals_full_rebuild(spark, lake, files, area):
    as_of = date(2011, 3, 1)
    summary = pipeline.run_pipeline(lake, str(files / "first.csv"), as_of=as_of)
    assert summary["status"] == "SUCCESS" and summary["records_loaded"] == 5
    assert lake.read("fact_sales").count() == 4
    pipeline.run_pipeline(lake, str(files / "second.csv"), as_of=as_of)
    assert lake.read("fact_sales").count() == 6  # the late December line is there too
    assert lake.read("fact_sales").select("sale_month").distinct().count() == 3

    versions = lake.read("dim_product_history")
    assert versions.where("is_current").count() == lake.read("dim_product").count() == versions.select("version_key").distinct().count()
    extended = facts(lake)
    pipeline.build_gold(lake, area, as_of=as_of)
    assert facts(lake) == extended  # nothing new, nothing changes
    pipeline.build_silver(lake, full_refresh=True)
    pipeline.build_gold(lake, area, as_of=as_of, full_refresh=True)
    assert facts(lake) == extended

    log = current_log(lake.read("ingestion_log", "bronze"))
    assert {(r.status, r.records_inserted) for r in log.collect()} == {("SUCCESS", 5), ("SUCCESS", 2)}
    assert lake.read("ingestion_log", "bronze").count() == 4

    results = pipeline.run_tests(lake, summary["batch_id"])
    assert results.where("not check_passed").count() == 0 and results.count() > 20
    assert lake.read("data_quality_checks", "silver").count() == results.count()
    assert lake.read("fact_sales_referential_integrity", "test_results").count() == 0
    assert lake.read("failing_rows", "test_results").count() == 0

    top = lake.query(
        "SELECT p.stock_code, sum(f.line_total) AS revenue FROM gold.fact_sales f JOIN gold.dim_product p "
        "ON f.product_key = p.product_key WHERE f.quantity > :least GROUP BY 1 ORDER BY 2 DESC",
        least=0,
    ).first()
    assert top.stock_code == "22728" and float(top.revenue) == 127.5
    net = lake.read("fact_sales_daily").agg(F.sum("net_sales_amount")).first()[0]
    assert net == lake.read("fact_sales").agg(F.sum("line_total")).first()[0]


def load(lake, files, area, name, batch_id, started_at, rows):
    (files / name).write_text("\n".join([HEADER, *rows]) + "\n")
    pipeline.load_bronze(lake, str(files / name), batch=LoadBatch(started_at=started_at, batch_id=batch_id))
    pipeline.build_silver(lake)
    pipeline.build_gold(lake, area, as_of=date(2014, 1, 1))


def test_late_and_equal_batches_reach_the_fact(lake, files, area):
    load(lake, files, area, "a.csv", "B2", datetime(2011, 3, 1, 10, 5), FIRST)
    load(lake, files, area, "b.csv", "B1", datetime(2011, 3, 1, 10, 0), SECOND[:1])
    load(lake, files, area, "c.csv", "B3", datetime(2011, 3, 1, 10, 5), SECOND[1:])
    assert lake.read("fact_sales").count() == 6


def test_batch_delivered_again_replaces_its_rows(lake, files, area):
    load(lake, files, area, "a.csv", "B1", datetime(2011, 3, 1), FIRST)
    load(lake, files, area, "a.csv", "B1", datetime(2011, 3, 2), [FIRST[0].replace(",6,", ",60,"), SECOND[1]])
    assert {r.quantity for r in lake.read("fact_sales").collect()} == {60, 2}
    load(lake, files, area, "a.csv", "B1", datetime(2011, 3, 3), [FIRST[4]])
    assert lake.read("fact_sales").count() == 0


def test_calendar_covers_the_lines_and_losses_are_reported(lake, files, area):
    late = SECOND[0].replace("2010-12-20", "2013-06-20")
    load(lake, files, area, "a.csv", "B1", datetime(2013, 7, 1), [*FIRST, late])
    assert lake.read("fact_sales").count() == 5
    lines = lake.read("stg_bronze__online_retail", "silver")
    assert checks.lines_reach(lines, lake.read("fact_sales"), "fact_sales").first().check_passed
    pipeline.build_gold(lake, area, as_of=date(2014, 1, 1), calendar_span=("2010-01-01", "2013-01-01"), full_refresh=True)
    lost = checks.lines_reach(lines, lake.read("fact_sales"), "fact_sales").first()
    assert not lost.check_passed and lost.records_failed == 1


def test_loading_a_batch_again_replaces_it(lake, files):
    batch = LoadBatch(started_at=datetime(2011, 3, 1), batch_id="B1")
    for _ in range(2):
        pipeline.load_bronze(lake, str(files / "first.csv"), batch=batch)
    raw = lake.read("online_retail_raw", "bronze")
    assert raw.count() == 5 and raw.select("bronze_id").distinct().count() == 5
    assert raw.where("source_file_name = 'first.csv'").count() == 5
    assert raw.where("stock_code = '85123A'").first().description == 'WHITE "HEART" HOLDER, LARGE'


def test_failed_load_is_logged_and_raised(lake, files):
    batch = LoadBatch(batch_id="B2")
    with pytest.raises(Exception):
        pipeline.load_bronze(lake, str(files / "absent.csv"), batch=batch)
    row = current_log(lake.read("ingestion_log", "bronze")).where("batch_id = 'B2'").first()
    assert row.status == "FAILED" and row.error_message


def test_upsert_rewrites_only_touched_partitions_and_follows_moved_keys(spark, lake, area):
    def frame(rows):
        return spark.createDataFrame(rows, "sale_key string, v int, sale_month int")

    def apply(rows):
        upsert_table(lake, frame(rows), "fact", None, key="sale_key", partition="sale_month", stage=area.stage)
        return {tuple(r) for r in lake.read("fact").select("sale_key", "v", "sale_month").collect()}

    apply([("a", 1, 1), ("b", 2, 2), ("c", 3, 3)])
    before = {p: set(lake.read("fact").where(F.col("sale_month") == p).inputFiles()) for p in (1, 2, 3)}
    assert apply([("b", 20, 2), ("d", 4, 2)]) == {("a", 1, 1), ("b", 20, 2), ("c", 3, 3), ("d", 4, 2)}
    after = {p: set(lake.read("fact").where(F.col("sale_month") == p).inputFiles()) for p in (1, 2, 3)}
    assert before[1] == after[1] and before[3] == after[3] and before[2] != after[2]
    # c moves to month 2: month 3 is left without rows.
    expected = {("a", 1, 1), ("b", 20, 2), ("c", 30, 2), ("d", 4, 2)}
    assert apply([("c", 30, 2)]) == expected
    assert apply([("c", 30, 2)]) == expected


def test_names_and_views(spark, lake):
    assert lake.qualify("dim_date") == "gold.dim_date" and lake.qualify("x", " silver ") == "silver.x"
    lake.replace(spark.range(3), "numbers", "silver")
    lake.view("SELECT id + 1 AS id FROM silver.numbers", "next_numbers", "silver")
    assert {r.id for r in lake.read("next_numbers", "silver").collect()} == {1, 2, 3}
    lake.view(spark.range(2), "few", "gold")
    assert spark.table("gold_few").count() == 2
    with pytest.raises(Exception):
        lake.query("SELECT * FROM silver.no_such_table")


def test_readers(spark, files, tmp_path):
    csv = read_source(spark, str(files / "first.csv"))
    assert csv.count() == 5 and csv.schema["Quantity"].dataType.typeName() == "string"
    row = source_files(csv).first()
    assert row.source_file_name == "first.csv" and row.records_extracted == 5 and row.file_size_mb > 0
    copy = convert_to_parquet(spark, str(files / "first.csv"), str(tmp_path / "copy.parquet"))
    plain = csv.drop("source_file_name", "source_file_path", "source_file_bytes")
    assert compare_tables(plain, copy).first().identical
    assert read_source(spark, str(tmp_path / "copy.parquet")).count() == 5
    fewer = compare_tables(plain, copy.limit(4)).first()
    assert (fewer.identical, fewer.only_left, fewer.only_right) == (False, 1, 0)
    card = dataset_card(plain, "first.csv").first()
    assert (card.rows, card.columns, card.column_names[0]) == (5, 8, "InvoiceNo")
    write_json_report(dataset_card(plain, "first.csv"), str(tmp_path / "card"))
    assert spark.read.json(str(tmp_path / "card")).first().rows == 5
    for path in ("lines.txt", "lines"):
        with pytest.raises(ValueError):
            read_source(spark, path)


def test_stream_lands_each_line_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    schema = "InvoiceNo string, StockCode string, Description string, Quantity string, InvoiceDate string, UnitPrice string, CustomerID string, Country string"

    def drop(name, rows):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join([HEADER, *rows]) + "\n")

    def catch_up():
        from pyspark.sql.types import StructType

        typed = StructType.fromDDL(schema)
        stream = bronze_stream(spark, source, typed, fmt="csv", files_per_trigger=1)
        land_stream(stream, target, checkpoint, lambda batch, number: seen.append(batch.count()))
        return spark.read.parquet(target)

    seen = []
    drop("a.csv", FIRST + FIRST[:1])
    assert catch_up().count() == 5
    drop("b.csv", SECOND + FIRST[:2])
    landed = catch_up()
    assert landed.count() == 7 and landed.select("record_hash").distinct().count() == 7
    assert sum(seen) == 7
    assert catch_up().count() == 7


def test_profile_is_stored_with_each_run(lake, files, area):
    for _ in range(2):
        pipeline.load_bronze(lake, str(files / "first.csv"))
        sections = pipeline.run_profile(lake, area, str(files / "report"))
    metrics = lake.read("quality_metrics", "silver")
    assert metrics.count() == 16 and metrics.select("load_id", "measured_at").distinct().count() == 2
    totals = {r.metric_value for r in metrics.where("metric_name = 'total_records'").collect()}
    assert totals == {5.0, 10.0}
    written = lake.spark.read.json(str(files / "report"))
    assert {r.section for r in written.select("section").distinct().collect()} <= set(sections) and written.count() > 40


def test_failing_rows_by_test(spark):
    import json

    rows = [("a", 1), ("b", None), ("b", 70000), (None, None), ("c", -1)]
    df = spark.createDataFrame(rows, "id string, price int")
    tests = [checks.not_null("id"), checks.not_null("price"), checks.accepted_range("price", 0, 50000)]
    found = checks.failing_by_test(df, "t", tests).unionByName(checks.repeated_rows(df, "t", "id")).collect()
    got = sorted((r.test_name, json.loads(r.row).get("id") or "", json.loads(r.row).get("price") or 0) for r in found)
    assert got == [
        ("accepted_range_price", "b", 70000), ("accepted_range_price", "c", -1), ("not_null_id", "", 0),
        ("not_null_price", "", 0), ("not_null_price", "b", 0), ("unique_id", "b", 0), ("unique_id", "b", 70000),
    ]


def test_contract_splits_rows(spark):
    df = spark.createDataFrame([(1, "a"), (0, "b"), (None, "c"), (2, None)], "quantity int, country string")
    good, bad = checks.enforce_contract(
        df, ["quantity"], {"chk_quantity_not_zero": F.col("quantity") != 0}, {"country": "UNKNOWN"}
    )
    assert {tuple(r) for r in good.collect()} == {(1, "a"), (2, "UNKNOWN")}
    assert {(r.country, tuple(r.broken_rules)) for r in bad.collect()} == {
        ("b", ("chk_quantity_not_zero",)),
        ("c", ("quantity is null",)),
    }


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
