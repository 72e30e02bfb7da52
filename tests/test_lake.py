"""Table versions: rebuilds that fail, stop half way, change columns, read what they replace."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.fact import fact_sales_daily
from tallyhouse.sources import Lake
from tallyhouse.sources.lake import NEXT


@pytest.fixture(params=["root", "catalog"])
def lake(spark, tmp_path, request):
    lake = Lake(spark, str(tmp_path / "lake") if request.param == "root" else None, prefix=f"v{request.param}_")
    lake.create_layers()
    yield lake
    lake.forget()


def rows(lake, table="t"):
    return sorted(map(tuple, lake.read(table).collect()))


def months(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k string, month int")


def failing(df):
    """The same rows, of which one raises while it is written."""
    return df.withColumn("k", F.when(F.col("k") == "bad", F.raise_error(F.lit("broken")).cast("string")).otherwise(F.col("k")))


@pytest.mark.parametrize("partitions", [(), ("month",)])
def test_a_failed_rebuild_leaves_the_table(spark, lake, partitions):
    lake.replace(months(spark, ("a", 1), ("b", 2)), "t", None, partitions)
    held, folder = rows(lake), lake.location("t")
    with pytest.raises(Exception, match="broken"):
        lake.replace(failing(months(spark, ("c", 1), ("bad", 2))), "t", None, partitions)
    assert rows(lake) == held and lake.location("t") == folder
    lake.replace(months(spark, ("c", 3)), "t", None, partitions)
    assert rows(lake) == [("c", 3)] and lake.location("t") != folder
    with pytest.raises(Exception, match="broken"):
        lake.append(failing(months(spark, ("bad", 2))), "new", None, partitions)
    assert not lake.exists("new")


@pytest.mark.parametrize("partitions", [(), ("month",)])
def test_a_rebuild_may_read_its_table_and_older_versions_go(spark, lake, partitions):
    lake.replace(months(spark, ("a", 1)), "t", None, partitions)
    reader = lake.read("t")
    for n in range(2, 5):
        before = lake.read("t")
        lake.replace(before.unionByName(months(spark, ("a", n))), "t", None, partitions)
        assert len(lake.versions("t")) == 2
        # A plan from before still finds its files; one over partitions looks them up when it runs.
        assert before.count() == (n if partitions else n - 1)
    assert rows(lake) == [("a", n) for n in range(1, 5)]
    if not partitions:
        with pytest.raises(Exception):
            reader.collect()


def test_an_end_between_drop_and_rename_is_made_good(spark, lake, monkeypatch):
    lake.replace(months(spark, ("a", 1)), "t", None, ("month",))

    def stop(name):
        spark.sql(f"DROP TABLE {name}")
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(lake, "_publish", stop)
        with pytest.raises(KeyboardInterrupt):
            lake.replace(months(spark, ("b", 2), ("c", 3)), "t", None, ("month",))
    assert rows(lake) == [("b", 2), ("c", 3)]
    assert lake.partition_values("t", None, "month", month=2) == ["2"]
    assert not spark.catalog.tableExists(lake.qualify("t") + NEXT)


def test_an_unfinished_version_never_takes_the_place(spark, lake):
    # Rows registered under the second name, but not marked as whole.
    months(spark, ("a", 1)).write.saveAsTable(lake.qualify("t") + NEXT)
    assert not lake.exists("t")
    lake.replace(months(spark, ("b", 2)), "t")
    assert rows(lake) == [("b", 2)]


def test_columns_may_change(spark, lake):
    lake.replace(months(spark, ("a", 1)), "t")
    lake.replace(months(spark, ("a", 1)).withColumn("more", F.lit(2)), "t")
    assert rows(lake) == [("a", 1, 2)]
    lake.replace(months(spark, ("a", 1)), "t", None, ("month",))
    lake.replace(months(spark), "t", None, ("month",))
    assert rows(lake) == [] and lake.read("t").columns == ["k", "month"]


def test_partitions_are_replaced_by_the_table_not_the_session(spark, lake):
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    lake.replace_partitions(months(spark, ("a", 1), ("b", 2)), "t", None, ("month",))
    try:
        for mode in ("static", "dynamic"):
            spark.conf.set(setting, mode)
            lake.replace_partitions(months(spark, (mode, 2)), "t", None, ("month",))
            assert rows(lake) == [("a", 1), (mode, 2)] and spark.conf.get(setting) == mode
    finally:
        spark.conf.set(setting, before)
    lake.append(months(spark, ("c", 2), ("d", 5)), "t", None, ("month",))
    assert rows(lake) == [("a", 1), ("c", 2), ("d", 5), ("dynamic", 2)]
    lake.drop_partition("t", None, month=2)
    assert rows(lake) == [("a", 1), ("d", 5)]


def test_daily_summary_counts_without_expanding(spark):
    lines = [
        (1, "p", "g", "c1", "i1", 2, 5.0, False), (1, "p", "g", "c1", "i2", 1, 5.0, False),
        (1, "p", "g", "c2", "i2", 1, 1.5, True), (1, "p", "g", None, "i3", 4, None, False),
        (1, None, None, None, None, 1, 2.0, False), (2, "p", "g", "c1", "i1", 2, -3.0, True),
    ]
    columns = "date_key int, product_key string, geography_key string, customer_key string, invoice_number string"
    sales = spark.createDataFrame(lines, columns + ", quantity int, line_total double, is_return boolean")
    sales = sales.withColumn("line_total", F.col("line_total").cast("decimal(12,2)"))
    daily = fact_sales_daily(sales)
    wanted = ("date_key", "product_key", "total_quantity", "total_sales_amount", "total_returns", "total_return_amount")
    found = sorted((tuple(map(str, r)) for r in daily.select(*wanted, "unique_customers", "unique_invoices").collect()))
    assert found == [
        ("1", "None", "1", "2.00", "0", "0.00", "0", "0"),
        ("1", "p", "7", "10.00", "1", "1.50", "2", "3"),
        ("2", "p", "0", "0.00", "1", "3.00", "1", "1"),
    ]
    assert "Expand" not in daily._jdf.queryExecution().executedPlan().toString()
    assert dict(daily.dtypes)["total_quantity"] == "bigint"
