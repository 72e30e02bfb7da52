"""The paths for hot keys and large groups, forced by small limits, against plain results."""

from pyspark.sql import Window, functions as F

from tallyhouse.operators.joins import lookup_join
from tallyhouse.operators.running import exact_quantiles, number_rows, running_total
from tallyhouse.profiling.columns import recent_rows


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def skewed(spark):
    """1,000 rows: a third share one key, some keys are NULL, the rest are spread."""
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 10 == 1, F.lit(None).cast("string")).otherwise((n % 50).cast("string"))
    return spark.range(1000).select(n.alias("row_id"), key.alias("k"))


def dimension(spark):
    return spark.range(40).select(F.col("id").cast("string").alias("k"), (F.col("id") * 7).alias("attr")).union(
        spark.createDataFrame([("hot", -1)], "k string, attr long")
    )


def test_salted_lookup_equals_plain_join(spark):
    facts, dim = skewed(spark), dimension(spark)
    for how in ("left", "inner"):
        plain = rows(facts.join(dim, "k", how))
        salted = lookup_join(facts, dim, "k", how, broadcast_limit=0, hot_rows=20)
        assert rows(salted) == plain
        assert rows(lookup_join(facts, dim, "k", how)) == plain


def test_salted_lookup_spreads_the_hot_key(spark):
    facts, dim = skewed(spark), dimension(spark)
    plan = lookup_join(facts, dim, "k", broadcast_limit=0, hot_rows=20)._jdf.queryExecution().toString()
    assert "_salt" in plan


def test_numbering_of_large_groups_equals_window(spark, area):
    df = skewed(spark).where("k is not null").withColumn("o", F.md5(F.col("row_id").cast("string")))
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("o")).cast("bigint"))
    split = number_rows(df, ["k"], ["o"], "n", stage=area.stage, group_rows=25)
    assert rows(split) == rows(plain)


def test_running_total_of_large_groups(spark, area):
    df = skewed(spark).where("k is not null")
    span = Window.partitionBy("k").orderBy("row_id").rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("t", F.sum("row_id").over(span))
    split = running_total(df, ["k"], ["row_id"], F.col("row_id"), "t", stage=area.stage, group_rows=30)
    assert rows(split) == rows(plain)


def test_quantiles_equal_linear_interpolation(spark, area):
    import numpy as np

    values = [((i * 7919) % 1013) / 4 for i in range(500)] + [3.25] * 300
    counts = area.stage(
        spark.createDataFrame([(float(v),) for v in values], "value double")
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit("c").alias("column_name"), "value", "n")
    )
    wanted = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p9": 0.9}
    for limit in (1_000_000, 40):
        found = exact_quantiles(counts, wanted, stage=area.stage, group_rows=limit).first()
        for name, p in wanted.items():
            assert abs(found[name] - np.quantile(values, p)) < 1e-9


def test_quantiles_of_nothing(spark, area):
    empty = spark.createDataFrame([], "column_name string, value double, n long")
    assert exact_quantiles(empty, {"median": 0.5}, stage=area.stage).count() == 0


def test_recent_rows_equal_sort_and_limit(spark, area):
    df = spark.range(500).select(
        F.col("id").cast("string").alias("bronze_id"),
        (F.timestamp_seconds((F.col("id") % 7) * 100)).alias("load_timestamp"),
    )
    for n in (1, 50, 72, 500, 900):
        plain = df.orderBy(F.desc("load_timestamp"), "bronze_id").limit(n)
        assert rows(recent_rows(df, n, stage=area.stage)) == rows(plain)
