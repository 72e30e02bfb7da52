"""Steps that send each line over the network once: same rows as the plain way, and few exchanges."""

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import packed_key, record_hash, surrogate_key, unpacked_key
from tallyhouse.operators import fact, incremental, products
from tallyhouse.operators.joins import lookup_join, surrogate_lookup
from tallyhouse.operators.running import large_keys
from tallyhouse.plans import queries
from tallyhouse.plans.workspace import Workspace
from tallyhouse.schemas import SOURCE_COLUMNS
from tallyhouse.streaming import bronze_stream, land_stream

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture
def ws(spark):
    found = Workspace(spark, SF)
    yield found
    found.close()


def people(spark):
    known = spark.createDataFrame([("1",), ("2",), ("hot",)], "k string")
    return known.select("k", surrogate_key("k").alias("key"), F.lit("x").alias("more"))


def lines(spark):
    n = F.col("id")
    key = F.when(n % 3 == 0, "hot").when(n % 10 == 1, F.lit(None).cast("string")).otherwise((n % 5).cast("string"))
    return spark.range(500).select(n.alias("row_id"), key.alias("k"))


def test_hashed_keys_are_looked_up_without_a_shuffle_of_lines(spark, area):
    facts, dim = lines(spark), people(spark)
    found = surrogate_lookup(facts, dim, "k", "key", stage=area.stage, broadcast_limit=0)
    assert exchanges(found) == 0
    assert rows(found) == rows(lookup_join(facts, dim.select("k", "key"), "k"))


def test_other_keys_are_looked_up_by_the_join(spark, area):
    facts = lines(spark)
    for dim in (people(spark).withColumn("key", F.concat("key", F.lit("0"))), people(spark).withColumn("key", F.lit(None).cast("string"))):
        found = surrogate_lookup(facts, dim, "k", "key", stage=area.stage, broadcast_limit=0)
        assert rows(found) == rows(lookup_join(facts, dim.select("k", "key"), "k"))


def sales(spark):
    n = F.col("id")
    odd = lambda c, m: F.when(n % m != 0, c)
    return spark.range(400).select(
        odd((n % 3).cast("int"), 37).alias("date_key"), odd(surrogate_key((n % 4).cast("string")), 11).alias("product_key"),
        odd(F.when(n % 2 == 0, "plain").otherwise(F.upper(F.md5(F.lit("c")))), 13).alias("geography_key"),
        odd(surrogate_key((n % 17).cast("string")), 5).alias("customer_key"), odd((n % 23).cast("string"), 29).alias("invoice_number"),
        (n % 6 == 0).alias("is_return"), (n % 9).cast("int").alias("quantity"), (n / 4).cast("decimal(15,2)").alias("line_total"),
    )


def test_daily_sales_are_summed_from_one_shuffle(spark):
    plain = sales(spark).groupBy("date_key", "product_key", "geography_key").agg(
        F.countDistinct("customer_key").alias("unique_customers"), F.countDistinct("invoice_number").alias("unique_invoices"),
        F.sum(F.when(~F.col("is_return"), F.col("quantity")).otherwise(0)).alias("total_quantity"),
    )
    found = [fact.fact_sales_daily(sales(spark), day_rows=limit) for limit in (1_000_000, 120, 0)]
    assert exchanges(found[0]) == 1
    assert found[0].dtypes == found[1].dtypes == found[2].dtypes
    assert rows(found[0]) == rows(found[1]) == rows(found[2])
    assert rows(found[0].select(*plain.columns)) == rows(plain)


def test_products_are_summed_from_one_shuffle(spark, ws):
    for valid_only in (True, False):
        found = [products.product_measures(ws.silver, valid_only=valid_only, group_rows=limit) for limit in (1_000_000, 32, 0)]
        assert exchanges(found[0]) == 1
        assert found[0].dtypes == found[1].dtypes
        assert rows(found[0]) == rows(found[1]) == rows(found[2])


def test_large_keys(spark):
    counts = {r["k"]: r["count"] for r in lines(spark).groupBy("k").count().collect()}
    for limit in (0, 30, 60, 100, 10_000):
        assert set(large_keys(lines(spark), "k", limit)) == {k for k, n in counts.items() if n > limit}


def test_packed_keys_tell_all_keys_apart(spark):
    texts = [None, "", "a", "d41d8cd98f00b204e9800998ecf8427e", "D41D8CD98F00B204E9800998ECF8427E", "d41d8cd98f00b204e9800998ecf8427e\n", "é" * 16, "0" * 33]
    found = spark.createDataFrame([(t,) for t in texts], "k string").select("k", packed_key("k").alias("p"))
    assert [r.k for r in found.select(unpacked_key("p").alias("k")).collect()] == texts
    assert found.select("p").distinct().count() == len(texts)
    assert found.where("length(p) = 17 and k rlike '^[0-9a-f]{32}$'").count() == 1


def test_one_plan_queries_stage_no_layer_they_do_not_share(ws):
    for query in (queries.fact_daily, queries.pipeline_checks_, queries.expression_tests, queries.layer_summary, queries.top_values, queries.geo_analysis):
        query(ws)
    assert not {"online_retail_raw", "fact_sales", "profile_lines", "profile_counts"} & set(ws._tables)


def test_counts_of_one_column_count_no_other(ws):
    assert {r[0] for r in ws.counts_of("country").select("column_name").distinct().collect()} == {"country"}
    assert rows(ws.counts_of("country")) == rows(ws.profile_counts.where("column_name = 'country'"))


def test_staged_tables_are_compressed_well(spark, area):
    assert all(".zstd.parquet" in f for f in area.stage(spark.range(10)).inputFiles())


def test_repeated_keys_stage_nothing(ws):
    queries.repeated_hash_keys(ws)
    assert not ws._tables


def test_stream_lines_are_shuffled_once(spark, area):
    source = area.path("repeats")
    again = spark.range(60).select(*[(F.col("id") % 7).cast("string").alias(c) for c in SOURCE_COLUMNS])
    again.repartition(3).write.parquet(source)
    found = []
    for many_copies in (True, False):
        target = area.path("landed")
        stream = bronze_stream(spark, source, again.schema, many_copies=many_copies)
        land_stream(stream, target, area.path("checkpoint"))
        found.append(rows(spark.read.parquet(target).select("record_hash", *SOURCE_COLUMNS)))
        steps = stream._jdf.queryExecution().analyzed().toString().count("DeduplicateWithinWatermark")
        assert steps == (2 if many_copies else 1)
    assert found[0] == found[1] == rows(again.distinct().withColumn("record_hash", record_hash(SOURCE_COLUMNS)))


def test_upsert_by_packed_keys(spark):
    old = spark.createDataFrame([(None, "a", 1), ("x", None, 2), ("d41d8cd98f00b204e9800998ecf8427e", "é", 3)], "k string, more_key string, n int")
    new = spark.createDataFrame([("x", "b", 20), ("y", "c", 30)], old.schema)
    plain, packed = (incremental.upsert_rows(old, new, "k", broadcast_limit=limit) for limit in (1 << 20, 0))
    assert packed.dtypes == plain.dtypes
    assert rows(packed) == rows(plain)
    # A key that is no text is left as it is.
    assert rows(incremental.upsert_rows(old, new.limit(0), "n", broadcast_limit=-1)) == rows(old)


def test_source_readers_stage_no_bronze(ws):
    for query in (queries.bronze_load, queries.stream_ingest):
        query(ws)
        assert not ws._tables


def test_fact_takes_keys_of_dimensions(ws):
    queries.fact_incremental(ws)
    assert not {"dim_customer", "dim_product", "dim_geography"} & set(ws._tables)
    for name, dim in (("dim_product", ws.dim_product), ("dim_customer", ws.dim_customer), ("dim_geography", ws.dim_geography)):
        keys = ws._tables[f"{name}_keys"]
        assert rows(keys) == rows(dim.select(*keys.columns))
