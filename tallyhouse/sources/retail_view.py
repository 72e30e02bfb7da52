"""Raw retail lines, all text, derived from order, part, supplier and nation tables.

The rules plant the dirt a retail file has: cancelled invoices, blank stock codes, missing
descriptions and customers, fractional and zero quantities, negative prices, padded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.joins import broadcast_if_small

# Description endings by part key modulo 12.
ENDINGS = (" xmas", " christmas", " birthday", " bag", " heart", " retro", " lunch")

CALENDAR = ("1995-01-01", "2002-01-01")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_scan(df: DataFrame) -> DataFrame:
    """Spread a scan that has fewer splits than the cluster has cores; leave others alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def retail_lines(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """Bronze-shaped lines with load columns; suppliers are broadcast if they measure small, else AQE picks by size."""
    lines = spread_scan(read_table(spark, sf_dir, "lineitem")) if lineitem is None else lineitem
    orders = read_table(spark, sf_dir, "orders")
    parts = read_table(spark, sf_dir, "part")
    suppliers = read_table(spark, sf_dir, "supplier").join(
        read_table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select("s_suppkey", "n_name")
    joined = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(broadcast_if_small(suppliers), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    part, supp, order = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey")
    is_return = F.col("l_returnflag") == "R"

    ending = F.coalesce(F.get(F.array(*[F.lit(e) for e in ENDINGS]), (part % 12).cast("int")), F.lit(""))
    day = F.to_date("o_orderdate")

    quantity = (
        F.when(supp % 53 == 0, "0")
        .when(supp % 47 == 0, "12.5")
        .when(supp % 43 == 0, "80995")
        .otherwise(F.concat(F.when(is_return, "-").otherwise(""), F.col("l_quantity").cast("int").cast("string")))
    )
    hour = F.lpad((order % 24).cast("string"), 2, "0")
    invoice_date = F.when(order % 211 == 0, "nan").otherwise(
        F.concat(day.cast("string"), F.lit(" "), hour, F.lit(":26:00"))
    )
    unit_price = (
        F.when(part % 101 == 0, "-11062.06")
        .when(part % 89 == 0, "0")
        .otherwise(F.col("p_retailprice").cast("decimal(10,2)").cast("string"))
    )
    return joined.select(
        F.concat_ws("-", order, F.col("l_linenumber"), part, supp).alias("bronze_id"),
        F.concat(
            F.when(is_return & (F.col("l_linestatus") == "F"), "C").otherwise(""), order.cast("string")
        ).alias("invoice"),
        F.when(part % 97 == 0, "").otherwise(F.concat(F.lit(" "), part.cast("string"), F.lit(" "))).alias("stock_code"),
        F.when(part % 50 != 0, F.concat(F.lit(" "), F.col("p_name"), ending)).alias("description"),
        quantity.alias("quantity"),
        invoice_date.alias("invoice_date"),
        unit_price.alias("unit_price"),
        F.when(F.col("o_custkey") % 4 == 0, "nan").otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.concat(F.lit(" "), F.lower("n_name"), F.lit(" ")).alias("country"),
        F.lit("lineitem").alias("source_file_name"),
        F.lit("lineitem").alias("source_file_path"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("load_timestamp"),
        F.concat(F.lit("BATCH_"), (F.year(day) * 100 + F.month(day)).cast("string")).alias("load_batch_id"),
    )
