"""Running totals and line numbers inside groups of any size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .joins import broadcast_if_small

Stage = Callable[[DataFrame], DataFrame]

GROUP_ROWS = 2_000_000


# Keys are counted by so many hash buckets before any is counted by itself.
KEY_BUCKETS = 4096


def large_keys(df: DataFrame, key: str, rows: int) -> list:
    """The values of a text column with more than `rows` rows, NULL among them if it has as many.

    Rows are counted by hash bucket, and by value only in buckets with that many, so usually
    next to nothing is shuffled. There is at most one such value for every `rows` rows.
    """
    bucket, n = F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)), F.count(F.lit(1)).alias("n")
    full = [r["bucket"] for r in df.groupBy(bucket.alias("bucket")).agg(n).where(F.col("n") > rows).collect()]
    if not full:
        return []
    counts = df.where(bucket.isin(full)).groupBy(key).agg(n).where(F.col("n") > rows)
    return [r[key] for r in counts.collect()]


def is_one_of(key: str, values: list) -> Column:
    """Whether a column has one of the values, NULL included; never NULL."""
    known = [v for v in values if v is not None]
    return F.coalesce(F.col(key).isin(known), F.lit(None in values))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: Column,
    out: str,
    *,
    stage: Stage,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Inclusive running sum of `weight` per key group; `order` must order a group totally.

    Groups up to `group_rows` rows go through a plain window. Larger ones are range
    partitioned by key and order, so that one group spans many files; a row's total is the
    sum of the group's earlier files plus the running sum inside its own file.
    """
    keys, order = list(keys), list(order)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > group_rows)
    rows = large.agg(F.sum("_rows")).first()[0]
    if rows is None:
        return df.withColumn(out, _running(weight, keys, order))
    return _split_running_total(df, keys, order, weight, out, large, rows, stage, group_rows)


def _split_running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    weight: Column,
    out: str,
    large: DataFrame,
    rows: int,
    stage: Stage,
    group_rows: int,
) -> DataFrame:
    names = broadcast_if_small(large.select(*keys))
    small_groups = df.join(names, keys, "left_anti").select(*df.columns)
    files = -(-rows // group_rows) + 1
    sorted_rows = (
        df.join(names, keys, "left_semi")
        .repartitionByRange(files, *keys, *order)
        .sortWithinPartitions(*keys, *order)
    )
    staged = stage(sorted_rows)
    numbered = staged.withColumn(
        "_file", F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int")
    )
    per_file = numbered.groupBy(*keys, "_file").agg(F.sum(weight).alias("_total"))
    earlier = Window.partitionBy(*keys).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select(
        *keys, "_file", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")
    )
    large_groups = (
        numbered.withColumn("_inside", _running(weight, [*keys, "_file"], order))
        .join(offsets, [*keys, "_file"])
        .withColumn(out, F.col("_inside") + F.col("_offset"))
        .select(*df.columns, out)
    )
    return small_groups.withColumn(out, _running(weight, keys, order)).unionByName(large_groups)


def _running(weight: Column, keys: list[str], order: list[str]) -> Column:
    span = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(weight).over(span)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str, *, stage: Stage, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """1, 2, 3 ... inside each key group, in a total order."""
    return running_total(df, keys, order, F.lit(1).cast("bigint"), out, stage=stage, group_rows=group_rows)


def exact_quantiles(
    counts: DataFrame,
    probabilities: dict[str, float],
    *,
    key: str = "column_name",
    value: str = "value",
    n: str = "n",
    stage: Stage,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Linear-interpolation quantiles per key from distinct values and their multiplicities.

    `counts` holds one row per (key, value): the heavy repetition is gone before anything is
    ordered, and ordering itself is spread over files when a key has many distinct values.
    It is read twice, so pass a staged frame. There is one output row per key; keys are
    profiled columns, so their totals are a few rows, fetched to plan with.
    """
    sizes = counts.groupBy(key).agg(F.sum(n), F.count(F.lit(1))).collect()
    if not sizes:
        empty = [F.lit(None).cast("double").alias(name) for name in probabilities]
        return counts.select(key, *empty).limit(0)
    total = F.element_at(F.create_map(*[F.lit(x) for k, rows, _ in sizes for x in (k, rows)]), F.col(key))
    if max(distinct for _, _, distinct in sizes) <= group_rows:
        reached = counts.withColumn("_upto", _running(F.col(n), [key], [value]))
    else:
        reached = running_total(counts, [key], [value], F.col(n), "_upto", stage=stage, group_rows=group_rows)
    ranked = reached.withColumn("_total", total)

    picks, results = [], []
    for name, p in probabilities.items():
        position = F.lit(p) * (F.col("_total") - 1)
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            here = (F.col("_upto") - F.col(n) <= rank) & (rank < F.col("_upto"))
            picks.append(F.max(F.when(here, F.col(value).cast("double"))).alias(f"_{name}_{side}"))
        low, high = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        results.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return ranked.groupBy(key).agg(F.max("_total").alias("_total"), *picks).select(key, *results)
