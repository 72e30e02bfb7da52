"""Dimension lookups that stay balanced whatever the keys look like."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import surrogate_key

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_ROWS = 5_000_000


def frame_bytes(df: DataFrame) -> int:
    """Measured size of a frame's values: text and nested values by their text, else 16 bytes."""
    width: Column = F.lit(16 * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string":
            width = width + F.coalesce(F.octet_length(name), F.lit(0))
        elif kind.startswith(("array", "struct", "map")):
            width = width + F.coalesce(F.octet_length(F.to_json(name)), F.lit(0))
    return df.agg(F.coalesce(F.sum(width.cast("bigint")), F.lit(0))).first()[0]


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring that the frame fits; else leave the plan open."""
    return F.broadcast(df) if frame_bytes(df) <= limit else df


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    *,
    broadcast_limit: int = BROADCAST_BYTES,
    hot_rows: int = HOT_ROWS,
    measured: DataFrame | None = None,
) -> DataFrame:
    """N:1 join of `facts` to `dim` on one key column, `dim` unique by that key.

    A dimension that measures small is broadcast. A larger one is shuffled, and every key
    with more than `hot_rows` facts is spread: its facts over `fan` salts, its one
    dimension row copied to each salt. NULL keys never match, so their facts stay out of the
    join: a left join adds them again with an empty dimension, an inner one drops them.

    Hot keys are counted on `measured` (default: the facts). In a chain of lookups pass the
    stored lines, so that counting does not run the joins before this one; any hot list
    gives the same result.
    """
    if frame_bytes(dim) <= broadcast_limit:
        return facts.join(F.broadcast(dim), key, how)

    measured = facts if measured is None else measured
    hot = (
        measured.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(key, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_fan"))
    )
    # At most one key for every `hot_rows` facts; its size is measured like any other.
    hot = broadcast_if_small(hot, broadcast_limit or BROADCAST_BYTES)
    spread = F.xxhash64(*[F.col(c) for c in facts.columns])
    salted_facts = facts.where(F.col(key).isNotNull()).join(hot, key, "left").withColumn(
        "_salt", F.pmod(spread, F.coalesce("_fan", F.lit(1))).cast("int")
    ).drop("_fan")
    salted_dim = dim.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_fan"), F.lit(1)) - 1))
    ).drop("_fan")
    joined = salted_facts.join(salted_dim, [key, "_salt"], how).drop("_salt")
    if how != "left":
        return joined
    missing = [F.lit(None).cast(kind).alias(c) for c, kind in dim.dtypes if c != key]
    unkeyed = facts.where(F.col(key).isNull()).select("*", *missing)
    return joined.unionByName(unkeyed)


def surrogate_lookup(
    facts: DataFrame,
    dim: DataFrame,
    natural: str,
    surrogate: str,
    *,
    stage: Callable[[DataFrame], DataFrame],
    broadcast_limit: int = BROADCAST_BYTES,
    measured: DataFrame | None = None,
    **join_limits,
) -> DataFrame:
    """`lookup_join` (left) of `facts` to the two key columns of `dim`, without shuffling facts where it can.

    A dimension too large to broadcast whose every surrogate is the hash of its natural key
    needs no lookup of the hash, only of whether the member is there: the distinct natural
    keys of the facts that the dimension lacks are found from the keys alone, and if these
    are few enough to broadcast, all others get their hash in place. Any other dimension is
    looked up by the join.
    """
    dim, measured = dim.select(natural, surrogate), facts if measured is None else measured
    limits = join_limits | {"broadcast_limit": broadcast_limit}
    hashed = surrogate_key(natural)
    if frame_bytes(dim) > broadcast_limit and dim.where(~F.col(surrogate).eqNullSafe(hashed)).isEmpty():
        used = measured.where(F.col(natural).isNotNull()).select(natural).distinct()
        unknown = stage(used.join(dim.select(natural), natural, "left_anti"))
        if frame_bytes(unknown) <= (broadcast_limit or BROADCAST_BYTES):
            marked = facts.join(F.broadcast(unknown.withColumn("_unknown", F.lit(True))), natural, "left")
            known = F.col(natural).isNotNull() & F.col("_unknown").isNull()
            return marked.withColumn(surrogate, F.when(known, hashed)).drop("_unknown")
    return lookup_join(facts, dim, natural, measured=measured, **limits)
