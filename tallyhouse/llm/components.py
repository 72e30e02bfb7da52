"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import StagingArea
from .common import BROADCAST_ROWS, release


def _shuffled_if_large(edges: DataFrame, rows: int) -> DataFrame:
    """Marked for sort-merge joins if it has too many rows to broadcast. Files tell little: a node of many edges packs well."""
    return edges.hint("merge") if rows > BROADCAST_ROWS else edges


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = _shuffled_if_large(edges.union(edges.select("b", "a")).toDF("a", "b"), 2 * rows)
    least = both.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("low"))
    least = least.select("hub", F.least("hub", "low").alias("low"))
    return (
        both.where("b > a").join(least, F.col("a") == F.col("hub"))
        .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    )


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    edges = _shuffled_if_large(edges, rows)
    least = edges.groupBy(F.col("a").alias("hub")).agg(F.min("b").alias("low"))
    moved = (
        edges.join(least, F.col("a") == F.col("hub")).where("b <> low")
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
    )
    return moved.union(least.select("hub", "low")).toDF("a", "b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    )


def connected_components(edges: DataFrame, area: StagingArea) -> DataFrame:
    """(node, root) for every node of `edges` (a, b), both bigint; root is the least node reachable.

    Loops, repeated edges, edges in both directions and nulls (no edge) are allowed. Each
    round is written to the shared folder, in place of the one before; only a count and a
    checksum reach the driver.
    Roots are nodes too: (root, root) is a row. No edges: no rows.
    """
    now = area.stage(
        edges.toDF("a", "b").where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = _state(now)
    while before[0]:
        moved = area.stage(_small_star(_large_star(now, before[0]), before[0]), "stars")
        area.drop(now)
        release(edges.sparkSession)
        now = moved
        after = _state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select("b", "b").distinct()
    )
