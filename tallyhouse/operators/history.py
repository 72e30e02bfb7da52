"""Slowly changing dimensions, type 2."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import row_digest, surrogate_key
from .joins import lookup_join

HISTORY_COLUMNS = ("effective_date", "expiration_date", "is_current", "version_number")


def scd2_start(snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: date) -> DataFrame:
    """First version of every key."""
    return snapshot.select(
        key,
        *tracked,
        F.lit(as_of).alias("effective_date"),
        F.lit(None).cast("date").alias("expiration_date"),
        F.lit(True).alias("is_current"),
        F.lit(1).alias("version_number"),
    )


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: date) -> DataFrame:
    """History after a snapshot taken on `as_of`.

    A changed key's current version expires on `as_of` and a new version starts there; a
    new key gets version 1; unchanged and absent keys stay. Applying the same snapshot
    again changes nothing. Both inputs hold at most one current row per key.
    """
    tracked = list(tracked)
    columns = [key, *tracked, *HISTORY_COLUMNS]
    closed = history.where(~F.col("is_current")).select(*columns)
    current = history.where(F.col("is_current")).select(F.struct(*columns).alias("old"), F.col(key).alias("_key"))
    incoming = snapshot.select(F.struct(key, *tracked).alias("new"), F.col(key).alias("_key"))
    changed = row_digest([f"old.{c}" for c in tracked]) != row_digest([f"new.{c}" for c in tracked])
    matched = current.join(incoming, "_key", "full")
    replaced = F.col("old").isNotNull() & F.col("new").isNotNull() & changed

    kept = F.struct(
        F.col(f"old.{key}").alias(key),
        *[F.col(f"old.{c}").alias(c) for c in tracked],
        F.col("old.effective_date").alias("effective_date"),
        F.when(replaced, F.lit(as_of)).otherwise(F.col("old.expiration_date")).alias("expiration_date"),
        (~replaced).alias("is_current"),
        F.col("old.version_number").alias("version_number"),
    )
    opened = F.struct(
        F.col(f"new.{key}").alias(key),
        *[F.col(f"new.{c}").alias(c) for c in tracked],
        F.lit(as_of).alias("effective_date"),
        F.lit(None).cast("date").alias("expiration_date"),
        F.lit(True).alias("is_current"),
        (F.coalesce(F.col("old.version_number"), F.lit(0)) + 1).alias("version_number"),
    )
    versions = F.array_compact(
        F.array(
            F.when(F.col("old").isNotNull(), kept),
            F.when(F.col("old").isNull() | replaced, opened),
        )
    )
    return closed.unionByName(matched.select(F.inline(versions)))


def scd2_from_snapshots(snapshots: DataFrame, key: str, tracked: Sequence[str], taken: str = "snapshot_date") -> DataFrame:
    """The history that snapshots tell, in whatever order they came.

    `snapshots` has a row for each key and day (`taken`) on which the key was seen; a key that is
    absent on a day stays as it was. A version begins on a day whose row differs from the
    key's row before, and ends where the next one begins, so a late snapshot splits a
    version, and ends the one it starts on the next day the key was seen. One shuffle by
    key; a key has a row a snapshot at most, few enough for a window.
    """
    tracked = list(tracked)
    days = Window.partitionBy(key).orderBy(taken)
    told = row_digest(tracked)
    starts = snapshots.select(key, *tracked, F.col(taken).alias("effective_date"), F.lag(told).over(days).alias("_before"), told.alias("_told"))
    starts = starts.where(F.col("_before").isNull() | (F.col("_before") != F.col("_told")))
    versions = Window.partitionBy(key).orderBy("effective_date")
    ends = F.lead("effective_date").over(versions)
    return starts.select(
        key, *tracked, "effective_date", ends.alias("expiration_date"), ends.isNull().alias("is_current"),
        F.row_number().over(versions).alias("version_number"),
    )


def version_key(key: str):
    """Surrogate key of one version: the natural key with its start date."""
    return surrogate_key(key, "effective_date")


def as_of_version(facts: DataFrame, history: DataFrame, key: str, on_date: str, **join_limits) -> DataFrame:
    """Each fact with the version in force on its date: equal key, effective <= date < expiration.

    A key has at most one version per day, so its versions fit one row; the lookup is then
    the same balanced N:1 join the fact uses, whatever key is hot.
    """
    version = F.struct("effective_date", "expiration_date", "version_number", version_key(key).alias("version_key"))
    versions = history.groupBy(key).agg(F.collect_list(version).alias("_versions"))
    day = F.col(on_date)
    in_force = F.filter(
        "_versions",
        lambda v: (day >= v["effective_date"]) & (v["expiration_date"].isNull() | (day < v["expiration_date"])),
    )
    found = lookup_join(facts, versions, key, **join_limits).withColumn("_version", F.get(in_force, F.lit(0)))
    return found.select(*facts.columns, "_version.version_key", "_version.version_number")
