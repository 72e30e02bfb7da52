"""What the corpus operators share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import StagingArea, release  # noqa: F401

ROOT = str(Path(__file__).resolve().parents[2])

# The ASCII capitals and small letters.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SMALLS = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_ready(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it."""
    known = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if ROOT not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, known) if x)


def scratch(spark: SparkSession, area: StagingArea | None) -> StagingArea:
    return area or StagingArea(spark)


def ascii_lower(text: Column) -> Column:
    """A-Z only. Where every character is one byte, lower() does just that, and faster."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALLS))


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of `docs` whose (doc_id, content) is not in `dropped` (doc_id, content).

    `content` is the XXH64 of the text. The list of dropped rows is the smaller side, so
    that adaptive execution can broadcast it if it is small and no text is shuffled.
    """
    packed = docs.select(F.struct("*").alias("row"))
    gone = dropped.select(F.col("doc_id").alias("gone_id"), F.col("content").alias("gone_content")).distinct()
    kept = packed.join(
        gone,
        F.col("row.doc_id").eqNullSafe(F.col("gone_id"))
        & F.xxhash64("row.text").eqNullSafe(F.col("gone_content")),
        "left_anti",
    )
    return kept.select("row.*")


# A broadcast table has this many rows and list elements at most, some 60 MB.
BROADCAST_ROWS = 500_000


def broadcast_if_small(staged: DataFrame, elements: Column | None = None) -> DataFrame:
    """A staged table of narrow rows, marked for broadcast if its counted size allows it.

    `elements` is the number of list elements of a row. Larger tables are left to shuffle
    joins; the rows are the same either way.
    """
    rows, parts = staged.agg(F.count(F.lit(1)), F.sum(elements if elements is not None else F.lit(0))).first()
    return F.broadcast(staged) if rows + (parts or 0) // 8 <= BROADCAST_ROWS else staged
