"""SimHash near-duplicates, linked by an embedding of segment bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from ..session import StagingArea
from .common import CAPITALS, SMALLS, python_ready, read_table, scratch, without
from .components import connected_components

WORDS, SEED = 3, 42
_LOWER = bytes.maketrans(CAPITALS.encode(), SMALLS.encode())
# Bits 0, 2, 4 ... of a long: one for each segment of two bits.
_EVEN = 0x5555555555555555
_SEGMENTS = 32


def fingerprint(text: str | None) -> int:
    """Unsigned 64-bit SimHash of a text's three-word shingles, repeats included.

    Null, empty and blank texts have fingerprint 0; one or two words are one shingle.
    """
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(words, words[1:], words[2:]))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 16384):
        part = hashes[at : at + 16384].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


@pandas_udf(LongType())
def _fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        found = np.array([fingerprint(t) for t in texts], dtype=np.uint64)
        yield pd.Series(found.view(np.int64))


def _cells(prints: DataFrame) -> DataFrame:
    """(key, print): the print's vector of bit counts per two-bit segment and all vectors one step away.

    Two vectors at Manhattan distance 2 or less meet in at least one such key. The counts
    are packed two bits each: exclusive or and carry of the odd and even bits give all 32 at once.
    """
    even = F.col("print").bitwiseAND(F.lit(_EVEN))
    odd = F.shiftrightunsigned("print", 1).bitwiseAND(F.lit(_EVEN))
    cell = even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))
    steps = F.explode(F.sequence(F.lit(-_SEGMENTS), F.lit(_SEGMENTS))).alias("step")
    count = F.expr("shiftrightunsigned(cell, 2 * (abs(step) - 1)) & 3")
    # 0 and 1 differ in the low bit of a packed count, 1 and 2 in both bits.
    flips = F.when(F.least(count, count + F.signum("step").cast("bigint")) == 0, 1).otherwise(3)
    moved = F.when(
        ((F.col("step") > 0) & (count < 2)) | ((F.col("step") < 0) & (count > 0)),
        F.col("cell").bitwiseXOR(F.call_function("shiftleft", flips.cast("bigint"), F.expr("2 * (abs(step) - 1)"))),
    )
    return (
        prints.select("print", cell.alias("cell")).select("print", "cell", steps)
        .select("print", F.when(F.col("step") == 0, F.col("cell")).otherwise(moved).alias("key"))
        .where(F.col("key").isNotNull())
    )


def linked_prints(prints: DataFrame, area: StagingArea) -> DataFrame:
    """(node, root) of the distinct fingerprints (column print) that have a link.

    Links join fingerprints that differ in at most two bits. The grid range-join finds those
    with a partner within Manhattan distance 2 of their bit counts, a lower bound of the
    number of differing bits. The survivors are then checked exactly: two fingerprints
    differ in two bits or fewer if and only if some third one is one flip or none away from
    both, so all that reach the same third one are linked, each to the least of them. The
    links grow with the number of fingerprints, never with the pairs of a group.

    A print makes up to 65 rows here, which Spark's estimate of an explode leaves out, so the joins are
    sort-merge joins whatever it estimates: a broadcast of such rows would pass through the driver.
    """
    cells = _cells(prints).hint("merge")
    shared = cells.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    near = area.stage(cells.join(shared, "key").select("print").distinct(), "near")
    flips = near.select("print", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("bit")).select(
        "print", F.expr("if(bit = 64, print, print ^ shiftleft(1L, bit))").alias("flip")
    ).hint("merge")
    least = flips.groupBy("flip").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low < high")
    links = flips.join(least.select("flip", "low"), "flip").where(
        (F.col("print") != F.col("low")) & (F.bit_count(F.col("print").bitwiseXOR(F.col("low"))) <= 2)
    )
    return connected_components(links.select("print", "low"), area)


def simhash_components(docs: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """doc_id, content (XXH64 of the text), print and component_id of every row of `docs`.

    component_id is the least doc_id among the documents reachable by links. Null, empty and
    blank texts share fingerprint 0. Repeated rows are repeated in the result; rows without
    doc_id have a component_id if a document with one is in their component. An empty table
    gives none.
    """
    spark = docs.sparkSession
    python_ready(spark)
    area = scratch(spark, area)
    marked = area.stage(
        docs.select("doc_id", F.xxhash64("text").alias("content"), _fingerprints("text").alias("print")), "prints"
    )
    first = area.stage(marked.groupBy("print").agg(F.min("doc_id").alias("first_id")), "distinct-prints")
    roots = linked_prints(first.select("print"), area)
    rooted = first.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "first_id", F.coalesce("root", "print").alias("root")
    )
    least = rooted.groupBy(F.col("root").alias("least_root")).agg(F.min("first_id").alias("component_id"))
    known = area.stage(
        rooted.join(least, F.col("root") == F.col("least_root")).select(F.col("print").alias("p"), "component_id"),
        "components",
    )
    return marked.join(known, F.col("print") == F.col("p")).select("doc_id", "content", "print", "component_id")


def drop_near_duplicates(docs: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """The rows of `docs` that are the first (least doc_id) of their component.

    Rows with the same doc_id as the first and its very text are the same document and
    stay; so do rows without doc_id whose component has no document with one.
    """
    area = scratch(docs.sparkSession, area)
    found = simhash_components(docs, area)
    return without(docs, found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
