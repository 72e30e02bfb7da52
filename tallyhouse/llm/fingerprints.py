"""Document fingerprints: bottom-k sketches of shingle hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import read_table

SHINGLE, K = 5, 256
# Ranges of doc_id in which documents find their next one; percentiles of all ids bound them.
RANGES_PER_PARTITION, MOST_RANGES = 4, 20_000


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[ \t-\r]+"), "")


def _sketch(words: str, k: int = K) -> Column:
    """The k least hashes of the distinct five-word shingles in the array column `words`.

    One to four words are one shingle; no word, no hash.
    """
    many = F.transform(
        F.sequence(F.lit(0), F.size(words) - SHINGLE),
        lambda i: F.xxhash64(*[F.get(words, i + n) for n in range(SHINGLE)]),
    )
    hashes = F.when(F.size(words) >= SHINGLE, many).when(F.size(words) > 0, F.array(F.xxhash64(words)))
    none = F.array().cast("array<bigint>")
    return F.coalesce(F.slice(F.sort_array(F.array_distinct(hashes)), 1, k), none)


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """`df` and a column `name` with the sketch of the text column; null is the empty text."""
    return df.withColumn(f"{name}_words", _words(F.col(text))).withColumn(name, _sketch(f"{name}_words", k)).drop(
        f"{name}_words"
    )


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_by(df: DataFrame, key: str, sketch: str, k: int = K) -> DataFrame:
    """(key, sketch) over all rows of a key, however many: each task keeps k hashes of a key at most."""
    hashes = df.select(F.col(key).alias("key"), F.explode(sketch).alias("hash")).distinct()
    ranked = hashes.selectExpr("key", "hash", "row_number() over (partition by key order by hash) as nth")
    return ranked.where(F.col("nth") <= k).groupBy("key").agg(F.sort_array(F.collect_list("hash")).alias(sketch)).withColumnRenamed("key", key)


def shingle_count(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    share = (F.element_at(sketch, k).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / share)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity; exact where both together have under k shingles. Two empty sketches: 1."""
    union = merged(a, b, k)
    share = lambda u: F.size(F.array_intersect(F.array_intersect(u, a), b)) / F.size(u)
    return F.when(a == b, 1.0).otherwise(F.get(F.transform(F.array(union), share), 0))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1 for an empty a."""
    shared = resemblance(a, b, k) * shingle_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), shared / shingle_count(a, k)))


def _range_of(value: str, bounds: list[int]) -> Column:
    """Index of the last bound that is not above the value, by halving steps."""
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = [1 << i for i in reversed(range(max(1, len(bounds) - 1).bit_length()))]
    return F.aggregate(
        F.array(*map(F.lit, steps)), F.lit(0),
        lambda at, step: F.when(
            (at + step < len(bounds)) & (F.get(table, at + step) <= F.col(value)), at + step
        ).otherwise(at),
    )


def _bounds(docs: DataFrame, ranges: int) -> list[int]:
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    low, cuts = docs.agg(F.min("doc_id"), F.percentile_approx("doc_id", shares, 20 * ranges)).first()
    return [] if low is None else sorted({low, *cuts})


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, sketch, and next_text, next_sketch of the next row by (doc_id, text).

    The last row's next is the first one. Rows without doc_id have no place in the order;
    each is its own next. Documents are dealt to ranges of doc_id and each range is read in
    order; a range's first document is also sent to the range before it, to follow its last
    one. So texts are shuffled once and only ids are looked at beforehand.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(docs, min(MOST_RANGES, RANGES_PER_PARTITION * partitions))
    alone = with_sketch(docs.where("doc_id is null"), "text", "sketch").select(
        "doc_id", "text", "sketch", F.col("text").alias("next_text"), F.col("sketch").alias("next_sketch")
    )
    if not bounds:
        return alone
    table = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    own = F.struct(F.col("at").alias("range"), F.lit(0).alias("follows"))
    before = F.struct(F.pmod(F.col("at") - 1, F.lit(len(bounds))).alias("range"), F.lit(1).alias("follows"))
    placed = docs.where("doc_id is not null").withColumn("at", _range_of("doc_id", bounds)).select(
        "doc_id", "text",
        F.explode(F.when(F.get(table, F.col("at")) == F.col("doc_id"), F.array(own, before)).otherwise(F.array(own))).alias("slot"),
    )
    dealt = placed.select("doc_id", "text", "slot.range", "slot.follows").repartition("range")
    order = "over (partition by range order by follows, doc_id, text)"
    read = with_sketch(dealt, "text", "sketch").selectExpr(
        "doc_id", "text", "sketch", "follows", f"lead(text) {order} as next_text", f"lead(sketch) {order} as next_sketch"
    )
    return read.where("follows = 0").drop("follows").unionByName(alone)


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprint of each row's text and of its edited text, and how alike they are.

    The edited text has the last half of the code points (rounded down) replaced by the
    first as many, or all, of the next document. Null is the empty text; two empty
    fingerprints are alike (1). Repeated rows are repeated, and follow one another.
    """
    rows = with_next(docs)
    text = F.coalesce("text", F.lit(""))
    rows = rows.withColumn("n_chars", F.length(text).cast("bigint"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn(
        "edited",
        F.concat(
            F.substring(text, F.lit(1), F.col("n_chars").cast("int") - half),
            F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half),
        ),
    )
    rows = with_sketch(rows.select("doc_id", "n_chars", "edited", "sketch", "next_sketch"), "edited", "edited_sketch")
    written = lambda name: F.array_join(F.transform(name, lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")
    return rows.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), written("sketch").alias("fingerprint"),
        written("edited_sketch").alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        shingle_count(F.col("sketch")).alias("n_shingles"),
    )


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(read_table(spark, sf_dir, "documents"))
