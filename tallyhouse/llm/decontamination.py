"""Benchmark passages in documents: a prefix-filtered set join over shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import StagingArea
from .common import ascii_lower, read_table, scratch, without

WINDOW, SHINGLE = 13, 5
# One in this many words makes a document contaminated.
SHARE = 20
# Benchmark shingles broadcast at once, about 100 bytes each.
BLOCK_ROWS = 500_000

# Fixed value: what separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z in small letters; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _shingle_hash(size: int, at: Column) -> Column:
    words = [F.get("words", at + i) for i in range(size)]
    return F.xxhash64(F.lit(size), *words)


def _hasher(size: int):
    return lambda at: _shingle_hash(size, at)


def _windows(items: DataFrame) -> DataFrame:
    """Distinct windows: words, size, and a shingle size (the window's, if it is shorter)."""
    size = F.least(F.lit(WINDOW), F.size("words"))
    starts = F.sequence(F.lit(0), F.size("words") - F.least(F.lit(WINDOW), F.size("words")))
    return (
        items.where(F.size("words") > 0)
        .select("item", "words", size.alias("size"), F.explode(starts).alias("start"))
        .select("item", F.slice("words", F.col("start") + 1, F.col("size")).alias("words"), "size")
        .withColumn("window", F.array_join("words", " "))
    )


def _benchmark(benchmark: DataFrame, area: StagingArea) -> tuple[DataFrame, DataFrame]:
    """(window, item) and (window, size, offset, shingle, hash, shingle_size)."""
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words_of(F.col("text")).alias("words")
    )
    windows = area.stage(_windows(items).distinct(), "windows")
    width = F.least(F.lit(SHINGLE), F.col("size"))
    pieces = windows.select("window", "size", "words").distinct().select(
        "window", "size", "words", width.alias("shingle_size"),
        F.explode(F.sequence(F.lit(0), F.col("size") - width)).alias("offset"),
    )
    hashes = F.lit(None).cast("bigint")
    for n in range(1, SHINGLE + 1):
        hashes = F.when(F.col("shingle_size") == n, _shingle_hash(n, F.col("offset"))).otherwise(hashes)
    shingles = pieces.select(
        "window", "size", "offset", "shingle_size", hashes.alias("hash"),
        F.array_join(F.slice("words", F.col("offset") + 1, F.col("shingle_size")), " ").alias("shingle"),
    )
    return windows.select("window", "item"), area.stage(shingles, "shingles")


def _found_shingles(docs: DataFrame, shingles: DataFrame, area: StagingArea) -> DataFrame:
    """doc_id, content, text_key, n_words, start, shingle: every benchmark shingle in every document.

    Each document also has one row with start -1 and no shingle, which carries its number
    of words, so that the texts are read and split once. The benchmark's distinct shingles
    are broadcast in blocks of at most BLOCK_ROWS rows, whatever their number.
    """
    sizes = sorted(r[0] for r in shingles.select("shingle_size").distinct().collect())
    split = docs.select(
        "doc_id", F.xxhash64("text").alias("content"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_key"),
        words_of(F.col("text")).alias("words"),
    )
    mark = F.xxhash64(F.lit(0))
    lists = [F.array(F.struct(F.lit(0).alias("width"), F.array(mark).alias("hashes")))]
    for n in sizes:
        hashes = F.transform(F.sequence(F.lit(0), F.size("words") - n), _hasher(n))
        found = F.when(F.size("words") >= n, hashes).otherwise(F.array().cast("array<bigint>"))
        lists.append(F.array(F.struct(F.lit(n).alias("width"), found.alias("hashes"))))
    spread = split.select("*", F.explode(F.concat(*lists)).alias("part")).select(
        "doc_id", "content", "text_key", "words", F.col("part.width").alias("width"),
        F.posexplode("part.hashes").alias("start", "found_hash"),
    )
    wanted = shingles.select("hash", "shingle", "shingle_size").distinct()
    marker = docs.sparkSession.range(1).select(mark.alias("hash"), F.lit("").alias("shingle"), F.lit(0).alias("shingle_size"))
    blocks = max(1, -(-wanted.count() // BLOCK_ROWS))
    parts = []
    for b in range(blocks):
        block = wanted.where(F.pmod("hash", F.lit(blocks)) == b)
        block = block.union(marker) if b == 0 else block
        text = F.array_join(F.slice("words", F.col("start") + 1, F.col("shingle_size")), " ")
        same = (F.col("found_hash") == F.col("hash")) & (F.col("width") == F.col("shingle_size"))
        joined = spread.join(F.broadcast(block), same).where((F.col("width") == 0) | (text == F.col("shingle")))
        parts.append(
            joined.select(
                "doc_id", "content", "text_key", F.size("words").alias("n_words"),
                F.when(F.col("width") == 0, -1).otherwise(F.col("start")).alias("start"), "shingle",
            )
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.union(part)
    return area.stage(whole, "found-shingles")


def contamination(docs: DataFrame, benchmark: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """doc_id, content, n_words, n_hit, n_items, items_sha256, contaminated for every row of `docs`.

    A window is contained only if all its shingles are, so its necessary prefix is one: the
    rarest over all documents. Places of that shingle are the candidates; a window must lie
    within the document (its length and the shingle's place in it give the bounds), and is
    verified by finding each of its shingles, compared as text, at its own place.

    Everything depends on the text alone, so copies are worked on once, under the digest of
    their text. Null, empty and wordless texts have no words and no hits; null and repeated
    items are allowed, an item without id counts as the id ''. Repeated rows are repeated.
    """
    area = scratch(docs.sparkSession, area)
    items, shingles = _benchmark(benchmark, area)
    found = _found_shingles(docs, shingles, area)
    places = area.stage(found.where("start >= 0").select("text_key", "n_words", "start", "shingle").distinct(), "places")

    frequency = places.groupBy("shingle").agg(F.count(F.lit(1)).alias("places"))
    rarity = shingles.join(frequency, "shingle", "left").withColumn("places", F.coalesce("places", F.lit(0)))
    rarest = rarity.groupBy("window", "size", "shingle_size").agg(
        F.min(F.struct("places", "offset", "shingle")).alias("least")
    )
    prefix = area.stage(
        rarest.where("least.places > 0").select("window", "size", "shingle_size", "least.offset", "least.shingle"),
        "prefix",
    )
    candidates = places.join(prefix, "shingle").select(
        "text_key", "window", "size", "n_words", (F.col("start") - F.col("offset")).alias("first")
    ).where("first >= 0 and first + size <= n_words")
    parts = candidates.join(shingles.select("window", "offset", F.col("shingle").alias("wanted")), "window").select(
        F.col("text_key").alias("key"), "window", "size", "first", "wanted",
        (F.col("first") + F.col("offset")).alias("at"),
    )
    # The places hold digests and texts that pack to a fraction in their files; they are not broadcast for that.
    matched = parts.join(
        places.hint("merge"),
        (F.col("key") == F.col("text_key")) & (F.col("at") == F.col("start")) & (F.col("wanted") == F.col("shingle")),
    )
    whole = matched.groupBy("key", "window", "first", "size").agg(F.count(F.lit(1)).alias("n"))
    need = F.col("size") - F.least(F.lit(SHINGLE), F.col("size")) + 1
    occurring = area.stage(whole.where(F.col("n") == need).select("key", "window", "first", "size"), "occurring")

    hit = (
        occurring.select("key", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("size") - 1)).alias("word"))
        .distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_hit"))
    )
    held = (
        occurring.select("key", "window").distinct().join(items, "window").groupBy(F.col("key").alias("item_key"))
        .agg(F.sort_array(F.collect_set("item")).alias("ids"))
    )
    totals = area.stage(
        hit.join(held, F.col("key") == F.col("item_key")).select(
            F.col("key").alias("hit_key"), "n_hit", F.size("ids").cast("bigint").alias("n_items"),
            F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        ),
        "totals",
    )
    documents = found.where("start = -1").select("doc_id", "content", "text_key", "n_words")
    joined = documents.join(totals, F.col("text_key") == F.col("hit_key"), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return joined.select(
        "doc_id", "content", F.col("n_words").cast("bigint").alias("n_words"), n_hit.alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("bigint")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """The rows of `docs` that are not contaminated, unchanged."""
    area = scratch(docs.sparkSession, area)
    return without(docs, contamination(docs, benchmark, area).where("contaminated"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("content")


OP9_SQL = r"""
WITH doc AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), item AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), win AS (
    SELECT DISTINCT item, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win, least(13, len(w)) AS size
    FROM item, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i)
    WHERE len(w) > 0
), sizes AS (
    SELECT DISTINCT size FROM win
), place AS (
    SELECT r, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
    FROM doc, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)
    WHERE len(w) >= size
), occ AS (
    SELECT r, i, win.size AS size, item FROM place JOIN win ON place.win = win.win AND place.size = win.size
), hit AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM occ, unnest(range(i, i + size)) AS t(p) GROUP BY r
), held AS (
    SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
    FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN held USING (r)
"""
