"""Line de-duplication: an exact set-similarity self-join over line tokens."""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import StagingArea
from .common import broadcast_if_small, read_table, release, scratch

# Jaccard similarity of 4/5 or more, kept as whole numbers so that no rounding decides.
PART, WHOLE = 4, 5
# Word frequencies are summed by hash bucket; their classes are a constant of the plan. Of a corpus of 135 million words,
# 3.6 million of them different, a bucket then has 14 words, so that a rare one is told from one that comes 500 times.
BUCKETS = 1 << 18
# The join on prefix tokens is made in so many passes over the sets.
PASSES = 5
# Words of 64 bits for the bit filter: one up to MEDIUM tokens, then MEDIUM_BITS, and LONG_BITS above LONG.
MEDIUM, MEDIUM_BITS = 32, 4
LONG, LONG_BITS = 80, 8


def _words(line: Column) -> Column:
    return F.split(F.lower(line), " ")


def frequency_classes(docs: DataFrame) -> Column:
    """Class of each hash bucket by its number of words over all documents: 0 for one, then one more for each doubling.

    Words of a bucket share its class; among these the length decides, for long words are the rarer ones.
    """
    words = docs.select(F.explode(_words(F.col("text"))).alias("word")).where("word <> ''")
    counts = words.groupBy(F.pmod(F.xxhash64("word"), F.lit(BUCKETS)).cast("int").alias("bucket")).count()
    found = counts.select("bucket", F.least(F.lit(31), F.floor(F.log2("count"))).cast("byte").alias("class")).toArrow()
    classes = np.zeros(BUCKETS, dtype=np.int8)
    classes[found["bucket"].to_numpy()] = found["class"].to_numpy()
    return F.split(F.lit(",".join(map(str, classes.tolist()))), ",").cast("array<tinyint>")


def _tokens(classes: Column) -> Column:
    """The line's distinct tokens as numbers, rarest first. Reads the column `line`.

    Rare means: of a low frequency class, then long, then by hash; so all lines have one
    order. A number has the class above, then the length, then 52 bits of the hash.
    """

    def number(word: Column) -> Column:
        h = F.xxhash64(word)
        above = F.shiftleft(F.get(classes, F.pmod(h, F.lit(BUCKETS)).cast("int")).cast("bigint"), 58)
        length = F.shiftleft((63 - F.least(F.octet_length(word), F.lit(63))).cast("bigint"), 52)
        return above.bitwiseOR(length).bitwiseOR(F.shiftrightunsigned(h, 12))

    words = F.array_remove(_words(F.col("line")), "")
    return F.sort_array(F.array_distinct(F.transform(words, number)))


def _lines(docs: DataFrame) -> DataFrame:
    return docs.select(
        "doc_id", F.xxhash64("text").alias("content"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")
    )


def _sets(docs: DataFrame, classes: Column, area: StagingArea) -> tuple[DataFrame, DataFrame]:
    """Lines with the two hashes of their token set, and the distinct sets with all the filters need.

    A set is numbered in the order of its first line (doc_id, content, line number), so a
    lower id is an earlier line. `prefix` has 32 bits of each token: a chance clash brings
    two lines together that are then told apart. Bit i of `bits` is flipped for each token
    of hash i: two sets differ in at least as many tokens as their bits do. Larger sets have
    more such bits, for few words let pairs pass that differ in half as many tokens again as they may.
    """
    tokens = _lines(docs).select("doc_id", "content", "line_no", _tokens(classes).alias("tokens"))
    size = F.size("tokens")
    # A set of n tokens has n - ceil(4n/5) + 1 in its prefix.
    first = F.slice("tokens", 1, F.floor(size / WHOLE).cast("int") + 1)
    prefix = F.transform(first, lambda t: F.hash(t))
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    bit = lambda t: F.call_function("shiftleft", one, t.bitwiseAND(F.lit(63)).cast("int"))
    flips = F.aggregate("tokens", zero, lambda bits, t: bits.bitwiseXOR(bit(t)))

    def words(n: int) -> Column:
        def part(i: int) -> Column:
            own = lambda t: F.shiftrightunsigned(t, 6).bitwiseAND(F.lit(n - 1)) == i
            return F.aggregate("tokens", zero, lambda bits, t: F.when(own(t), bits.bitwiseXOR(bit(t))).otherwise(bits))

        return F.array(*[part(i) for i in range(n)])

    long_bits = F.when(size > LONG, words(LONG_BITS)).when(size > MEDIUM, words(MEDIUM_BITS))
    marked = tokens.where(size > 0).select(
        "doc_id", "content", "line_no", F.xxhash64("tokens").alias("sig"), F.xxhash64(F.lit(1), "tokens").alias("sig2"),
        size.alias("size"), prefix.alias("prefix"), flips.alias("bits"),
        long_bits.alias("long_bits"),
    )
    lines = area.stage(marked, "lines")
    grouped = lines.groupBy("sig", "sig2").agg(
        F.min(F.struct("doc_id", "content", "line_no")).alias("head"), F.count(F.lit(1)).alias("copies"),
        *[F.first(c).alias(c) for c in ("size", "prefix", "bits", "long_bits")],
    )
    order = ["head.doc_id", "head.content", "head.line_no"]
    ranged = grouped.repartitionByRange(*order).sortWithinPartitions(*order)
    sets = area.stage(ranged.withColumn("id", F.monotonically_increasing_id()), "sets")
    narrow = area.stage(lines.select("doc_id", "content", "line_no", "sig", "sig2"), "line-sets")
    area.drop(lines)
    release(docs.sparkSession)
    return narrow, sets


def _may_match(position: bool = True) -> Column:
    """Length, positional and bit filters for columns a_* and b_*; no true match fails one."""
    both = F.col("a_size") + F.col("b_size")
    differ = F.bit_count(F.col("a_bits").bitwiseXOR(F.col("b_bits")))
    word = lambda c, i: F.get(c, F.lit(i))

    def folded(c: str, i: int) -> Column:
        """Word i of MEDIUM_BITS: a set of LONG_BITS words has it in the words i, i + MEDIUM_BITS and so on."""
        more = [F.coalesce(word(c, j), F.lit(0).cast("bigint")) for j in range(i + MEDIUM_BITS, LONG_BITS, MEDIUM_BITS)]
        return functools.reduce(Column.bitwiseXOR, more, word(c, i))

    def differing(of: Callable[[str, int], Column], n: int) -> Column:
        return functools.reduce(operator.add, [F.bit_count(of("a_long_bits", i).bitwiseXOR(of("b_long_bits", i))) for i in range(n)])

    both_medium = F.col("a_long_bits").isNotNull() & F.col("b_long_bits").isNotNull()
    both_long = (F.col("a_size") > LONG) & (F.col("b_size") > LONG)
    differ = F.when(both_long, differing(word, LONG_BITS)).when(both_medium, differing(folded, MEDIUM_BITS)).otherwise(differ)
    # With s tokens in all, similarity 4/5 needs 4s/9 shared ones and allows s/9 others.
    found = (
        (F.col("a_size") * WHOLE >= F.col("b_size") * PART)
        & (F.col("b_size") * WHOLE >= F.col("a_size") * PART)
        & (differ * (PART + WHOLE) <= both * (WHOLE - PART))
    )
    if position:
        rest = F.least(F.col("a_size") - F.col("a_at"), F.col("b_size") - F.col("b_at"))
        found = found & ((rest + F.least("a_at", "b_at")) * (PART + WHOLE) >= both * PART)
    return found


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, area: StagingArea) -> DataFrame:
    """The ids a (later) of the pairs (a, b) whose token sets, taken from the texts again, are similar."""
    ids = pairs.select(F.col("a").alias("wanted")).union(pairs.select("b")).distinct()
    ids = area.stage(ids, "wanted-ids")
    wanted = sets.join(broadcast_if_small(ids), F.col("id") == F.col("wanted"), "left_semi").groupBy(
        F.col("head.doc_id").alias("of_doc"), F.col("head.content").alias("of_content")
    ).agg(F.collect_list(F.struct("id", F.col("head.line_no").alias("line_no"))).alias("places"))
    wanted = area.stage(wanted, "wanted")
    texts = docs.join(
        broadcast_if_small(wanted, F.size("places")),
        F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.xxhash64("text") == F.col("of_content")),
    ).select(F.split("text", "\n").alias("lines"), "places")
    found = F.transform("places", lambda p: F.struct(p["id"].alias("id"), F.get("lines", p["line_no"]).alias("line")))
    lines = texts.select(F.inline(found))
    # Repeated rows of one document give the same id and tokens again; they change no answer.
    words = F.array_remove(_words(F.col("line")), "")
    tokens = area.stage(lines.select("id", F.array_distinct(F.transform(words, lambda w: F.xxhash64(w))).alias("tokens")), "tokens")
    area.drop(ids)
    area.drop(wanted)
    release(docs.sparkSession)
    later, earlier = tokens.toDF("a", "a_tokens"), tokens.toDF("b", "b_tokens")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    both = F.size("a_tokens") + F.size("b_tokens")
    found = pairs.join(later, "a").join(earlier, "b").where(shared * (PART + WHOLE) >= both * PART)
    matched = area.stage(found.select("a").distinct(), "matched")
    area.drop(tokens)
    return matched


def repeated_lines(docs: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """(doc_id, content, line_no) of every line that matches an earlier one.

    A line is the text between line feeds, its tokens the words between spaces in small
    letters, taken once. Lines match at Jaccard similarity 0.8 or more, and come in
    the order of doc_id (null first), content hash and line number. Lines without a word
    match nothing and stay.

    Equal sets are joined first, by their hashes. Of the different sets, two similar ones
    share a token of their prefixes, the rarest tokens. A set is first held against the
    earliest set of each of its prefix tokens and the one next before it; those that pass the
    filters, as they do in a crowd of near copies, are its first candidates. Sets that are similar to none of
    these meet every earlier set of their tokens that passes.
    """
    spark = docs.sparkSession
    area = scratch(spark, area)
    docs = docs.select("doc_id", "text")
    classes = frequency_classes(docs)
    lines, sets = _sets(docs, classes, area)

    def entries(of: DataFrame) -> DataFrame:
        return of.select("id", "size", "bits", "long_bits", "open", F.posexplode("prefix").alias("at", "token"))

    met = []
    for i in range(PASSES):
        one_list = Window.partitionBy("token").orderBy("id")
        set_of = F.struct("id", "size", "bits", "long_bits")
        first = entries(sets.withColumn("open", F.lit(True))).where(F.pmod("token", F.lit(PASSES)) == i)
        first = first.select("*", F.first(set_of).over(one_list).alias("head"), F.lag(set_of).over(one_list).alias("before"))
        tried = first.select("id", "size", "bits", "long_bits", F.explode(F.array("head", "before")).alias("b")).where("id > b.id")
        side = lambda of, name: [F.col(f"{of}{c}").alias(f"{name}_{c}") for c in ("id", "size", "bits", "long_bits")]
        found = tried.select(*side("", "a"), *side("b.", "b")).where(_may_match(position=False))
        found = found.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
        met.append(area.stage(found.distinct(), "stars"))
        release(spark)
    stars = area.stage(functools.reduce(DataFrame.union, met).distinct(), "pairs")
    release(spark)
    matched = _verified(stars, sets, docs, area)

    # The sets that no candidate has matched are open: they meet all earlier sets of their tokens.
    flagged = sets.join(broadcast_if_small(matched), F.col("id") == F.col("a"), "left").select(
        "id", "size", "bits", "long_bits", "prefix", F.col("a").isNull().alias("open")
    )
    # Both sides have the same columns, and `reach` asks for both sides at once, so that
    # one shuffle of the entries serves both. A share of the tokens at a time: the shuffle is
    # that much smaller, and deleted before the next.
    side = lambda name, found: found.select(*[F.col(c).alias(f"{name}_{c}") for c in found.columns])
    same = (F.col("a_token") == F.col("b_token")) & (F.col("a_reach") > F.col("b_id"))
    met = []
    for i in range(PASSES):
        mine = F.pmod("token", F.lit(PASSES)) == i
        found = entries(flagged).where(mine).withColumn("reach", F.when(F.col("open"), F.col("id")).otherwise(-1)).drop("open")
        pairs = side("a", found).join(side("b", found), same & _may_match())
        met.append(area.stage(pairs.select(F.col("a_id").alias("a"), F.col("b_id").alias("b")).distinct(), "met"))
        release(spark)
    # A candidate that was not similar is not tried again.
    rest = functools.reduce(DataFrame.union, met).distinct().join(stars, ["a", "b"], "left_anti")
    rest = area.stage(rest, "rest")
    matched = matched.union(_verified(rest, sets, docs, area))
    release(spark)

    matched = matched.select(F.col("a").alias("matched_id"))
    known = sets.join(matched, F.col("id") == F.col("matched_id"), "left").where("copies > 1 or matched_id is not null")
    known = area.stage(
        known.select(
            F.col("sig").alias("of_sig"), F.col("sig2").alias("of_sig2"), "head",
            F.col("matched_id").isNotNull().alias("all_go"),
        ),
        "repeated-sets",
    )
    found = lines.join(known, (F.col("sig") == F.col("of_sig")) & (F.col("sig2") == F.col("of_sig2")))
    place = F.struct("doc_id", "content", "line_no")
    return found.where(F.col("all_go") | ~place.eqNullSafe(F.col("head"))).select("doc_id", "content", "line_no")


def without_repeated_lines(docs: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """All rows of `docs` as `row` (a struct), `n_lines`, `gone` (line numbers removed) and `kept` (the text left).

    Null text has no line and stays null. Rows with equal doc_id and text are one document
    and treated alike. Other columns of `docs` are carried along, whatever their names.
    """
    area = scratch(docs.sparkSession, area)
    gone = repeated_lines(docs, area).distinct().groupBy(
        F.col("doc_id").alias("gone_doc"), F.col("content").alias("gone_content")
    ).agg(F.sort_array(F.collect_list("line_no")).alias("gone"))
    gone = area.stage(gone, "gone")
    release(docs.sparkSession)
    packed = docs.select(F.struct("*").alias("row"))
    joined = packed.join(
        broadcast_if_small(gone, F.size("gone")),
        F.col("row.doc_id").eqNullSafe(F.col("gone_doc")) & (F.xxhash64("row.text") == F.col("gone_content")),
        "left",
    )
    none = F.array().cast("array<int>")
    parts = joined.select("row", F.coalesce("gone", none).alias("gone"), F.split("row.text", "\n").alias("lines"))
    stay = F.filter("lines", lambda line, i: ~F.array_contains("gone", i))
    return parts.select(
        "row", F.coalesce(F.size("lines"), F.lit(0)).alias("n_lines"), "gone",
        F.when(F.size("gone") == 0, F.col("row.text")).otherwise(F.array_join(stay, "\n")).alias("kept"),
    )


def drop_repeated_lines(docs: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """The rows of `docs` with the lines left; rows that lost all their words go.

    n_chars, where `docs` has it, is the length of the new text.
    """
    found = without_repeated_lines(docs, area)
    left = found.where((F.size("gone") == 0) | F.col("kept").rlike(r"\S"))
    columns = []
    for name in docs.columns:
        value = {"text": F.col("kept"), "n_chars": F.coalesce(F.length("kept").cast("bigint"), F.lit(0).cast("bigint"))}.get(name)
        changed = F.size("gone") > 0
        old = F.col("row").getField(name)
        columns.append((old if value is None else F.when(changed, value).otherwise(old)).alias(name))
    return left.select(*columns)


def op8_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeated_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.col("n_lines").cast("bigint").alias("n_lines"),
        F.size("gone").cast("bigint").alias("n_removed"),
        F.array_join("gone", ",").alias("removed"),
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"),
    )


OP8_SQL = r"""
WITH line AS (
    SELECT doc_id, text, i - 1 AS line_no,
           list_distinct(list_filter(string_split(lower(parts[i]), ' '), lambda x: x <> '')) AS w
    FROM (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
         unnest(range(1, len(parts) + 1)) AS t(i)
), first AS (
    SELECT list_sort(w) AS w, min((doc_id, line_no)) AS pos, count(*) AS copies FROM line WHERE len(w) > 0 GROUP BY 1
), sets AS (
    SELECT w, pos, copies, row_number() OVER (ORDER BY pos) AS id FROM first
), freq AS (
    SELECT t AS token, count(*) AS n FROM sets, unnest(w) AS u(t) GROUP BY 1
), ranked AS (
    SELECT id, len(w) AS size, token, row_number() OVER (PARTITION BY id ORDER BY n, token) AS nth
    FROM sets, unnest(w) AS u(token) JOIN freq USING (token)
), prefix AS (
    SELECT * FROM ranked WHERE nth <= size // 5 + 1
), pairs AS (
    SELECT DISTINCT a.id AS a, b.id AS b FROM prefix a JOIN prefix b ON a.token = b.token AND a.id > b.id
    AND 5 * a.size >= 4 * b.size AND 5 * b.size >= 4 * a.size
), matched AS (
    SELECT DISTINCT a FROM pairs JOIN sets x ON x.id = a JOIN sets y ON y.id = b
    WHERE 9 * len(list_intersect(x.w, y.w)) >= 4 * (len(x.w) + len(y.w))
), gone AS (
    SELECT doc_id, line_no FROM line JOIN sets ON list_sort(line.w) = sets.w LEFT JOIN matched ON id = a
    WHERE a IS NOT NULL OR (doc_id, line_no) <> pos
), lists AS (
    SELECT doc_id, list_sort(list(line_no)) AS gone FROM gone GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(len(string_split(text, chr(10))), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, coalesce(array_to_string(gone, ','), '') AS removed,
       sha256(coalesce(array_to_string(list_filter(string_split(text, chr(10)),
              lambda x, i: NOT coalesce(list_contains(gone, i - 1), false)), chr(10)), '')) AS kept_sha256
FROM documents d LEFT JOIN lists ON d.doc_id = lists.doc_id
"""
