"""Substring de-duplication: MinHash bands over paragraphs that start where the content says."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import StagingArea
from .common import broadcast_if_small, python_ready, read_table, release, scratch
from .components import connected_components

SHINGLE, PARAGRAPH = 5, 24
# Every run of this many shingles has a paragraph start, so that any passage of
# GAP + SHINGLE - 1 + PARAGRAPH - 1 words (47) shares a whole paragraph with its copy.
GAP = 20
BANDS = 3
# Paragraphs are similar at Jaccard 4/5 of their shingles.
PART, WHOLE = 4, 5
# Band values with more comparisons left than this are split by the rarest shingles of their paragraphs.
CROWD = 4096
# Texts are shuffled to the paragraphs wanted of them in so many passes, each deleted before the next.
PASSES = 4
# Texts are handled in Python in runs of so many characters.
_RUN = 1_000_000
# Hashes of words up to a length that a worker remembers between texts, some 30 MB.
_KNOWN_WORDS, _LONGEST_KNOWN = 200_000, 64

_IN = PARAGRAPH - SHINGLE + 1
_MIX = np.array([xxhash.xxh64_intdigest(f"place {i}") | 1 for i in range(PARAGRAPH)], dtype=np.uint64)
_TURN = np.array([xxhash.xxh64_intdigest(f"band {i}") | 1 for i in range(BANDS)], dtype=np.uint64)


class _Hashes(dict):
    """XXH64 of words, each worked out when it is first asked for."""

    def __missing__(self, word: str) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= _LONGEST_KNOWN:
            self[word] = found
        return found


_hashes = _Hashes()


def _hashed(words: list[str]) -> np.ndarray:
    if len(_hashes) > _KNOWN_WORDS:
        _hashes.clear()
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the shingles of each row of word hashes."""
    count = hashes.shape[-1] - SHINGLE + 1
    found = hashes[..., :count] * _MIX[0]
    for i in range(1, SHINGLE):
        found += hashes[..., i : i + count] * _MIX[i]
    found ^= found >> np.uint64(29)
    found *= _MIX[SHINGLE]
    return found ^ (found >> np.uint64(32))


def shingles_of(text: str | None) -> np.ndarray:
    """Hashes of the five-word shingles of a text in small letters, in order; none if it is shorter."""
    words = (text or "").lower().split()
    return _mixed(_hashed(words)) if len(words) >= SHINGLE else np.zeros(0, dtype=np.uint64)


def starts_of(shingles: np.ndarray) -> np.ndarray:
    """Where paragraphs start: at the least shingle of every GAP, the last one of equals.

    Starts without room for a whole paragraph are replaced by the last one that has it.
    """
    fits = len(shingles) - _IN + 1
    if fits <= 0:
        return np.zeros(0, dtype=np.int64)
    if len(shingles) <= GAP:
        return np.array([min(int(shingles.argmin()), fits - 1)])
    views = np.lib.stride_tricks.sliding_window_view(shingles[::-1], GAP)
    found = []
    for at in range(0, len(views), 8192):
        part = views[at : at + 8192].argmin(axis=1)
        found.append(part + np.arange(at, at + len(part)))
    # The place of the least never goes back as the window moves on, so that equal places stand together.
    starts = np.minimum(len(shingles) - 1 - np.concatenate(found)[::-1], fits - 1)
    return starts[np.diff(starts, prepend=-1) > 0]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def marks_of(own: np.ndarray) -> np.ndarray:
    """64 bits of each row of shingles: bit i is flipped for each different shingle of hash i.

    Two sets differ in at least as many shingles as their bits do.
    """
    own = np.sort(own, axis=1)
    bits = np.uint64(1) << (own >> np.uint64(58))
    bits[:, 1:][own[:, 1:] == own[:, :-1]] = 0
    return np.bitwise_xor.reduce(bits, axis=1)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of some `_RUN` characters of text; a longer text is a run by itself."""
    for batch in batches:
        run, size = [], 0
        for at in range(batch.num_rows):
            row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
            run.append(row)
            size += len(row["text"] or "")
            if size >= _RUN:
                yield run
                run, size = [], 0
        if run:
            yield run


def _paragraphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in _runs(batches):
        texts = [shingles_of(row["text"]) for row in run]
        starts = [starts_of(shingles) for shingles in texts]
        counts = [len(part) for part in starts]
        shingles, start = np.concatenate(texts), np.concatenate(starts)
        row = np.repeat(np.arange(len(run)), counts)
        # Where each text's shingles stand among those of the run.
        before = np.cumsum([0] + [len(part) for part in texts[:-1]])
        ids, contents = (pa.array([r[name] for r in run], pa.int64()) for name in ("doc_id", "content"))
        for at in range(0, len(start), 65536):
            part, of = start[at : at + 65536], row[at : at + 65536]
            own = shingles[(before[of] + part)[:, None] + np.arange(_IN)]
            digest = (own * _MIX[:_IN]).sum(axis=1, dtype=np.uint64)
            bands = {f"band{i}": _signed(((turned := own * turn) ^ (turned >> np.uint64(31))).min(axis=1)) for i, turn in enumerate(_TURN)}
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": ids.take(pa.array(of)), "content": contents.take(pa.array(of)),
                    "start": pa.array(part, pa.int32()), "digest": _signed(digest),
                    "marks": _signed(marks_of(own)), **bands,
                }
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of the paragraphs wanted of each text; its other words are not hashed."""

    def flush(digests: list[int], words: list[str]) -> pa.RecordBatch:
        values = _mixed(_hashed(words).reshape(-1, PARAGRAPH))
        ends = pa.array(np.arange(0, values.size + 1, _IN), pa.int32())
        shingles = pa.ListArray.from_arrays(ends, _signed(values.reshape(-1)))
        return pa.RecordBatch.from_pydict({"digest": pa.array(digests, pa.int64()), "shingles": shingles})

    for run in _runs(batches):
        digests, words = [], []
        for row in run:
            own = (row["text"] or "").lower().split()
            for w in row["wanted"]:
                digests.append(w["digest"])
                words += own[w["start"] : w["start"] + PARAGRAPH]
                if len(digests) >= 65536:
                    yield flush(digests, words)
                    digests, words = [], []
        yield flush(digests, words)


def _alike(a: str, b: str) -> Column:
    """Bit filter for two columns of marks; no similar pair fails it."""
    # Of two sets of _IN shingles at most, similar ones differ in a ninth of their sum at most.
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) * (PART + WHOLE) <= 2 * _IN * (WHOLE - PART)


def _once(named: DataFrame, area: StagingArea) -> DataFrame:
    """One row of each document of `named`. Only the texts of repeated rows are shuffled."""
    again = named.groupBy(F.col("doc_id").alias("of_doc"), F.col("content").alias("of_content")).count().where("count > 1")
    again = area.stage(again.drop("count"), "repeated-rows")
    if not again.count():
        return named
    few = broadcast_if_small(again)
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & F.col("content").eqNullSafe(F.col("of_content"))
    doubled = named.join(few, same, "left_semi").dropDuplicates(["doc_id", "content"])
    return named.join(few, same, "left_anti").union(doubled)


def _shingle_sets(ids: DataFrame, rows: DataFrame, once: DataFrame, area: StagingArea) -> list[DataFrame]:
    """(digest, shingles) of the paragraphs of `ids` (wanted_digest), taken from the first text of each, in parts."""
    where = F.struct("doc_id", "content", "start")
    nodes = rows.join(broadcast_if_small(ids), F.col("digest") == F.col("wanted_digest"), "left_semi").groupBy("digest").agg(
        F.min(where).alias("first")
    )
    wanted = nodes.groupBy(F.col("first.doc_id").alias("of_doc"), F.col("first.content").alias("of_content")).agg(
        F.collect_list(F.struct("digest", F.col("first.start").alias("start"))).alias("wanted")
    )
    wanted = area.stage(wanted, "wanted")
    release(rows.sparkSession)
    small = broadcast_if_small(wanted, F.size("wanted"))
    # Nothing is shuffled for a small table, so that one pass does.
    passes = 1 if small is not wanted else PASSES
    sets = []
    for i in range(passes):
        texts = once.where(F.pmod("content", F.lit(passes)) == i).join(
            small.where(F.pmod("of_content", F.lit(passes)) == i) if passes > 1 else small,
            F.col("doc_id").eqNullSafe(F.col("of_doc")) & F.col("content").eqNullSafe(F.col("of_content")),
        )
        found = texts.select("text", "wanted").mapInArrow(_sets, "digest bigint, shingles array<bigint>")
        sets.append(area.stage(found, "sets"))
        release(rows.sparkSession)
    area.drop(wanted)
    return sets


def _verified(pairs: DataFrame, rows: DataFrame, once: DataFrame, area: StagingArea) -> DataFrame:
    """The pairs (a, b) of digests whose shingles are similar."""
    ids = area.stage(pairs.select(F.col("a").alias("wanted_digest")).union(pairs.select("b")).distinct(), "wanted-digests")
    parts = _shingle_sets(ids, rows, once, area)
    sets = functools.reduce(DataFrame.union, parts)
    area.drop(ids)
    a, b = sets.toDF("a", "a_set"), sets.toDF("b", "b_set")
    shared = F.size(F.array_intersect("a_set", "b_set"))
    both = F.size(F.array_distinct("a_set")) + F.size(F.array_distinct("b_set"))
    links = pairs.join(a, "a").join(b, "b").where(shared * (PART + WHOLE) >= both * PART).select("a", "b")
    links = area.stage(links, "links")
    for part in parts:
        area.drop(part)
    release(rows.sparkSession)
    return links


def _meeting(members: DataFrame, needed: Column) -> DataFrame:
    """Pairs (a, b) of the members (key, digest, marks, ...) of each key that pass the bit filter and are `needed` (x_*, y_*)."""
    side = lambda name: members.select(*[F.col(c).alias(f"{name}_{c}") for c in members.columns])
    met = side("x").join(
        side("y"),
        (F.col("x_key") == F.col("y_key")) & (F.col("x_digest") < F.col("y_digest")) & needed & _alike("x_marks", "y_marks"),
    )
    return met.select(F.col("x_digest").alias("a"), F.col("y_digest").alias("b")).distinct()


def _crowded(members: DataFrame, rows: DataFrame, once: DataFrame, area: StagingArea) -> tuple[DataFrame, DataFrame]:
    """Verified links to the first of each part of crowded keys, and the pairs still to be verified.

    `members` are (key, digest, marks, open). Similar paragraphs share one of their prefixes, the
    shingles that are rarest within the key, so a key is split by these, and each part is
    compared with its first paragraph before the others meet.
    """
    ids = area.stage(members.select(F.col("digest").alias("wanted_digest")).distinct(), "crowd-digests")
    texts = _shingle_sets(ids, rows, once, area)
    sets = functools.reduce(DataFrame.union, texts)
    area.drop(ids)
    own = members.join(sets.toDF("of", "shingles"), F.col("digest") == F.col("of")).select(
        "key", "digest", "marks", "open", F.explode(F.array_distinct("shingles")).alias("shingle")
    )
    own = area.stage(own, "crowd-shingles")
    counts = own.groupBy(F.col("key").alias("of_key"), F.col("shingle").alias("of_shingle")).agg(F.count(F.lit(1)).alias("n"))
    ranked = own.join(counts, (F.col("key") == F.col("of_key")) & (F.col("shingle") == F.col("of_shingle"))).groupBy("key", "digest").agg(
        F.first("marks").alias("marks"), F.first("open").alias("open"), F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("s")
    )
    # A set of n shingles has n - ceil(4n/5) + 1 in its prefix; one that no other has brings nobody together.
    prefix = F.filter(F.slice("s", 1, F.floor(F.size("s") * (WHOLE - PART) / WHOLE).cast("int") + 1), lambda t: t["n"] > 1)
    parts = ranked.select("key", "digest", "marks", "open", F.explode(prefix).alias("t")).select(
        F.xxhash64("key", "t.shingle").alias("key"), "digest", "marks", "open"
    )
    parts = area.stage(parts, "crowd-parts")
    for table in (own, *texts):
        area.drop(table)
    low = parts.groupBy(F.col("key").alias("low_key")).agg(
        F.min("digest").alias("low"), F.max("digest").alias("high"), F.min_by("marks", "digest").alias("low_marks")
    ).where("low < high").drop("high")
    low = area.stage(low, "first-of-part")
    others = area.stage(
        parts.join(low, (F.col("key") == F.col("low_key")) & (F.col("digest") != F.col("low"))).drop("low_key"), "rest-of-part"
    )
    stars = area.stage(
        others.where(_alike("marks", "low_marks")).select(F.col("digest").alias("a"), F.col("low").alias("b")).distinct(), "part-pairs"
    )
    links = _verified(stars, rows, once, area)
    linked = links.select(F.col("a").alias("of_a"), F.col("b").alias("of_b"))
    left = others.join(linked, (F.col("digest") == F.col("of_a")) & (F.col("low") == F.col("of_b")), "left").select(
        "key", "digest", "marks", "open", F.col("of_a").isNull().alias("apart")
    )
    met = _meeting(left, (F.col("x_open") | F.col("y_open")) & (F.col("x_apart") | F.col("y_apart")))
    met = area.stage(met, "crowd-pairs")
    for table in (parts, low, others, stars):
        area.drop(table)
    release(rows.sparkSession)
    return links, met


def repeated_paragraphs(docs: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """doc_id, content, start, class_doc_id, removed: the paragraphs whose class spans documents.

    A paragraph is 24 words from a start that depends on the words around it alone, so a
    repeated passage has the same paragraphs wherever it stands. Equal paragraphs are one
    node, by their digest. Nodes with a common band value are each compared with the first
    of them, by the exact Jaccard similarity of their five-word shingles; those that are not
    similar to it then meet all others of the value. Three bands of one hash each find a pair at
    0.8 with probability 0.99. Components of the verified links are the classes; all but the
    paragraphs of the class's first document go.

    Null, empty and short texts (under 24 words) have no paragraph. Rows of equal doc_id and
    text are one document; rows without doc_id come first and are one document per text.
    """
    spark = docs.sparkSession
    python_ready(spark)
    area = scratch(spark, area)
    named = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("content"), "text")
    once = _once(named, area)
    bands = [f"band{i}" for i in range(BANDS)]
    kind = "doc_id bigint, content bigint, start int, digest bigint, marks bigint, " + ", ".join(f"{b} bigint" for b in bands)
    rows = area.stage(named.mapInArrow(_paragraphs, kind), "paragraphs")

    entries = lambda band: rows.select("digest", "marks", F.col(band).alias("key"))
    found, firsts = [], []
    for band in bands:
        low = entries(band).groupBy("key").agg(
            F.min("digest").alias("low"), F.max("digest").alias("high"), F.min_by("marks", "digest").alias("low_marks"),
            F.count(F.lit(1)).alias("n"),
        ).where("low < high").select(F.col("key").alias("low_key"), "low", "low_marks", "n")
        low = area.stage(low, "first-of-band")
        release(spark)
        pairs = entries(band).join(low, (F.col("key") == F.col("low_key")) & (F.col("digest") != F.col("low")) & _alike("marks", "low_marks"))
        found.append(area.stage(pairs.select(F.col("digest").alias("a"), F.col("low").alias("b")).distinct(), "band-pairs"))
        # Two paragraphs have met already.
        firsts.append(area.stage(low.where("n > 2").select("low_key", "low"), "firsts"))
        area.drop(low)
        release(spark)
    pairs = area.stage(functools.reduce(DataFrame.union, found).distinct(), "pairs")
    for part in found:
        area.drop(part)
    stars = _verified(pairs, rows, once, area)
    area.drop(pairs)
    links, linked = [stars], stars.select(F.col("a").alias("of_a"), F.col("b").alias("of_b"))

    met = []
    for band, low in zip(bands, firsts):
        others = entries(band).join(low, (F.col("key") == F.col("low_key")) & (F.col("digest") != F.col("low"))).groupBy("key", "digest").agg(
            F.first("marks").alias("marks"), F.first("low").alias("low")
        )
        others = others.join(linked, (F.col("digest") == F.col("of_a")) & (F.col("low") == F.col("of_b")), "left").select(
            "key", "digest", "marks", F.col("of_a").isNull().alias("open")
        )
        others = area.stage(others, "others-of-band")
        area.drop(low)
        release(spark)
        left = others.groupBy(F.col("key").alias("left_key")).agg((F.count(F.lit(1)) * F.count_if("open")).alias("work"), F.count(F.lit(1)).alias("n"))
        left = area.stage(left.where("n > 1 and work > 0").select("left_key", (F.col("work") > CROWD).alias("crowded")), "left-of-band")
        members = others.join(left, F.col("key") == F.col("left_key"))
        few = members.where("not crowded").select("key", "digest", "marks", "open")
        met.append(area.stage(_meeting(few, F.col("x_open") | F.col("y_open")), "met"))
        release(spark)
        if left.where("crowded").count():
            many = area.stage(members.where("crowded").select("key", "digest", "marks", "open"), "crowd")
            own, rest = _crowded(many, rows, once, area)
            links.append(own)
            met.append(rest)
            area.drop(many)
        area.drop(others)
        area.drop(left)
        release(spark)
    pairs = area.stage(functools.reduce(DataFrame.union, met).distinct(), "pairs-met")
    for part in met:
        area.drop(part)
    links.append(_verified(pairs, rows, once, area))
    area.drop(pairs)
    links = functools.reduce(DataFrame.union, links)
    release(spark)
    roots = area.stage(connected_components(links, area), "roots")
    release(spark)

    document = F.struct("doc_id", "content")
    rooted = rows.join(broadcast_if_small(roots), F.col("digest") == F.col("node"), "left").withColumn(
        "root", F.coalesce("root", "digest")
    )
    # Most roots have one paragraph; only the others' documents are compared.
    several = area.stage(rooted.groupBy(F.col("root").alias("several")).count().where("count > 1").select("several"), "several")
    release(spark)
    classes = rooted.join(broadcast_if_small(several), F.col("root") == F.col("several"), "left_semi").groupBy("root").agg(
        F.min(document).alias("head"), F.max(document).alias("last")
    ).where("head < last")
    known = area.stage(classes.select(F.col("root").alias("class"), "head"), "classes")
    release(spark)
    found = rooted.join(broadcast_if_small(known), F.col("root") == F.col("class"))
    return found.select(
        "doc_id", "content", "start", F.col("head.doc_id").alias("class_doc_id"),
        (~document.eqNullSafe(F.col("head"))).alias("removed"),
    )


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership: each document of a class with the class's first document, and how much is repeated."""
    found = repeated_paragraphs(read_table(spark, sf_dir, "documents"))
    return found.groupBy("doc_id", "class_doc_id").agg(
        F.count(F.lit(1)).alias("n_paragraphs"), F.count_if("removed").alias("n_removed"),
        F.min("start").cast("bigint").alias("first_word"), F.max(F.col("start") + PARAGRAPH).cast("bigint").alias("end_word"),
    )
