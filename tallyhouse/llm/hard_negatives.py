"""Hard negatives by exact integer products of anchor and candidate tiles (Strassen) and mergeable heaps."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import StagingArea
from .common import python_ready, read_table, scratch

SCALE = 256
# A product is split while every side of it is longer than this.
LEAF = 16
# Anchors and candidates of one tile, which bounds a task's memory: 8 MB of scores.
TILE = 1024
# Anchors of one pass over the candidates: at most so many, and 8 MB of components.
BLOCK_ROWS, BLOCK_BYTES = 8192, 8 * 1024 * 1024

# What a scaled component is held at, so that any score has 38 digits at most.
MOST = 2**55

_LOW = -(2**63)


def _padded(m: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if m.shape == (rows, columns):
        return m
    out = np.zeros((rows, columns), dtype=m.dtype)
    out[: m.shape[0], : m.shape[1]] = m
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """a @ b for integer matrices of any shape, with seven products of halves in place of eight.

    Odd sides get a zero row or column, which is cut off again. All steps are additions and
    products of integers. In int64 they wrap around alike, so the result is exact wherever it
    fits in int64 itself, whatever the size of the sums on the way.
    """
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    m2, k2, n2 = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a, b = _padded(a, 2 * m2, 2 * k2), _padded(b, 2 * k2, 2 * n2)
    a11, a12, a21, a22 = a[:m2, :k2], a[:m2, k2:], a[m2:, :k2], a[m2:, k2:]
    b11, b12, b21, b22 = b[:k2, :n2], b[:k2, n2:], b[k2:, :n2], b[k2:, n2:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * m2, 2 * n2), dtype=p1.dtype)
    out[:m2, :n2] = p1 + p4 - p5 + p7
    out[:m2, n2:] = p3 + p5
    out[m2:, :n2] = p2 + p4
    out[m2:, n2:] = p1 - p2 + p3 + p6
    return out[:m, :n]


class Heaps:
    """For each of several owners the best k (score, id): higher scores first, ties by smaller id.

    Heaps of parts merge to the heap of the whole, in any order.
    """

    def __init__(self, owners: int, k: int, dtype="i8"):
        self.k = k
        self.low = _LOW if dtype == "i8" else -(10**38)
        self.scores = np.full((owners, k), self.low, dtype=dtype)
        self.ids = np.zeros((owners, k), dtype="i8")
        self.held = np.zeros((owners, k), dtype=bool)

    def add(self, owners: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Offer a tile: a row of scores for each owner, a column for each id, ids ascending."""
        # What is below an owner's last score, once the heap is full, can not enter it.
        full = np.where(self.held[owners, -1], self.scores[owners, -1], self.low)
        allowed = allowed & (scores >= full[:, None])
        rows = np.flatnonzero(allowed.any(axis=1))
        if not len(rows):
            return
        scores, allowed, width = scores[rows], allowed[rows], scores.shape[1]
        if width > self.k:
            masked = np.where(allowed, scores, self.low)
            bound = np.partition(masked, width - self.k, axis=1)[:, width - self.k, None]
            above, level = allowed & (masked > bound), allowed & (masked == bound)
            room = self.k - above.sum(axis=1, keepdims=True)
            allowed = above | (level & (np.cumsum(level, axis=1, dtype="i4") <= room))
            # Columns that are taken come first; a row with fewer than k is filled up with others.
            order = np.argsort(~allowed, axis=1, kind="stable")[:, : self.k]
        else:
            order = np.broadcast_to(np.arange(width), scores.shape)
        pick = lambda m: np.take_along_axis(m, order, axis=1)
        self._merge(owners[rows], pick(scores), ids[order], pick(allowed))

    def _merge(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, held: np.ndarray) -> None:
        scores = np.concatenate([self.scores[at], scores], axis=1)
        ids = np.concatenate([self.ids[at], ids], axis=1)
        held = np.concatenate([self.held[at], held], axis=1)
        # Stable sorts, least important key first.
        order = np.argsort(ids, axis=1, kind="stable")
        for key in (lambda o: -np.take_along_axis(scores, o, axis=1), lambda o: ~np.take_along_axis(held, o, axis=1)):
            order = np.take_along_axis(order, np.argsort(key(order), axis=1, kind="stable"), axis=1)
        order = order[:, : self.k]
        self.scores[at] = np.take_along_axis(scores, order, axis=1)
        self.ids[at] = np.take_along_axis(ids, order, axis=1)
        self.held[at] = np.take_along_axis(held, order, axis=1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Owner, id and score of everything held."""
        owner, place = np.nonzero(self.held)
        return owner, self.ids[owner, place], self.scores[owner, place]


def _vectors(batch, d: int) -> np.ndarray:
    """The lists of `x` as rows of a matrix of width d; shorter ones end in zeros."""
    lists = batch.column("x")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), dtype="i8")
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == d).all():
        return flat.reshape(-1, d)
    out = np.zeros((len(sizes), d), dtype="i8")
    out[np.arange(d) < sizes[:, None]] = flat
    return out


def _column(batch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy() if isinstance(batch, pa.Table) else batch.column(name).to_numpy(zero_copy_only=False)


def _tiles(batches, anchors: np.ndarray, d: int, dtype) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors' slice, scores, candidates' ids ascending, their labels) of every tile of a task's candidates."""
    for batch in batches:
        order = np.argsort(_column(batch, "vec_id"), kind="stable")
        x, ids, labels = _vectors(batch, d)[order], _column(batch, "vec_id")[order], _column(batch, "label")[order]
        for c in range(0, len(ids), TILE):
            part = np.ascontiguousarray(x[c : c + TILE].T).astype(dtype)
            for a in range(0, len(anchors), TILE):
                span = slice(a, min(a + TILE, len(anchors)))
                yield span, strassen(anchors[span], part), ids[c : c + TILE], labels[c : c + TILE]


def _emitted(heaps: Heaps, named: dict[str, np.ndarray], most: int = 65_536) -> Iterator[pa.RecordBatch]:
    owner, ids, scores = heaps.rows()
    for s in range(0, len(owner), most):
        part = slice(s, s + most)
        wide = scores.dtype == object
        own = pa.array([Decimal(int(v)) for v in scores[part]], pa.decimal128(38, 0)) if wide else pa.array(scores[part])
        columns = {name: pa.array(values[owner[part]]) for name, values in named.items()}
        yield pa.RecordBatch.from_pydict(columns | {"id": pa.array(ids[part]), "score": own})


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best k of the heaps of all tasks; each key has k rows of a task at most, and Spark cuts them before the shuffle."""
    order = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY score DESC, id) AS rank"
    return found.selectExpr("*", order).where(F.col("rank") <= k)


def prepared(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, x: one row for each vec_id that takes part, x = floor(scale * component) as longs, held at +-2**55.

    Rows with a null in vec_id, label or vector, or with a null, NaN or infinite component,
    take no part. Of several rows with one vec_id the least (label, x) takes part.
    """
    finite = F.forall("embedding", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    usable = rows.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    )
    x = F.transform("embedding", lambda c: F.greatest(F.lit(-MOST), F.least(F.lit(MOST), F.floor(c.cast("double") * scale))))
    row = F.struct(F.col("label").cast("bigint").alias("label"), x.alias("x"))
    packed = usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), row.alias("row"))
    return packed.groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.label", "row.x")


def hard_negatives(
    rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    scale: int = SCALE, area: StagingArea | None = None,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    `rows` has vec_id, label and embedding, and may have other columns; `anchors` says which
    rows (by vec_id and label) are anchors. Scores are inner products of floor(scale *
    component); a shorter vector counts as ending in zeros, so an empty one scores 0. For
    each anchor the best `positives` other rows of its label are its positives, and for each
    of these the best `negatives` rows of other labels with low * p <= 100 * score <= high * p
    are returned. Equal scores go by the smaller vec_id. See `prepared` for rows left out and
    repeated ids. No anchor, or no row that fits: no rows.

    Anchors are dealt to blocks of a fixed size. Each block is sent to the tasks, which hold
    it against all candidates tile by tile: once for the positives' heaps, once for the
    windows that these set. Tasks return heaps, never scores. So memory does not grow with
    the rows, and a lost task is simply run again. Where products could exceed 64 bits,
    tiles hold Python's integers instead; a score that does not fit a long is then null.
    """
    spark = rows.sparkSession
    python_ready(spark)
    area = scratch(spark, area)
    ready = area.stage(prepared(rows, scale), "vectors")
    d, greatest, least = ready.select(F.max(F.size("x")), F.max(F.array_max("x")), F.min(F.array_min("x"))).first()
    most = max(abs(greatest or 0), abs(least or 0))
    named = area.stage(ready.where(anchors), "anchors")
    count = named.count()
    block_rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(d or 0, 1))))
    blocks = -(-count // max(1, block_rows * 3 // 4))
    dtype = "i8" if (d or 0) * most**2 * max(100, low, high) < 2**62 else object
    parts = []
    for b in range(blocks):
        block = named.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b) if blocks > 1 else named
        block = block.orderBy("vec_id").toArrow()
        if block.num_rows:
            parts.append(area.stage(_block(ready, block, d, dtype, positives, negatives, low, high), f"negatives{b}"))
    out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    return _union(parts) if parts else spark.createDataFrame([], out)


def _union(frames: list[DataFrame]) -> DataFrame:
    """As a balanced tree, so that the plan is no deeper than the logarithm of their number."""
    while len(frames) > 1:
        frames = [a.union(b) for a, b in zip(frames[::2], frames[1::2])] + frames[len(frames) // 2 * 2 :]
    return frames[0]


def _block(ready, block, d, dtype, positives, negatives, low, high) -> DataFrame:
    """Results of one block of anchors."""
    spark = ready.sparkSession
    ids, labels = _column(block, "vec_id"), _column(block, "label")
    anchors = spark.sparkContext.broadcast(_vectors(block, d).astype(dtype))

    def find_positives(batches):
        heaps = Heaps(len(ids), positives, dtype)
        for span, scores, own, own_labels in _tiles(batches, anchors.value, d, dtype):
            same = (labels[span, None] == own_labels) & (ids[span, None] != own)
            heaps.add(np.arange(span.start, span.stop), scores, same, own)
        yield from _emitted(heaps, {"anchor": np.arange(len(ids))})

    score = "bigint" if dtype == "i8" else "decimal(38,0)"
    found = _best(ready.mapInArrow(find_positives, f"anchor bigint, id bigint, score {score}"), ["anchor"], positives)
    # At most `positives` rows for each anchor of the block.
    pairs = found.orderBy("anchor", "rank").toArrow()
    owner, p_ids = _column(pairs, "anchor"), _column(pairs, "id")
    p_scores = np.array([int(v) for v in pairs.column("score").to_pylist()], dtype=dtype)
    # The n-th positives of all anchors are searched together: one row of a tile each.
    place = _column(pairs, "rank").astype("i8") - 1
    goal = np.full((positives, len(ids)), -1, dtype="i8")
    goal[place, owner] = np.arange(len(owner))

    def find_negatives(batches):
        heaps = Heaps(len(owner), negatives, dtype)
        for span, scores, own, own_labels in _tiles(batches, anchors.value, d, dtype):
            other, percent = labels[span, None] != own_labels, scores * 100
            for nth in goal:
                at = np.flatnonzero(nth[span] >= 0)
                pair = nth[span][at]
                if not len(pair):
                    continue
                p = p_scores[pair][:, None]
                inside = other[at] & (percent[at] >= low * p) & (percent[at] <= high * p)
                heaps.add(pair, scores[at], inside, own)
        yield from _emitted(heaps, {"pair": np.arange(len(owner))})

    won = _best(ready.mapInArrow(find_negatives, f"pair bigint, id bigint, score {score}"), ["pair"], negatives)
    long = lambda v: int(v) if _LOW <= v < 2**63 else None
    own = pa.table(
        {
            "pair": np.arange(len(owner)), "anchor_id": ids[owner], "positive_id": p_ids,
            "positive_score": pa.array(map(long, p_scores), pa.int64()),
        }
    )
    fits = F.col("score").between(_LOW, 2**63 - 1)
    return won.join(F.broadcast(spark.createDataFrame(own)), "pair").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.when(fits, F.col("score").cast("bigint")).alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor(256 * c::DOUBLE)::DOUBLE FOR c IN embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR c IN embedding IF coalesce(isfinite(c), false)]) = len(embedding)),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
