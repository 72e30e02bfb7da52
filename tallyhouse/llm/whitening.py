"""Embedding whitening by a covariance over distinct integer vectors, weighted by their multiplicity or by one."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import StagingArea
from .common import python_ready, read_table, scratch

SCALE, COMPONENTS = 256, 4
_WIDE = "decimal(38,0)"
# Columns of the result besides the rows' own.
_OUT = (
    "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, "
    "eigenvalue double, deviation_wide decimal(38,0)"
)


@dataclass
class Fit:
    """What the fit list says: its weight, the exact sums, the mean, and the leading components."""

    n: int
    sums: list[int]
    largest: int
    mean: np.ndarray
    trace: float = 0.0
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    axes: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))


def quantised(rows: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(row, x): each row whose vector has only finite entries, as a struct, and floor(scale * entry) as longs.

    Null vectors, vectors with a null, NaN or infinite entry, and empty vectors go. Of what
    is left, vectors of another length than the most frequent one (the longest of several)
    go as well: they have no place in the same space.
    """
    packed = rows.select(F.struct("*").alias("row"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) != float("inf")), F.lit(False)))
    valid = packed.where(F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    sizes = valid.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    valid = valid.where(F.size("v") == (sizes["size"] if sizes else -1))
    return valid.select("row", F.transform("v", lambda c: F.floor(c * scale)).alias("x"))


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """The batch's equally long lists as rows of a matrix."""
    lists = batch.column(name)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1) if len(lists) else np.zeros((0, 0), "i8")


def _exact(x: np.ndarray, reach: int) -> np.ndarray:
    """As int64 where sums and products up to `reach` fit, else as Python's integers."""
    return x if reach < 2**62 else x.astype(object)


def _sums(distinct: DataFrame) -> list[tuple]:
    """A row (dim, sum of weight * x, sum of weights, largest |x|) for each dimension, over all distinct vectors."""

    def per_task(batches):
        total, weight, largest = None, 0, 0
        for batch in batches:
            x, w = _matrix(batch, "x"), batch.column("weight").to_numpy(zero_copy_only=False)
            if not len(x):
                continue
            most = max(abs(int(x.max())), abs(int(x.min())))
            held, heavy = int(w.sum()), _exact(x, most * int(w.sum()))
            part = [int(v) for v in (heavy * w[:, None]).sum(axis=0)]
            total = part if total is None else [a + b for a, b in zip(total, part)]
            weight, largest = weight + held, max(largest, most)
        if total is not None:
            yield pa.RecordBatch.from_pydict(
                {
                    "dim": pa.array(range(len(total)), pa.int32()),
                    "total": pa.array([Decimal(v) for v in total], pa.decimal128(38, 0)),
                    "weight": pa.array([weight] * len(total), pa.int64()),
                    "largest": pa.array([largest] * len(total), pa.int64()),
                }
            )

    parts = distinct.mapInArrow(per_task, f"dim int, total {_WIDE}, weight bigint, largest bigint")
    return parts.groupBy("dim").agg(F.sum("total"), F.sum("weight"), F.max("largest")).orderBy("dim").collect()


def _covariance(distinct: DataFrame, mean: np.ndarray, n: int) -> np.ndarray:
    """Weighted covariance with divisor n: each batch is centred, then multiplied; tasks' parts are added up."""
    d = len(mean)

    def per_task(batches):
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch, "x") - mean
                total += (y * batch.column("weight").to_numpy(zero_copy_only=False)[:, None]).T @ y
        yield pa.RecordBatch.from_pydict(
            {"i": pa.array(range(d), pa.int32()), "row": pa.array(list(total), pa.list_(pa.float64()))}
        )

    parts = distinct.mapInArrow(per_task, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "part"))
    found = np.zeros((d, d))
    for i, j, value in parts.where("j >= i").groupBy("i", "j").agg(F.sum("part")).collect():
        found[i, j] = found[j, i] = value / n
    return found


def fitted(distinct: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The fit over (x, weight); None without a row.

    To the driver come one row per dimension and one number per pair of dimensions, which
    does not grow with the rows. Sums are exact integers.
    """
    found = _sums(distinct)
    if not found:
        return None
    sums, n, largest = [int(r[1]) for r in found], int(found[0][2]), int(max(r[3] for r in found))
    fit = Fit(n, sums, largest, np.array([float(Fraction(s, n)) for s in sums]))
    cov = _covariance(distinct, fit.mean, n)
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[: min(components, len(sums))]
    fit.trace, fit.values, fit.axes = float(np.trace(cov)), values[order], axes[:, order]
    return fit


def _flat(fit: Fit) -> np.ndarray:
    """Components without spread, by rounding at the size of the largest."""
    return fit.values <= len(fit.sums) * np.finfo(float).eps * max(fit.trace, 0.0)


def _whitened(distinct: DataFrame, fit: Fit) -> DataFrame:
    """(x, weight, deviation_wide, w): each distinct vector once, w its whitened coordinates."""
    flat = _flat(fit)
    scaled = fit.axes / np.sqrt(np.where(flat, 1.0, fit.values))
    n, mean, d = fit.n, fit.mean, len(fit.sums)
    reach = d * (2 * n * max(fit.largest, 1)) ** 2
    sums = np.array(fit.sums, dtype="i8" if reach < 2**62 else object)

    def per_task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, "x")
            away = ((_exact(x, reach) * n - sums) ** 2).sum(axis=1)
            w = (x - mean) @ scaled
            w[:, flat] = np.nan
            wide = pa.array([Decimal(int(v)) if v < 10**38 else None for v in away], pa.decimal128(38, 0))
            coordinates = pa.array(w.ravel(), pa.float64(), from_pandas=True)
            at = pa.array(np.arange(0, w.size + 1, w.shape[1], dtype="i4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("x"), batch.column("weight"), wide, pa.ListArray.from_arrays(at, coordinates)],
                names=["x", "weight", "deviation_wide", "w"],
            )

    return distinct.mapInArrow(per_task, f"x array<bigint>, weight bigint, deviation_wide {_WIDE}, w array<double>")


def _identity_error(white: DataFrame, fit: Fit) -> float | None:
    """Largest entry of |covariance of the whitened fit list - identity|, over components with spread."""
    ks = [int(k) for k in np.flatnonzero(~_flat(fit))]
    if not ks:
        return None
    at = lambda k: F.get("w", F.lit(k))
    means = white.agg(*[(F.sum(at(k) * F.col("weight")) / fit.n).alias(f"m{k}") for k in ks]).first()
    pairs = [(a, b) for a in ks for b in ks if a <= b]
    products = [F.sum((at(a) - means[f"m{a}"]) * (at(b) - means[f"m{b}"]) * F.col("weight")) / fit.n for a, b in pairs]
    found = white.agg(*products).first()
    return max(abs(v - (a == b)) for (a, b), v in zip(pairs, found))


def whiten(
    rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, weights: str = "one",
    scale: int = SCALE, area: StagingArea | None = None,
) -> DataFrame:
    """(row, component, n, deviation, whitened, explained, identity_error, eigenvalue, deviation_wide).

    One row for each row of `rows` with a usable vector (see `quantised`) and each component
    up to `components`, or as many as there are dimensions; `row` is a struct of the row's
    own columns, so any column names and repeated or null ids will do. Equal quantised
    vectors form one entry of the fit list, which counts once (weights="one") or as often as
    it occurs ("counts"); n is the sum of those weights. Every vector is whitened once and
    joined back to its rows; adaptive execution splits a vector that very many rows share.

    A component without spread (eigenvalue 0 up to rounding; all of them if there is one
    distinct vector) has null `whitened`; `explained` is null if no dimension has spread.
    `deviation` is null where it exceeds a long; `deviation_wide` has it up to 38 digits. Entries
    beyond 2**63 after scaling are held at that bound. No usable row: no rows.
    """
    if weights not in ("one", "counts"):
        raise ValueError(f"weights is 'one' or 'counts', not {weights!r}")
    python_ready(rows.sparkSession)
    area = scratch(rows.sparkSession, area)
    ready = quantised(rows, vector, scale)
    weight = F.count(F.lit(1)) if weights == "counts" else F.lit(1).cast("bigint")
    distinct = area.stage(ready.select("x").groupBy("x").agg(weight.alias("weight")), "distinct")
    fit = fitted(distinct, components)
    if fit is None:
        return ready.where("false").select("row", *[F.lit(None).cast(t).alias(n) for n, t in (c.split() for c in _OUT.split(", "))])
    white = area.stage(_whitened(distinct, fit), "whitened")
    error = _identity_error(white, fit)
    share = fit.values / fit.trace if fit.trace > 0 else [None] * len(fit.values)
    each = F.array(
        *[
            F.struct(
                F.lit(k + 1).alias("component"), F.get("w", F.lit(k)).alias("whitened"),
                F.lit(None if share[k] is None else float(share[k])).cast("double").alias("explained"),
                F.lit(float(fit.values[k])).alias("eigenvalue"),
            )
            for k in range(len(fit.values))
        ]
    )
    joined = ready.join(white.withColumnRenamed("x", "own_x"), F.col("x") == F.col("own_x"))
    fits = F.col("deviation_wide") <= F.lit(2**63 - 1).cast(_WIDE)
    return joined.select(
        "row", F.lit(fit.n).cast("bigint").alias("n"),
        F.when(fits, F.col("deviation_wide").cast("bigint")).alias("deviation"), "deviation_wide", F.explode(each).alias("c"),
    ).select(
        "row", "c.component", "n", "deviation", "c.whitened", "c.explained",
        F.lit(error).cast("double").alias("identity_error"), "c.eigenvalue", "deviation_wide",
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whiten(rows).select(
        "row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"
    )
