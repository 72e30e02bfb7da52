"""Whitening, hard negatives and quality rules against plain versions, on ties, repeats, nulls and odd rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyhouse.llm import hard_negatives, quality_rules, whitening

VECTORS = "vec_id bigint, embedding array<float>, label int, x int, row string, n bigint"
NAN, INF = float("nan"), float("inf")


def vector_rows(seed, n, d=6, copies=8):
    """Random vectors, a group of copies, ties, unusable vectors, null ids and labels."""
    rng = random.Random(seed)
    fresh = lambda: [rng.randrange(-64, 64) / 128 for _ in range(d)]
    same = fresh()
    rows = [(i, same if i % copies == 0 else fresh(), rng.randrange(4), 1, "r", 2) for i in range(n)]
    bad = [None, [], [None] * d, [0.5] * (d - 1) + [NAN], [INF] + [0.5] * (d - 1), [-INF] * d, [0.5] * (d - 1)]
    rows += [(n + k, v, 1, 1, "r", 2) for k, v in enumerate(bad)]
    return rows + [(None, fresh(), 1, 1, "r", 2), (n + 20, fresh(), None, 1, "r", 2), rows[3], rows[3]]


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def floored(v):
    return [math.floor(256 * c) for c in v]


@pytest.mark.parametrize("weights", ["one", "counts"])
def test_whitening(spark, weights):
    rows = [r for r in vector_rows(1, 90)]
    found = whitening.whiten(spark.createDataFrame(rows, VECTORS), weights=weights).collect()
    kept = [r for r in rows if usable(r[1]) and len(r[1]) == 6]
    x = np.array([floored(r[1]) for r in kept])
    fit = np.unique(x, axis=0) if weights == "one" else x
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True))
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    z = (x - fit.mean(axis=0)) @ axes / np.sqrt(values)
    away = ((x * len(fit) - fit.sum(axis=0)) ** 2).sum(axis=1)
    assert len(found) == 4 * len(kept)
    got = {}
    for r in found:
        assert r.n == len(fit) and r.identity_error < 1e-9
        assert abs(r.explained - values[r.component - 1] / np.trace(np.cov(fit.T, bias=True))) < 1e-9
        got.setdefault((r.row.vec_id, tuple(r.row.embedding)), {})[r.component] = (r.whitened, r.deviation)
    signs = np.array([math.copysign(1, got[(kept[0][0], tuple(kept[0][1]))][k + 1][0] * z[0, k]) for k in range(4)])
    for row, own, total in zip(kept, z, away):
        mine = got[(row[0], tuple(row[1]))]
        assert all(abs(mine[k + 1][0] * signs[k] - own[k]) < 1e-9 and mine[k + 1][1] == total for k in range(4))
    # Equal vectors are whitened alike, to the last bit.
    assert len({tuple(sorted(v.items())) for (i, _), v in got.items() if i is not None and i < 90 and i % 8 == 0}) == 1


def test_whitening_without_spread(spark):
    none = spark.createDataFrame([], VECTORS)
    found = whitening.whiten(none)
    assert found.count() == 0 and found.columns[1:4] == ["component", "n", "deviation"]
    one = whitening.whiten(spark.createDataFrame([(i, [0.5, 0.25], 1, 1, "r", 2) for i in range(3)], VECTORS)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 6
    # Two dimensions of which one never varies; huge entries, whose squares exceed a long.
    flat = [(i, [float(i) * 1e12, 0.25], 1, 1, "r", 2) for i in range(4)]
    rows = whitening.whiten(spark.createDataFrame(flat, VECTORS)).collect()
    assert {r.component: r.whitened is None for r in rows} == {1: False, 2: True}
    assert all(r.deviation is None and r.deviation_wide > 2**63 for r in rows)
    exact = {r.row.vec_id: int(r.deviation_wide) for r in rows}
    x = [math.floor(256 * float(np.float32(r[1][0]))) for r in flat]
    assert exact == {r[0]: (4 * v - sum(x)) ** 2 for r, v in zip(flat, x)}


def test_whitening_many_batches(spark, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        test_whitening(spark, "one")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("shape", [(1, 1, 1), (1, 70, 1), (33, 17, 90), (64, 64, 64), (3, 200, 41), (0, 5, 3), (130, 0, 40)])
def test_strassen(shape):
    rng, (m, k, n) = np.random.default_rng(3), shape
    a, b = rng.integers(-(2**30), 2**30, (m, k)), rng.integers(-(2**25), 2**25, (k, n))
    assert (hard_negatives.strassen(a, b, 4) == a @ b).all()
    big_a, big_b = a.astype(object) * 2**40, b.astype(object) * 2**40
    assert (hard_negatives.strassen(big_a, big_b, 4) == big_a @ big_b).all()


def test_heaps_merge():
    rng = random.Random(5)
    for _ in range(30):
        owners, k = rng.randrange(1, 5), rng.randrange(1, 6)
        offers = [(rng.randrange(owners), rng.randrange(4), i) for i in rng.sample(range(1000), rng.randrange(60))]
        heaps = hard_negatives.Heaps(owners, k)
        for cut in range(0, len(offers), 13):
            ids = np.array(sorted(i for *_, i in offers[cut : cut + 13]))
            at = {i: (o, s) for o, s, i in offers[cut : cut + 13]}
            scores = np.array([[at[i][1] for i in ids]] * owners)
            allowed = np.array([[at[i][0] == o for i in ids] for o in range(owners)])
            heaps.add(np.arange(owners), scores, allowed, ids)
        want = {o: sorted((-s, i) for x, s, i in offers if x == o)[:k] for o in range(owners)}
        got = {o: [] for o in range(owners)}
        for o, i, s in zip(*heaps.rows()):
            got[o].append((-s, i))
        assert got == want


def brute_negatives(rows, is_anchor, low=30, high=90):
    """Rows with the least (label, vector) of a vec_id, scored pair by pair."""
    one = {}
    for i, v, label in rows:
        if i is not None and label is not None and usable(v):
            one[i] = min(one.get(i, (label, floored(v))), (label, floored(v)))
    score = lambda a, b: sum(p * q for p, q in zip(one[a][1], one[b][1]))
    best = lambda ids, a, k: sorted(ids, key=lambda b: (-score(a, b), b))[:k]
    out = set()
    for a in filter(is_anchor, one):
        for p in best([b for b in one if b != a and one[b][0] == one[a][0]], a, 5):
            s = score(a, p)
            fit = [b for b in one if one[b][0] != one[a][0] and low * s <= 100 * score(a, b) <= high * s]
            out |= {(a, p, r + 1, b, s, score(a, b)) for r, b in enumerate(best(fit, a, 10))}
    return out


def test_hard_negatives(spark, monkeypatch):
    rows = vector_rows(2, 160, d=5, copies=3)
    rows += [(7, [9.0] * 5, 0, 1, "r", 2), (7, [-9.0] * 5, 3, 1, "r", 2)]
    data = spark.createDataFrame(rows, VECTORS)
    want = brute_negatives([r[:3] for r in rows], lambda i: i % 9 == 0)
    assert len(want) > 300 and len({w[0] for w in want}) > 10
    mine = lambda: [tuple(r) for r in hard_negatives.hard_negatives(data, F.col("vec_id") % 9 == 0).collect()]
    found = mine()
    assert len(found) == len(set(found)) and set(found) == want
    # Small tiles and blocks of anchors, many tasks and batches: the same rows.
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 4)
    monkeypatch.setattr(hard_negatives, "TILE", 5)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        assert set(mine()) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hard_negatives_odd(spark):
    empty = spark.createDataFrame([], VECTORS)
    every = F.lit(True)
    assert hard_negatives.hard_negatives(empty, every).count() == 0
    alone = spark.createDataFrame([(1, [0.5], 1, 1, "r", 2), (2, [], 2, 1, "r", 2), (3, None, 1, 1, "r", 2)], VECTORS)
    assert hard_negatives.hard_negatives(alone, every).count() == 0
    assert hard_negatives.hard_negatives(alone, F.lit(False)).count() == 0
    # Scores that exceed 64 bits decide all the same; what fits no long is null.
    huge = [(i, [2.0**40 + i * 2.0**20, 1.0], i % 2, 1, "r", 2) for i in range(6)]
    found = hard_negatives.hard_negatives(spark.createDataFrame(huge, VECTORS), F.col("vec_id") == 0, high=110).collect()
    assert {r[:4] for r in found} == {w[:4] for w in brute_negatives([r[:3] for r in huge], lambda i: i == 0, high=110)}
    assert found and all(r.positive_score is None for r in found)


SPACE = re.compile(r"[\x20\x09-\x0d]+")


def brute_rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = [w for w in SPACE.split(text or "") if w]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {i + k for i in range(len(words) - 4) if seen[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if SPACE.sub("", x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)


def test_quality_rules(spark, odd_docs, odd_rows, no_docs):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abc") for _ in range(n)) for n in range(0, 40)]
    texts += ["one two three four five six " * 2, "a b c d e a b c d e", "x\n\nx\n x\n", "Ünï \x0b\x0c\r\n\t# * \U0001f600 <>|", "  no break"]
    rows = [*odd_rows, *enumerate(texts, 100), (200, " ".join(rng.choice("abcdefgh") for _ in range(60_000)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").select("*", F.lit(1).alias("words"), F.lit(2).alias("row"))
    found = quality_rules.judged(docs).select("row.doc_id", "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed").collect()
    same = Counter((r[0], r[1], *r[2:7]) for r in found) == Counter((i, t, *brute_rules(t)) for i, t in rows)
    assert same  # by itself: an account of the difference of long texts takes very long
    for r in found:
        assert ("few_words" in r.failed) == (r.n_words < 10)
        assert ("repeated_words" in r.failed) == (100 * r.n_repeat_words > 20 * r.n_words)
        assert ("symbols" in r.failed) == (10 * r.n_symbols > r.n_words)
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns and kept.count() == sum(not r.failed for r in found)
    assert quality_rules.judged(no_docs).count() == 0 == quality_rules.keep_good(no_docs).count()


def test_quality_plan_has_no_user_function(spark, no_docs):
    plan = quality_rules.keep_good(no_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    # The filter stands above the counts and does not repeat them.
    assert plan.count("xxhash64") == 1


def test_threshold_table(spark):
    """A table of one's own: open ends, both ends, and texts too short to be judged."""
    rules = (
        quality_rules.Threshold("short", "n_words", least=2), quality_rules.Threshold("shape", "mean_word", least=2, most=3),
        quality_rules.Threshold("plain", "stop_share", least=0.5, words=4),
    )
    docs = spark.createDataFrame([(1, "a"), (2, "ab abc"), (3, "abcd abcd"), (4, "the and xx yyy"), (5, "the xx xx xx"), (6, None)], "doc_id int, text string")
    found = {r.doc_id: r.failed for r in quality_rules.judged(docs, rules).select("row.doc_id", "failed").collect()}
    assert found == {1: ["short", "shape"], 2: [], 3: ["shape"], 4: [], 5: ["plain"], 6: ["short"]}
