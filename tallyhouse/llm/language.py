"""Language identification by unigram pieces, summed over every segmentation."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.functions import pandas_udf

from ..session import StagingArea
from .bpe import encoder
from .common import broadcast_if_small, python_ready, read_table, scratch

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
TRAINING_DOCS = 2000
# Rows ranked for a sample row: the share of the hash range that is ranked holds this many times the sample.
MARGIN = 4
ROUNDS = 2
SMOOTHING = 0.1
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
# Words scored are remembered up to about this many bytes in a Python worker.
_CACHED_BYTES = 32 << 20
_WORD_BYTES = 200
# Words counted before they are handed on, by number and by letters.
_COUNTED_WORDS, _COUNTED_LETTERS = 400_000, 8_000_000
_SHORT = 32
# A longer run of letters is learned in parts of this many.
_PART = 128
# A found piece is its number times _SIZES plus its length; no piece is that long.
_SIZES = 1 << 16


def read_pieces(path: str = VOCABULARY) -> list[str]:
    """The text pieces of a sentencepiece model, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return sorted(
        {
            model.id_to_piece(i)
            for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        }
    )


def words_of(text: str) -> list[str]:
    """Runs of letters, in small letters, each marked as a word start."""
    return ["▁" + w for w in _LETTERS.findall(text.lower())]


def training_words(text: str) -> Iterator[str]:
    """The words of a text; a run of more than `_PART` letters in consecutive parts, so that none is left out."""
    for word in words_of(text):
        if len(word) <= _PART:
            yield word
        else:
            yield from (word[i : i + _PART] for i in range(0, len(word), _PART))


class Scorer:
    """Log likelihood of words under each language, by the forward algorithm.

    `table` has a row of probabilities per piece (a column per language) and a last row of
    zeros. A single character outside the vocabulary counts as `rare`.
    """

    def __init__(self, pieces: list[str], table: np.ndarray, rare: float):
        self.index = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.table = np.vstack([table, np.zeros((1, table.shape[1])), np.full((1, table.shape[1]), rare)])
        self.none, self.rare = len(pieces), len(pieces) + 1
        self.pieces = pieces
        self.finder = ahocorasick.Automaton()
        for i, p in enumerate(pieces):
            self.finder.add_word(p, i * _SIZES + len(p))
        self.finder.make_automaton()
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.held = 0
        self.rows = np.zeros((1024, self.table.shape[1]))

    def _same_length(self, words: list[str], length: int) -> np.ndarray:
        """Words of one length, joined so that the automaton finds the pieces of all in one walk."""
        forward = np.zeros((length + 1, len(words), self.table.shape[1]))
        forward[0] = 1
        step = length + 1
        matches = self.finder.iter("\n".join(words)) if self.pieces else ()
        ends, values = np.fromiter(itertools.chain.from_iterable(matches), np.int64).reshape(-1, 2).T
        word, end = ends // step, ends % step + 1
        size, ids = values % _SIZES, values // _SIZES
        inside = end <= length
        single = inside & (size == 1)
        alone = np.full((length, len(words)), self.rare)
        alone[end[single] - 1, word[single]] = ids[single]
        # In the order of end, then start, each run holds a word once.
        several = np.flatnonzero(inside & (size > 1))
        place = end[several] * step + end[several] - size[several]
        several = several[np.argsort(place, kind="stable")]
        bounds = np.searchsorted(np.sort(place), np.arange(step * step + 1))
        for at_end in range(1, step):
            for start in range(max(0, at_end - self.longest), at_end - 1):
                run = several[bounds[at_end * step + start] : bounds[at_end * step + start + 1]]
                if len(run):
                    forward[at_end, word[run]] += forward[start, word[run]] * self.table[ids[run]]
            forward[at_end] += forward[at_end - 1] * self.table[alone[at_end - 1]]
        return np.log(forward[length])

    def _long(self, word: str) -> np.ndarray:
        """The same for a long word, scaled at each step; keeps only the last few steps."""
        steps = [(np.ones(self.table.shape[1]), 0.0)]
        for end in range(1, len(word) + 1):
            first = max(0, end - self.longest)
            base = steps[0][1] if first == end - len(steps) else steps[first - (end - len(steps))][1]
            total = np.zeros(self.table.shape[1])
            for start in range(first, end):
                at = self.index.get(word[start:end], self.rare if end - start == 1 else self.none)
                if at != self.none:
                    value, scale = steps[start - (end - len(steps))]
                    total += value * self.table[at] * np.exp(scale - base)
            high = total.max()
            steps.append((total / high, base + np.log(high)))
            if len(steps) > self.longest:
                steps.pop(0)
        value, scale = steps[-1]
        return np.log(np.maximum(value, 1e-300)) + scale

    def learn(self, words: set[str]) -> None:
        fresh = [w for w in words if w not in self.known]
        size = sum(_WORD_BYTES + 2 * len(w) + 8 * self.table.shape[1] for w in fresh)
        if self.held + size > _CACHED_BYTES:
            self._clear()
            fresh = list(words)
            size = sum(_WORD_BYTES + 2 * len(w) + 8 * self.table.shape[1] for w in fresh)
        self.held += size
        need = len(self.known) + len(fresh)
        if need > len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros((max(need, len(self.rows)), self.rows.shape[1]))])
        lengths = defaultdict(list)
        for w in fresh:
            lengths[len(w)].append(w)
        at = len(self.known)
        for n, group in sorted(lengths.items()):
            for i in range(0, len(group), 4096):
                part = group[i : i + 4096]
                found = self._same_length(part, n) if n <= _SHORT else np.array([self._long(w) for w in part])
                self.rows[at : at + len(part)] = found
                self.known.update(zip(part, range(at, at + len(part))))
                at += len(part)

    def score(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Per text the log likelihoods, or None where it has no letter."""
        split = [words_of(t) if t else [] for t in texts]
        self.learn(set().union(*split))
        known = self.known.__getitem__
        return [self.rows[np.fromiter(map(known, w), np.int64, len(w))].sum(axis=0) if w else None for w in split]


def portions(texts: list, most: int = 2_000_000) -> Iterator[list]:
    """Runs of texts of about `most` characters; a longer text is a run by itself."""
    part, size = [], 0
    for t in texts:
        part.append(t)
        size += len(t or "")
        if size >= most:
            yield part
            part, size = [], 0
    if part:
        yield part


def _added(logs: list[float]) -> float:
    """The logarithm of a sum, from those of its terms."""
    high = max(logs, default=-math.inf)
    return high if high == -math.inf else high + math.log(sum(math.exp(x - high) for x in logs))


def expected_pieces(word: str, index: dict[str, int], longest: int, chance: np.ndarray) -> dict[int, float]:
    """How often each piece is expected in a word, over all of its segmentations.

    Products over a long word leave the range of a double, so those are kept as logarithms.
    """
    n = len(word)
    edges = [
        (s, e, i)
        for e in range(1, n + 1)
        for s in range(max(0, e - longest), e)
        if (i := index.get(word[s:e], -1 if e - s == 1 else None)) is not None
    ]
    rare = float(chance.min())
    found: dict[int, float] = defaultdict(float)
    weighted = [(s, e, i, float(chance[i]) if i >= 0 else rare) for s, e, i in edges]
    if n > _SHORT:
        into, out = defaultdict(list), defaultdict(list)
        for s, e, i, p in weighted:
            if p > 0:
                into[e].append((s, math.log(p)))
                out[s].append((e, math.log(p)))
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for e in range(1, n + 1):
            ahead[e] = _added([ahead[s] + p for s, p in into[e]])
        for s in range(n - 1, -1, -1):
            behind[s] = _added([behind[e] + p for e, p in out[s]])
        if ahead[n] > -math.inf:
            for s, e, i, p in weighted:
                if i >= 0 and p > 0:
                    found[i] += math.exp(ahead[s] + math.log(p) + behind[e] - ahead[n])
        return found
    forward, backward = [0.0] * (n + 1), [0.0] * (n + 1)
    forward[0] = backward[n] = 1.0
    for s, e, _, p in weighted:
        forward[e] += forward[s] * p
    for s, e, _, p in reversed(weighted):
        backward[s] += backward[e] * p
    if forward[n] > 0:
        for s, e, i, p in weighted:
            if i >= 0:
                found[i] += forward[s] * p * backward[e] / forward[n]
    return found


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    letters = 0

    def flush():
        rows = list(counts.items())
        counts.clear()
        return pa.RecordBatch.from_pydict(
            {
                "lang": pa.array([k[0] for k, _ in rows], pa.string()),
                "word": pa.array([k[1] for k, _ in rows], pa.string()),
                "n": pa.array([n for _, n in rows], pa.int64()),
            }
        )

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            counts.update((lang, w) for w in training_words(text))
            letters += len(text)
            if len(counts) > _COUNTED_WORDS or letters > _COUNTED_LETTERS:
                yield flush()
                letters = 0
    yield flush()


def _place():
    return F.xxhash64("doc_id", "text").alias("h")


def sample_rows(docs: DataFrame, per_language: int, area: StagingArea) -> DataFrame:
    """label and place of the first `per_language` rows of each language, by the hash of id and text, equal rows once.

    How many different rows a language has, to some hundredths, tells how much of the hash range
    holds `MARGIN` times the sample; only rows in there are made distinct and ranked, some
    thousands for a language of any size.
    """
    placed = docs.where("text is not null and lang is not null").select(F.col("lang").alias("label"), _place())
    sizes = area.stage(placed.groupBy(F.col("label").alias("of")).agg(F.approx_count_distinct("h").alias("n")), "sizes")
    share = (F.col("h").cast("double") + 2.0**63) / 2.0**64
    near = placed.join(broadcast_if_small(sizes), F.col("label") == F.col("of")).where(share * F.col("n") <= MARGIN * per_language)
    order = Window.partitionBy("label").orderBy("h")
    ranked = near.select("label", "h").distinct().withColumn("nth", F.row_number().over(order))
    return ranked.where(F.col("nth") <= per_language).select("label", F.col("h").alias("place"))


def train(docs: DataFrame, path: str = VOCABULARY, per_language: int = TRAINING_DOCS, area: StagingArea | None = None):
    """(languages, pieces, table): piece probabilities per language, or None without a labelled row.

    Learns from `docs` (doc_id, text, lang) with neither text nor lang null: the
    `per_language` documents of each language that come first by the hash of id and text,
    equal rows once, so the sample is bounded. Word counts are summed in Spark; each round of expectation and
    maximisation spreads the distinct words over the tasks and sums the expected piece
    counts, at most one per piece and language.
    """
    spark = docs.sparkSession
    python_ready(spark)
    area = scratch(spark, area)
    sample = area.stage(sample_rows(docs, per_language, area), "sample")
    rows = docs.where("text is not null and lang is not null").select("lang", "text", _place())
    picked = rows.join(broadcast_if_small(sample), (F.col("h") == F.col("place")) & (F.col("lang") == F.col("label")))
    picked = picked.groupBy("lang", "h").agg(F.first("text").alias("text"))
    counted = picked.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n bigint")
    words = area.stage(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    languages = sorted(r[0] for r in words.select("lang").distinct().collect())
    if not languages:
        return None
    pieces = read_pieces(path)
    table = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    column = {lang: i for i, lang in enumerate(languages)}
    for _ in range(ROUNDS):
        now = spark.sparkContext.broadcast((pieces, table))

        def expect(batches, now=now):
            names, chances = now.value
            index, longest = {p: i for i, p in enumerate(names)}, max(map(len, names))
            totals: dict = defaultdict(float)
            for batch in batches:
                for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                    at = column[lang]
                    for i, x in expected_pieces(word, index, longest, chances[:, at]).items():
                        totals[at, i] += n * x
            yield pa.RecordBatch.from_pydict(
                {
                    "language": pa.array([k[0] for k in totals], pa.int32()),
                    "piece": pa.array([k[1] for k in totals], pa.int32()),
                    "n": pa.array(list(totals.values()), pa.float64()),
                }
            )

        spread = words.repartition(spark.sparkContext.defaultParallelism * 2, "word")
        sums = spread.mapInArrow(expect, "language int, piece int, n double")
        found = sums.groupBy("language", "piece").agg(F.sum("n").alias("n")).toPandas()
        table = np.full((len(pieces), len(languages)), SMOOTHING)
        table[found["piece"], found["language"]] += found["n"]
        table /= table.sum(axis=0)
        now.unpersist()
    return languages, pieces, table


def predictor(spark: SparkSession, model):
    """A column function text -> struct(lang, score); score is the language's share of the likelihood."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        # Workers are used again: the encoder's tables and memory, left by a BPE step before, would stand beside the scorer's.
        encoder.cache_clear()
        if shared.value is not None:
            languages, pieces, table = shared.value
            scorer = Scorer(pieces, table, float(table.min()))
        for texts in batches:
            names, scores = [], []
            for part in portions(list(texts)):
                for found in scorer.score(part) if shared.value is not None else [None] * len(part):
                    if found is None:
                        names.append(UNKNOWN)
                        scores.append(0.0)
                    else:
                        share = np.exp(found - found.max())
                        best = int(share.argmax())
                        names.append(languages[best])
                        scores.append(float(min(1.0, share[best] / share.sum())))
            yield pd.DataFrame({"lang": names, "score": scores})

    return predict


def identify(docs: DataFrame, training: DataFrame, area: StagingArea | None = None) -> DataFrame:
    """doc_id, lang_pred and score of every row of `docs`, learned from `training` (doc_id, text, lang).

    Null, empty and letterless texts are `und` with score 0, and so is every text if nothing
    can be learned. Equal likelihoods go to the language first by name. Repeated rows are
    repeated; whole texts are read.
    """
    model = train(training, area=area)
    predict = predictor(docs.sparkSession, model)
    return docs.select("doc_id", predict("text").alias("found")).select(
        "doc_id", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def keep_identified(docs: DataFrame, least: float = 0.5, area: StagingArea | None = None) -> DataFrame:
    """The rows of `docs` whose language is known with a score of `least` or more, unchanged.

    Null, empty and letterless texts go; repeated rows stay repeated, other columns are carried along.
    """
    predict = predictor(docs.sparkSession, train(training_rows(docs), area=area))
    # A name that no column has, so that the row need not be packed, its text held twice, beside the text that is read.
    taken = {c.lower() for c in docs.columns}
    found = next(name for n in itertools.count() if (name := f"found_{n}") not in taken)
    marked = docs.withColumn(found, predict("text"))
    return marked.where((F.col(found)["lang"] != UNKNOWN) & (F.col(found)["score"] >= least)).drop(found)


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(~held_out()).select("doc_id", "text", "lang")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = identify(docs, training_rows(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
