"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import read_table

WINDOW = 5

# Frequent function words of English, German, French and Spanish, in lower case.
STOP_WORDS = (
    "the be to of and that have with a in is it for on as was are by this from or not "
    "der die das und in von den mit ist zu ein eine im für auf nicht dem des "
    "le la les de des du un une et est en que qui dans pour par au pas sur "
    "el la los las de del que y en un una es por con se para no"
).split()

_BLANK = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Threshold:
    """A text passes if least <= measure <= most (None: open); texts under `words` words are not judged."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    words: int = 0


# The production table. The first two rules are the base; the others give the verdict on what passes them.
BASE_RULES = (
    Threshold("few_words", "n_words", least=10),
    Threshold("repeated_words", "repeat_share", most=0.2),
)
RULES = BASE_RULES + (
    Threshold("word_length", "mean_word", least=2, most=20),
    Threshold("symbols", "symbol_share", most=0.1),
    Threshold("exclamations", "exclamation_share", most=0.3),
    Threshold("capitals", "capital_share", most=0.5),
    Threshold("stop_words", "stop_share", least=0.01, words=50),
    Threshold("duplicate_lines", "dup_line_share", most=0.5),
    Threshold("bullet_lines", "bullet_line_share", most=0.9),
    Threshold("cut_lines", "cut_line_share", most=0.5),
)


def _kept_length(text: Column, others: str) -> Column:
    """Code points left when runs of the others are taken out."""
    return F.length(F.regexp_replace(text, others, "")).cast("bigint")


def _settled(value: Column) -> Column:
    """The same value, made once where it stands.

    Spark moves a filter on a column below the projection that makes it, and copies the
    column's expression into the filter wherever it is named; with expressions upon
    expressions that multiplies. It leaves a column alone that looks nondeterministic.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def with_repeats(df: DataFrame, words: str, name: str, window: int = WINDOW) -> DataFrame:
    """`df` and a column `name`: how many of the words in the array column `words` lie in a window seen twice.

    Windows are told apart by a hash first; those whose hash comes twice are compared as
    text, so that the count is exact. A text without a repeated hash ends after that step.
    """
    hashes, ordered, again = f"{name}_hashes", f"{name}_ordered", f"{name}_again"
    none = F.array().cast("array<int>")
    hashed = F.transform(
        F.sequence(F.lit(0), F.size(words) - window), lambda i: F.xxhash64(*[F.get(words, i + n) for n in range(window)])
    )

    def twins(items: str, key: str) -> Column:
        beside = lambda at: F.get(F.col(items), at)[key]
        return F.filter(items, lambda x, at: (x[key] == beside(at - 1)) | (x[key] == beside(at + 1)))

    df = df.withColumn(hashes, F.when(F.size(words) > window, hashed))
    placed = F.sort_array(F.transform(hashes, lambda h, at: F.struct(h.alias("key"), at.alias("at"))))
    df = df.withColumn(ordered, F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), placed)).drop(hashes)
    texts = F.transform(
        twins(ordered, "key"),
        # Not slice(): it copies the whole array each time.
        lambda x: F.struct(
            F.concat_ws(" ", *[F.get(words, x["at"] + n) for n in range(window)]).alias("key"), x["at"].alias("at")
        ),
    )
    df = df.withColumn(again, F.sort_array(texts)).drop(ordered)
    places = F.sort_array(F.transform(twins(again, "key"), lambda x: x["at"]))
    covered = F.aggregate(
        F.coalesce(places, none), F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda s, at: F.struct(
            (at + window).alias("end"), (s["n"] + at + window - F.greatest(at, s["end"])).alias("n")
        ),
        lambda s: s["n"],
    )
    return df.withColumn(name, _settled(covered)).drop(again)


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Each row of `df` as the struct `row`, and the counts of its text beside it.

    Null is the empty text. The counts are columns, not a struct: so they are made once,
    however many rules read them.
    """
    df = df.select(F.struct("*").alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    df = df.withColumn("words", F.array_remove(F.split("text", f"{_BLANK}+"), ""))
    df = df.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(_WORD)))
    df = with_repeats(df, "words", "n_repeat_words")
    whole = F.col("text")
    forms = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})
    stop = F.filter("words", lambda w: w.isin(forms))
    counts = {
        "n_words": F.size("words").cast("bigint"), "word_chars": F.length(F.array_join("words", "")).cast("bigint"),
        "n_symbols": _kept_length(whole, "[^#*$%&|<>]+"), "n_exclamations": _kept_length(whole, "[^!]+"),
        "n_capitals": _kept_length(whole, r"[^\p{Lu}]+"),
        "n_stop_words": F.size(stop).cast("bigint"), "n_lines": F.size("lines").cast("bigint"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint"),
        "n_bullet_lines": F.size(F.filter("lines", lambda x: x.rlike(r"^\s*[-*•] "))).cast("bigint"),
        "n_cut_lines": F.size(F.filter("lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))).cast("bigint"),
        "n_repeat_words": F.col("n_repeat_words"),
    }
    return df.select("row", *[c.alias(n) for n, c in counts.items()])


# Measure of a threshold: numerator and denominator among the counts.
RATIOS = {
    "repeat_share": ("n_repeat_words", "n_words"),
    "mean_word": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "n_words"),
    "exclamation_share": ("n_exclamations", "n_words"),
    "capital_share": ("n_capitals", "word_chars"),
    "stop_share": ("n_stop_words", "n_words"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "bullet_line_share": ("n_bullet_lines", "n_lines"),
    "cut_line_share": ("n_cut_lines", "n_lines"),
}


def fails(rule: Threshold) -> Column:
    """Whether a row breaks the rule. Ratios are compared by products of whole numbers of thousandths."""
    above, below = RATIOS.get(rule.measure, (rule.measure, None))
    value, unit = F.col(above) * 1000, F.col(below) if below else F.lit(1)
    broken = [value < unit * round(rule.least * 1000)] if rule.least is not None else []
    broken += [value > unit * round(rule.most * 1000)] if rule.most is not None else []
    any_broken = reduce(lambda a, b: a | b, broken, F.lit(False))
    return any_broken & (F.col("n_words") >= rule.words) if rule.words else any_broken


def compiled(rules=RULES) -> Column:
    """The names of the rules a row breaks, in table order, as one expression over the counts."""
    return F.array_compact(F.array(*[F.when(fails(r), F.lit(r.name)) for r in rules]))


def judged(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """Each row as the struct `row`, the counts of its text, and in `failed` the names of the rules it breaks.

    Each row is judged on its own, wherever it lies: nothing is shuffled, repeated rows get
    equal verdicts, and the columns of `docs` may have any name. Null, empty and blank texts
    have no word and break `few_words`; whole texts are read, of any length.
    """
    return measured(docs, text).withColumn("failed", _settled(compiled(rules)))


def keep_good(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows that break no rule, with their own columns."""
    return judged(docs, rules).where(F.size("failed") == 0).select("row.*")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.array(*[F.lit(r.name) for r in BASE_RULES])
    return found.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.arrays_overlap("failed", base).alias("base_failed"), (F.size("failed") == 0).alias("kept"),
        F.array_join("failed", ",").alias("failed_rules"),
    )


# Written apart from the table above: thresholds are stated here as literals.
OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
u AS (SELECT rid, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
v AS (
  SELECT rid, i, word, CASE WHEN lead(i, 4) OVER o IS NOT NULL THEN concat_ws(' ', word, lead(word, 1) OVER o,
    lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) END AS five
  FROM u WINDOW o AS (PARTITION BY rid ORDER BY i)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, five) AS n FROM v WHERE five IS NOT NULL) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) AS r(k) GROUP BY rid),
word_sums AS (
  SELECT rid, count(*) AS n_words, sum(length(word)) AS word_chars,
    count(*) FILTER (word IN (lower(word), upper(word), upper(word[1]) || lower(word[2:])) AND lower(word) IN ('the','be','to','of','and','that','have','with','a','in','is','it',
      'for','on','as','was','are','by','this','from','or','not','der','die','das','und','von','den','mit','ist','zu','ein',
      'eine','im','für','auf','nicht','dem','des','le','la','les','de','du','un','une','et','est','en','que','qui','dans',
      'pour','par','au','pas','sur','el','los','las','del','y','una','es','por','con','se','para','no')) AS n_stop
  FROM u GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
line_sums AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
    count(*) FILTER (regexp_matches(line, '^\s*[-*•] ')) AS n_bullets,
    count(*) FILTER (regexp_matches(line, '(\.\.\.|…)\s*$')) AS n_cut
  FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, n_bullets, n_cut, n_stop,
    length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks,
    length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) AS n_capitals
  FROM d LEFT JOIN word_sums USING (rid) LEFT JOIN line_sums USING (rid) LEFT JOIN covered USING (rid)),
judged AS (
  SELECT *, n_words < 10 AS r1, 5 * n_repeat_words > n_words AS r2, word_chars < 2 * n_words OR word_chars > 20 * n_words AS r3,
    10 * n_symbols > n_words AS r4, 10 * n_marks > 3 * n_words AS r5, 2 * n_capitals > word_chars AS r6,
    n_words >= 50 AND 100 * coalesce(n_stop, 0) < n_words AS r7,
    2 * n_dup_lines > n_lines AS r8, 10 * coalesce(n_bullets, 0) > 9 * n_lines AS r9, 2 * coalesce(n_cut, 0) > n_lines AS r10 FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 OR r2 AS base_failed,
  NOT (r1 OR r2 OR r3 OR r4 OR r5 OR r6 OR r7 OR r8 OR r9 OR r10) AS kept,
  concat_ws(',', CASE WHEN r1 THEN 'few_words' END, CASE WHEN r2 THEN 'repeated_words' END, CASE WHEN r3 THEN 'word_length' END,
    CASE WHEN r4 THEN 'symbols' END, CASE WHEN r5 THEN 'exclamations' END, CASE WHEN r6 THEN 'capitals' END,
    CASE WHEN r7 THEN 'stop_words' END, CASE WHEN r8 THEN 'duplicate_lines' END, CASE WHEN r9 THEN 'bullet_lines' END,
    CASE WHEN r10 THEN 'cut_lines' END) AS failed_rules
FROM judged
"""
