"""Secret scans over an incremental ledger of content-addressed blobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..session import StagingArea
from .common import read_table, scratch


@dataclass(frozen=True)
class Rule:
    """`group` must have `least` characters or more; shorter matches are dropped after matching."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


# The kinds in the order in which spans of one start are listed.
RULES = (
    Rule(
        "assign", 1,
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    # A run of 24 or more starts where any run of hex digits there starts.
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("repository", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
BASE = ("assign", "access", "hex")

_SPANS = "array<struct<start:int,end:int>>"


def spans(text: Column, rule: Rule) -> Column:
    """Start and end (exclusive) code points of a rule's matches, left to right, none overlapping.

    What lies between the matches and the matches themselves, in turn, give the places.
    """
    pattern = F.lit(rule.pattern)
    none = F.array().cast(_SPANS)
    parts = F.arrays_zip(
        F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, pattern, 0).alias("hit"),
        F.regexp_extract_all(text, pattern, rule.group).alias("value"),
    )
    zero = F.struct(F.lit(0).alias("at"), none.alias("found"))

    def step(state, part):
        start = state["at"] + F.length(part["gap"])
        end = start + F.coalesce(F.length(part["hit"]), F.lit(0))
        span = F.array(F.struct(start.alias("start"), end.alias("end"))).cast(_SPANS)
        long = F.coalesce(F.length(part["value"]) >= rule.least, F.lit(False))
        return F.struct(end.alias("at"), F.when(long, F.concat(state["found"], span)).otherwise(state["found"]).alias("found"))

    return F.when(text.rlike(rule.pattern), F.aggregate(parts, zero, step, lambda s: s["found"])).otherwise(none)


class Ledger:
    """Which blobs were scanned by which rule versions, and what they hold.

    A blob is a text, addressed by its SHA-256. Rows: blob, kind, version, spans (empty
    where nothing was found). Scans append to it, each as its own files; a scan that fails
    leaves nothing that counts, and is run again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def read(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(self.path)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
                return None
            raise

    def scan(self, versions: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> None:
        """Scan the texts of `versions`, all historical ones, where blob and rule version are unseen.

        Copies of a text are dropped in each task before the shuffle and scanned once.
        """
        named = versions.select(F.coalesce(F.col(text), F.lit("")).alias("body"))
        blobs = named.select(F.sha2("body", 256).alias("blob"), "body")
        wanted = [f"{r.kind}/{r.version}" for r in rules]
        seen = self.read()
        if seen is None:
            fresh = blobs.withColumn("done", F.array().cast("array<string>"))
        else:
            pair = F.concat_ws("/", "kind", "version")
            done = seen.where(pair.isin(wanted)).groupBy(F.col("blob").alias("done_blob")).agg(F.collect_set(pair).alias("done"))
            joined = blobs.join(done, F.col("blob") == F.col("done_blob"), "left")
            fresh = joined.select("blob", "body", F.coalesce("done", F.array().cast("array<string>")).alias("done")).where(
                F.size("done") < len(wanted)
            )
        once = fresh.groupBy("blob").agg(F.first("body").alias("body"), F.first("done").alias("done"))
        rows = [
            F.when(
                ~F.array_contains("done", name),
                F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version"), spans(F.col("body"), r).alias("spans")),
            )
            for r, name in zip(rules, wanted)
        ]
        found = once.select("blob", F.explode(F.array_compact(F.array(*rows))).alias("row")).select("blob", "row.*")
        found.write.mode("append").parquet(self.path)

    def findings(self, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """blob and found: its spans (start, rank, end) by start, then by the rule's place in the list.

        One row a blob; a blob has as many rows in the ledger as there are rules at most.
        """
        rank = F.lit(None).cast("int")
        for i, r in enumerate(rules):
            rank = F.when((F.col("kind") == r.kind) & (F.col("version") == r.version), i).otherwise(rank)
        rows = self.read().withColumn("rank", rank).where("rank is not null and size(spans) > 0")
        ranked = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("rank").alias("rank"), s["end"].alias("end")))
        return rows.select("blob", ranked.alias("found")).groupBy("blob").agg(
            F.sort_array(F.flatten(F.collect_list("found"))).alias("found")
        )


def scan_documents(docs: DataFrame, area: StagingArea | None = None, ledger: Ledger | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, blob and found of every row of `docs`: findings are joined back to each path of a blob.

    Null is the empty text, which has no findings (an empty list). Repeated rows are
    repeated; other columns are ignored.
    """
    spark = docs.sparkSession
    ledger = ledger or Ledger(spark, scratch(spark, area).path("ledger"))
    ledger.scan(docs.select("text"), rules=rules)
    found = ledger.findings(rules).select(F.col("blob").alias("found_blob"), "found")
    paths = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("blob"))
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    return paths.join(found, F.col("blob") == F.col("found_blob"), "left").select(
        "doc_id", "blob", F.coalesce("found", none).alias("found")
    )


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_documents(read_table(spark, sf_dir, "documents"))
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: F.get(kinds, s["rank"]) == kind)).cast("bigint")
    base = F.filter("found", lambda s: s["rank"] < len(BASE))
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(base), 256).alias("base_sha256"), written("found").alias("spans"), "blob",
    )
