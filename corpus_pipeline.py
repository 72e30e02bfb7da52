"""Training-corpus pipeline over `documents`: each stage is written as Parquet and reread by the next.

Stages, in order: language ID (texts without a known language go), line dedup (repeated
lines go, and documents left without a word), SimHash near-dedup (one document of each
group stays), benchmark decontamination (contaminated documents go), byte-level BPE
(documents as token ids, with the digests of ids and decoded bytes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.llm.bpe import encode_documents
from tallyhouse.llm.common import read_table, release
from tallyhouse.llm.decontamination import drop_contaminated
from tallyhouse.llm.language import keep_identified
from tallyhouse.llm.lines import drop_repeated_lines
from tallyhouse.llm.simhash import drop_near_duplicates
from tallyhouse.session import StagingArea

# Whole texts go to Python in Arrow batches of so many rows at most. With Spark's 10,000 a batch of texts, its buffers
# in the JVM and its strings in the worker take some hundred MB of each core that is beside the heap.
BATCH_ROWS = 1000

_areas: dict[str, StagingArea] = {}


def _area(spark: SparkSession) -> StagingArea:
    """Scratch tables of the stage that begins; those of the stage before, now written, go."""
    key = spark.sparkContext.applicationId
    if key in _areas:
        _areas.pop(key).clear()
        release(spark)
    _areas[key] = StagingArea(spark)
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return _areas[key]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, area=_area(spark))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_repeated_lines(docs, _area(spark))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs, _area(spark))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"), _area(spark))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _area(spark)
    return encode_documents(docs, with_ids=True)


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("byte_bpe", encode),
]

# Language scores, XXH64 and BPE have no SQL; a brute-force version checks the rows in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows: doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    docs = read_table(spark, sf_dir, "documents")
    written = StagingArea(spark)
    for name, stage in STAGES:
        docs = written.stage(stage(spark, docs, sf_dir), name)
    return docs
