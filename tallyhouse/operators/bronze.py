"""Bronze: source lines as text, with lineage, audit columns and a record hash."""

from __future__ import annotations

import getpass
import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import record_hash
from ..schemas import HEADER_NAMES, SOURCE_COLUMNS
from ..sources.readers import BAD_RECORD, FILE_COLUMNS, SOURCE_BLOCK, SOURCE_ROW

POSITION = (SOURCE_BLOCK, SOURCE_ROW)


@dataclass(frozen=True)
class LoadBatch:
    """One load run. Its clock and id are fixed here, so re-running a plan cannot change them."""

    started_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    batch_id: str = ""
    source_system: str = "UCI_ML_REPO"
    created_by: str = field(default_factory=getpass.getuser)

    def __post_init__(self):
        if not self.batch_id:
            stamp = self.started_at.strftime("%Y%m%d_%H%M%S")
            object.__setattr__(self, "batch_id", f"BATCH_{stamp}_{uuid.uuid4().hex[:8]}")

    @property
    def process_id(self) -> str:
        return f"BRONZE_INGESTION_{self.batch_id}"


def rename_headers(df: DataFrame) -> DataFrame:
    """Known header spellings, in any case, to snake_case names."""
    renames = {c: HEADER_NAMES[c.lower()] for c in df.columns if c.lower() in HEADER_NAMES}
    return df.withColumnsRenamed(renames)


def as_text(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The eight source columns as text, absent ones as NULL, plus the `keep` columns."""
    present = set(df.columns)
    source: list[Column] = [
        (F.col(c) if c in present else F.lit(None)).cast("string").alias(c) for c in SOURCE_COLUMNS
    ]
    return df.select(*source, *[F.col(c) for c in keep if c in present])


def with_record_hash(df: DataFrame) -> DataFrame:
    return df.withColumn("record_hash", record_hash(SOURCE_COLUMNS))


def to_bronze(df: DataFrame, batch: LoadBatch) -> DataFrame:
    """Rows of `read_source` or `read_lines` as bronze rows; malformed ones are left to `to_rejects`.

    bronze_id is the batch id with Spark's task-and-row number, in as many digits as any has,
    so that ids of a batch sort as numbers do: unique inside the job that writes the batch,
    needs no shuffle, and is fixed once that job has committed.
    """
    run_time = F.lit(batch.started_at).cast("timestamp")
    text = as_text(rename_headers(df), keep=("source_file_name", "source_file_path", *POSITION, BAD_RECORD))
    number = F.lpad(F.monotonically_increasing_id().cast("string"), 19, "0")
    numbered = with_record_hash(text).withColumn("bronze_id", F.concat_ws("-", F.lit(batch.batch_id), number))
    if BAD_RECORD in text.columns:
        numbered = numbered.where(F.col(BAD_RECORD).isNull())
    return numbered.select(
        "bronze_id",
        *SOURCE_COLUMNS,
        "source_file_name",
        "source_file_path",
        *[c for c in POSITION if c in text.columns],
        F.lit(batch.source_system).alias("source_system"),
        run_time.alias("load_timestamp"),
        F.lit(batch.process_id).alias("ingestion_process_id"),
        "record_hash",
        F.lit(False).alias("is_deleted"),
        F.lit(batch.created_by).alias("created_by"),
        run_time.alias("created_at"),
        F.lit(batch.started_at.date()).alias("load_date"),
        F.lit(batch.batch_id).alias("load_batch_id"),
    )


def to_rejects(df: DataFrame, batch: LoadBatch) -> DataFrame:
    """The malformed rows of `read_lines`, whole, with what was read of their fields, file, place and reason."""
    fields = [c for c in df.columns if c not in (*FILE_COLUMNS, *POSITION, BAD_RECORD)]
    return df.where(F.col(BAD_RECORD).isNotNull()).select(
        F.col(BAD_RECORD).alias("raw_record"),
        F.to_json(F.struct(*fields)).alias("fields_read"),
        F.lit(f"not {len(fields)} fields").alias("reject_reason"),
        "source_file_name",
        "source_file_path",
        *POSITION,
        F.lit(batch.started_at).cast("timestamp").alias("load_timestamp"),
        F.lit(batch.started_at.date()).alias("load_date"),
        F.lit(batch.batch_id).alias("load_batch_id"),
    )


def duplicate_hashes(bronze: DataFrame) -> DataFrame:
    """Record hashes that occur more than once, with their number of copies."""
    return (
        bronze.groupBy("record_hash")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def dedupe_records(bronze: DataFrame) -> DataFrame:
    """The earliest-loaded row of every record hash.

    Spark cuts each task's rows to one per hash before the shuffle, so a record with very
    many copies sends at most one row per task.
    """
    first = Window.partitionBy("record_hash").orderBy("load_timestamp", "bronze_id")
    return bronze.withColumn("_copy", F.row_number().over(first)).where(F.col("_copy") == 1).drop("_copy")


def load_log_entry(spark, batch: LoadBatch, state: str, **values) -> DataFrame:
    """One state change of a batch, for the append-only ingestion log."""
    columns = {
        "batch_id": (batch.batch_id, "string"),
        "event_time": (values.get("event_time", batch.started_at), "timestamp"),
        "source_file_name": (values.get("source_file_name"), "string"),
        "source_file_path": (values.get("source_file_path"), "string"),
        "ingestion_start_time": (batch.started_at, "timestamp"),
        "ingestion_end_time": (values.get("ingestion_end_time"), "timestamp"),
        "status": (state, "string"),
        "records_processed": (values.get("records_processed"), "bigint"),
        "records_inserted": (values.get("records_inserted"), "bigint"),
        "records_failed": (values.get("records_failed"), "bigint"),
        "error_message": (values.get("error_message"), "string"),
        "ingestion_duration_seconds": (values.get("ingestion_duration_seconds"), "double"),
        "created_by": (batch.created_by, "string"),
    }
    return spark.range(1).select(*[F.lit(v).cast(t).alias(c) for c, (v, t) in columns.items()])


def current_log(log: DataFrame) -> DataFrame:
    """The latest state of every batch."""
    latest = F.max_by(F.struct(*[c for c in log.columns if c != "batch_id"]), "event_time")
    return log.groupBy("batch_id").agg(latest.alias("_state")).select("batch_id", "_state.*")


def latest_success(log: DataFrame) -> DataFrame:
    """The batch id of the newest successful load, as one row."""
    done = current_log(log).where(F.col("status") == "SUCCESS")
    return done.agg(F.max_by("batch_id", F.struct("ingestion_start_time", "batch_id")).alias("batch_id"))
