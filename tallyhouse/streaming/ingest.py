"""New source files into bronze as a stream that runs until it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..operators.bronze import as_text, rename_headers, with_record_hash


def bronze_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    repeat_window: str = "7 days",
    many_copies: bool = True,
) -> DataFrame:
    """Lines of new files as text with their hash, a hash repeated within the window once.

    The event time is the time of loading, so no line is ever too late. Repeats are dropped
    first per reading task and then overall: a record with very many copies is spread over
    tasks by the first step, and only one copy per task reaches the second. Without
    `many_copies` the first step, a shuffle of all lines, is left out: the lines are the same, and the
    copies of a record meet in one task, one after the other, which keeps no more than their hash.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    lines = with_record_hash(as_text(rename_headers(reader.load(path))))
    # Lines are shuffled and hashes remembered with the hash in 16 bytes in place of 32 letters.
    packed = lines.withColumn("record_hash", F.unhex("record_hash"))
    timed = packed.withColumn("load_timestamp", F.current_timestamp()).withWatermark("load_timestamp", repeat_window)
    if many_copies:
        timed = timed.withColumn("_task", F.spark_partition_id())
        timed = timed.dropDuplicatesWithinWatermark(["record_hash", "_task"]).drop("_task")
    once = timed.dropDuplicatesWithinWatermark(["record_hash"])
    return once.withColumn("record_hash", F.lower(F.hex("record_hash")))


def land_stream(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    after_batch: Callable[[DataFrame, int], None] | None = None,
) -> None:
    """Write all available input to a parquet folder, one partition per micro-batch.

    A micro-batch that is run again after a failure replaces its own partition, so each
    line lands once. `after_batch` gets the rows as landed, for an upsert of the next layer.
    """

    def land(batch: DataFrame, batch_number: int) -> None:
        partition = f"{target}/load_batch_id=STREAM_{batch_number:08d}"
        batch.write.mode("overwrite").option("compression", "zstd").parquet(partition)
        if after_batch:
            after_batch(batch.sparkSession.read.parquet(partition), batch_number)

    # Extra micro-batches without data would only clear old state, which the next one does too.
    settings, idle = stream.sparkSession.conf, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = settings.get(idle)
    settings.set(idle, "false")
    try:
        query = (
            stream.writeStream.foreachBatch(land)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        settings.set(idle, before)
    query.awaitTermination()
