"""Streams: raw messages to validated and dead-letter tables, and on to Bronze.

Offsets and state live in each query's checkpoint. A batch that is run again after a
lost executor or driver finds its finished folders and leaves them, or replaces
unfinished ones. Nothing is lost; topics, and a folder read while its commit was cut
short, may repeat rows, which Silver's dedup removes.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from lakesearch.operators.validate import dead_letter_messages, dead_letters, valid_rows, validate
from lakesearch.schemas import RAW_MESSAGE, STORY_EVENT, STORY_FIELDS
from lakesearch.sources.bronze import append_bronze, with_bronze_columns
from lakesearch.sources.files import Files
from lakesearch.sources.kafka import DLQ_TOPIC, VALIDATED_TOPIC, messages, read_topic, sink_options

# Flush after so many rows or so long, whichever comes first.
FLUSH_ROWS = 50
FLUSH_SECONDS = 30

#: How often a topic with a row limit is asked whether enough rows wait.
POLL_SECONDS = 1


def read_validated_topic(spark: SparkSession, servers: str, rows: int = FLUSH_ROWS, seconds: int = FLUSH_SECONDS) -> DataFrame:
    """Validated messages for Bronze: a flush begins with `rows` waiting or after `seconds`.

    For `start_bronze_writer(..., seconds=POLL_SECONDS)`: the source itself keeps the two limits.
    """
    return read_topic(spark, servers, VALIDATED_TOPIC, flush_rows=rows, flush_seconds=seconds)


def read_text_folder(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of raw messages from text files, one JSON object a line, without keys."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path).select(F.lit(None).cast("string").alias("key"), "value")


def read_message_folder(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of keyed messages from Parquet files written by another stream."""
    reader = spark.readStream.format("parquet").schema(RAW_MESSAGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.load(path)


def trigger(writer: DataStreamWriter, drain: bool, seconds: int = FLUSH_SECONDS) -> DataStreamWriter:
    """Run for good with a time trigger, or (`drain`) take what is there and stop.

    The row limits of a flush are the source's (see `read_validated_topic`).
    """
    return writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=f"{seconds} seconds")


def with_counters(judged: DataFrame) -> DataFrame:
    """Running counts, read from `query.lastProgress.observedMetrics["validation"]`."""
    return judged.observe(
        "validation",
        F.count_if(F.col("reason").isNull()).alias("valid"),
        F.count_if(F.col("reason").isNotNull()).alias("dlq"),
        F.count(F.lit(1)).alias("total"),
    )


def _write_once(df: DataFrame, path: str) -> None:
    """Write a batch folder unless it is there and complete.

    A reader may have taken its files already; the same rows under new file names
    would be read a second time.
    """
    if not Files(df.sparkSession, path).exists(f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Name of a stream, kept beside its checkpoint: batch numbers only count within it."""
    path = f"{checkpoint}/lakesearch_stream"
    files = Files(spark, checkpoint)
    if not files.exists(path):
        files.write_new(path, uuid.uuid4().hex[:12])
    return files.read_text(path)


def start_validator(raw: DataFrame, out: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Validate and route into `<out>/validated` and `<out>/dlq`, one folder per batch.

    Both sides are written from one kept copy of the judged batch.
    """
    stream = _stream_id(raw.sparkSession, checkpoint)

    def route(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid = messages(valid_rows(batch), "key", STORY_FIELDS)
            _write_once(valid, f"{out}/validated/batch={stream}-{batch_id}")
            _write_once(dead_letters(batch), f"{out}/dlq/batch={stream}-{batch_id}")
        finally:
            batch.unpersist()

    writer = with_counters(validate(raw)).writeStream.option("checkpointLocation", checkpoint).foreachBatch(route)
    return trigger(writer, drain).start()


def start_kafka_validator(raw: DataFrame, servers: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Validate and route to the validated and dead-letter topics."""

    def route(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            valid = messages(valid_rows(batch), "key", STORY_FIELDS)
            valid.write.format("kafka").options(**sink_options(servers, VALIDATED_TOPIC)).save()
            dead_letter_messages(batch).write.format("kafka").options(**sink_options(servers, DLQ_TOPIC)).save()
        finally:
            batch.unpersist()

    writer = with_counters(validate(raw)).writeStream.option("checkpointLocation", checkpoint).foreachBatch(route)
    return trigger(writer, drain).start()


def parse_validated(stream: DataFrame) -> DataFrame:
    """Story rows from validated messages; unreadable ones are counted and dropped."""
    parsed = stream.select("key", F.from_json(F.col("value").cast("string"), STORY_EVENT).alias("e"))
    # `id` is never null in a validated event.
    unreadable = F.col("e.id").isNull()
    counted = parsed.observe("bronze", F.count_if(unreadable).alias("skipped"), F.count_if(~unreadable).alias("kept"))
    return counted.where(~unreadable).select("key", "e.*")


def start_bronze_writer(validated: DataFrame, root: str, checkpoint: str, drain: bool = False, seconds: int = FLUSH_SECONDS) -> StreamingQuery:
    """Land validated messages in Bronze, partitioned by flush date and hour."""
    rows = with_bronze_columns(parse_validated(validated))
    stream = _stream_id(validated.sparkSession, checkpoint)

    def land(batch: DataFrame, batch_id: int) -> None:
        append_bronze(batch, root, f"{stream}-{batch_id:09d}")

    return trigger(rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(land), drain, seconds).start()


def new_ids(items: DataFrame, primed: DataFrame, watermark: str | None = None) -> DataFrame:
    """Items whose id is neither primed nor seen before on this stream.

    State grows with the ids. With `watermark` (say "7 days") an id is forgotten once
    the story's own time has fallen so far behind.
    """
    fresh = items.join(primed.select("id"), "id", "left_anti")
    if watermark is None:
        return fresh.dropDuplicates(["id"])
    timed = fresh.withColumn("event_time", F.timestamp_seconds("time")).withWatermark("event_time", watermark)
    return timed.dropDuplicatesWithinWatermark(["id"])


