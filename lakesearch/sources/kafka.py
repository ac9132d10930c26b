"""Options for the Kafka source and sink, as plain dictionaries.

Offsets live in the query's checkpoint; `earliest` only counts for its first start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Topic names.
RAW_TOPIC = "raw-events-topic"
VALIDATED_TOPIC = "validated-events-topic"
DLQ_TOPIC = "dlq-topic"

#: Messages a batch takes at most, so that a first start does not take a whole topic at once.
MAX_PER_TRIGGER = 1_000_000


def source_options(
    servers: str, topic: str, max_per_trigger: int | None = None, flush_rows: int | None = None, flush_seconds: int | None = None
) -> dict[str, str]:
    """With `flush_rows` a batch starts once so many messages wait, or after `flush_seconds`."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if flush_rows is not None:
        options["minOffsetsPerTrigger"] = str(flush_rows)
    if flush_seconds is not None:
        options["maxTriggerDelay"] = f"{flush_seconds}s"
    return options


def sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    max_per_trigger: int | None = MAX_PER_TRIGGER,
    flush_rows: int | None = None,
    flush_seconds: int | None = None,
) -> DataFrame:
    """Stream of (key, value); the value stays binary so that bad bytes can be seen."""
    options = source_options(servers, topic, max_per_trigger, flush_rows, flush_seconds)
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("key").cast("string").alias("key"), "value")


def messages(df: DataFrame, key: Column | str, columns: list[str]) -> DataFrame:
    """Rows as keyed JSON messages; nulls are written out."""
    key = F.col(key) if isinstance(key, str) else key
    value = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    return df.select(key.cast("string").alias("key"), value.alias("value"))
