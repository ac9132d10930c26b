"""Counts, rates and the health state over all stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesearch.sources.kafka import DLQ_TOPIC, RAW_TOPIC, VALIDATED_TOPIC
from lakesearch.sources.tables import Table

# ---- fixed values ----
DLQ_ALARM_PERCENT = 15
STATES = ("warn", "bad", "warn", "ok")
# ----------------------


def topic_depths(offsets: DataFrame) -> DataFrame:
    """Messages per topic from (topic, partition, offset): high minus low, summed."""
    span = offsets.groupBy("topic", "partition").agg((F.max("offset") - F.min("offset") + 1).alias("n"))
    return span.groupBy("topic").agg(F.sum("n").alias("depth"))


def watermark_depths(watermarks: DataFrame) -> DataFrame:
    """Messages per topic from (topic, partition, low, high)."""
    return watermarks.groupBy("topic").agg(F.sum(F.col("high") - F.col("low")).alias("depth"))


def stage_depths(depths: DataFrame | None, bronze_rows: Column) -> DataFrame:
    """One row: depth of the raw, validated and dead-letter topic.

    A topic that is missing counts 0. When no depths can be had at all (`None`, the
    broker is away), raw and validated fall back to the Bronze row count.
    """
    if depths is None:
        spark = SparkSession.active()
        return spark.range(1).select(
            bronze_rows.alias("raw"), bronze_rows.alias("validated"), F.lit(0).cast("bigint").alias("dlq")
        )
    of = lambda topic: F.coalesce(F.sum(F.when(F.col("topic") == topic, F.col("depth"))), F.lit(0)).cast("bigint")
    return depths.agg(of(RAW_TOPIC).alias("raw"), of(VALIDATED_TOPIC).alias("validated"), of(DLQ_TOPIC).alias("dlq"))


def row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def table_stats(table: Table) -> DataFrame:
    """Row count and time of the last change of a written table."""
    changed = table.modified_ms()
    when = F.lit(None).cast("timestamp") if changed is None else F.timestamp_millis(F.lit(changed))
    return table.read().agg(F.count(F.lit(1)).alias("row_count")).withColumn("last_modified", when)


def vector_stats(vectors: Table, ledger: Table) -> DataFrame:
    synced = table_stats(ledger)
    return table_stats(vectors).select(
        F.col("row_count").alias("point_count"),
        synced.select("row_count").scalar().alias("synced_hash_count"),
        synced.select("last_modified").scalar().alias("last_sync"),
    )


def dlq_rate(validated: Column, dlq: Column) -> Column:
    processed = validated + dlq
    return F.when(processed > 0, dlq / processed * 100).otherwise(F.lit(0.0))


def health_level(processed: Column, bronze_rows: Column, rate: Column, gap: Column) -> Column:
    """Which rung holds: 0 no data, 1 rejects, 2 rows pending, 3 healthy."""
    return (
        F.when((processed == 0) & (bronze_rows == 0), F.lit(0))
        .when(rate > DLQ_ALARM_PERCENT, F.lit(1))
        .when(gap > 0, F.lit(2))
        .otherwise(F.lit(3))
    )


def snapshot(stages: DataFrame, bronze_rows: Column, silver_rows: Column, points: Column, synced: Column) -> DataFrame:
    """One row with all counters, the reject rate, the sync gap and the health state.

    `shown_raw` and `shown_validated` are what a display shows: an empty topic there
    gives way to the Bronze row count.
    """
    df = stages.select(
        "raw",
        "validated",
        "dlq",
        bronze_rows.alias("bronze_rows"),
        silver_rows.alias("silver_rows"),
        points.alias("points"),
        synced.alias("synced"),
    )
    or_bronze = lambda c: F.coalesce(F.nullif(c, F.lit(0)), "bronze_rows")
    df = df.select(
        "*",
        or_bronze("raw").alias("shown_raw"),
        or_bronze("validated").alias("shown_validated"),
        dlq_rate(F.col("validated"), F.col("dlq")).alias("dlq_rate"),
        F.greatest(F.col("silver_rows") - F.col("synced"), F.lit(0)).alias("sync_gap"),
    )
    level = health_level(F.col("validated") + F.col("dlq"), F.col("bronze_rows"), F.col("dlq_rate"), F.col("sync_gap"))
    df = df.withColumn("__level", level)
    state = F.element_at(F.array(*[F.lit(s) for s in STATES]), F.col("__level") + 1)
    message = (
        F.when(F.col("__level") == 0, F.lit("No events yet: start a stream or ingest some items."))
        .when(F.col("__level") == 1, F.format_string("%.1f%% of events are rejected: look at the dead letters.", "dlq_rate"))
        .when(F.col("__level") == 2, F.format_string("%d Silver rows have no vector yet.", "sync_gap"))
        .otherwise(F.format_string("All well: %d events stored and every text embedded.", "bronze_rows"))
    )
    return df.select("*", state.alias("health"), message.alias("message")).drop("__level")


def distinct_titles(silver: DataFrame) -> DataFrame:
    """Distinct non-null titles; the scan reads the title column only."""
    return silver.select("title").na.drop().distinct()


def sample_titles(silver: DataFrame, n: int = 5, seed: str | None = None) -> DataFrame:
    """A random n of the distinct titles; the same n again if a seed is given."""
    titles = distinct_titles(silver)
    order = F.rand() if seed is None else F.sha1(F.concat("title", F.lit(seed)))
    return titles.orderBy(order, "title").limit(n)
