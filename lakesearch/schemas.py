"""Table schemas, from raw message to verdict row. Names and order of the fields are fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()

RAW_MESSAGE = T.StructType([T.StructField("key", _S), T.StructField("value", _S)])

# A validated story. The first five fields are required; order is also the order
# in which field errors are reported.
STORY_EVENT = T.StructType(
    [
        T.StructField("id", _L, False),
        T.StructField("title", _S, False),
        T.StructField("by", _S, False),
        T.StructField("time", _L, False),
        T.StructField("type", _S, False),
        T.StructField("text", _S),
        T.StructField("url", _S),
        T.StructField("score", _L),
        T.StructField("descendants", _L),
    ]
)
STORY_FIELDS = STORY_EVENT.fieldNames()

DEAD_LETTER = T.StructType(
    [
        T.StructField("key", _S),
        T.StructField("reason", _S),
        T.StructField("reason_class", _S),
        T.StructField("original_event", _S),
    ]
)

# Everything nullable: files written by other paths may lack columns.
BRONZE = T.StructType(
    [T.StructField(f.name, f.dataType) for f in STORY_EVENT]
    + [
        T.StructField("_kafka_key", _S),
        T.StructField("_ingested_at", _S),
        T.StructField("date", _S),
        T.StructField("hour", _S),
        T.StructField("batch", _S),
    ]
)

SILVER_COLUMNS = ["text", "title", "id", "by", "url", "score", "time", "_ingested_at"]
SILVER = T.StructType(
    [
        T.StructField("text", _S),
        T.StructField("title", _S),
        T.StructField("id", _L),
        T.StructField("by", _S),
        T.StructField("url", _S),
        T.StructField("score", _L),
        T.StructField("time", _L),
        T.StructField("_ingested_at", _S),
        T.StructField("doc_order", _L),
        T.StructField("doc_part", _L),
    ]
)

PAYLOAD_FIELDS = ["text", "title", "id", "by", "url", "score", "time"]
PAYLOAD = T.StructType([SILVER[name] for name in PAYLOAD_FIELDS])

LEDGER = T.StructType([T.StructField("content_hash", _S), T.StructField("hash_of", _S)])

VECTORS = T.StructType(
    [
        T.StructField("point_id", _S),
        T.StructField("content_hash", _S),
        T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("payload", PAYLOAD),
    ]
)

QUERIES = T.StructType([T.StructField("query_id", _L), T.StructField("query_text", _S)])

VERDICT = T.StructType(
    [
        T.StructField("query_id", _L),
        T.StructField("rank", T.IntegerType()),
        T.StructField("text", _S),
        T.StructField("fused_score", _D),
        T.StructField("dense_score", _D),
        T.StructField("bm25_score", _D),
        T.StructField("grounded", T.BooleanType()),
        T.StructField("dynamic_threshold", _D),
        T.StructField("payload", PAYLOAD),
    ]
)

STAGE_OFFSETS = T.StructType(
    [
        T.StructField("topic", _S),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", _L),
    ]
)
