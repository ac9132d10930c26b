"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesearch.functions import embed, hashing, text
from lakesearch.operators import bm25, dense, filters, fusion, silver, telemetry, validate, vectors
from lakesearch.operators.batches import per_batch
from lakesearch.plans import views
from lakesearch.plans.refresh import Lake
from lakesearch.schemas import SILVER_COLUMNS, STORY_FIELDS
from lakesearch.session import configure, scratch_dir, written
from lakesearch.sources.bronze import append_bronze, compact_bronze, partition_counts, read_bronze

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Time given to items without one, so that results repeat.
LIGHT_NOW = 1704067200
SAMPLE_SEED = "lakesearch"


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def _bigint(*names: str):
    return [F.col(n).cast("bigint").alias(n) for n in names]


# ---- ingest: filters, validation, dead letters ----


def _items(spark, sf_dir):
    return filters.parse_items(views.events_view(spark, sf_dir, views.RAW_EVENTS))


def _judged(spark, sf_dir):
    return validate.validate(views.events_view(spark, sf_dir, views.RAW_EVENTS))


@query
def filter_story_live(spark, sf_dir):
    return filters.filter_story_live(_items(spark, sf_dir)).select("event_id", filters.member_key(F.col("item"), "by").alias("key"))


@query
def filter_story_backfill(spark, sf_dir):
    return filters.filter_story_backfill(_items(spark, sf_dir)).select("event_id")


@query
def filter_change_feed(spark, sf_dir):
    return filters.filter_change_feed(views.events_view(spark, sf_dir, views.FEED)).select("event_id", "key")


@query
def filter_tally(spark, sf_dir):
    feed = filters.feed_messages(views.events_view(spark, sf_dir, views.FEED))
    return filters.tally(feed, filters.is_change(F.col("item")))


@query
def unseen_ids(spark, sf_dir):
    """Users of the event stream as ids; ids of labelled documents as the primed list."""
    current = views.table(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    primed = views.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    return filters.unseen_ids(current, primed)


@query
def backfill_range(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return filters.backfill_range(events)


@query
def event_key(spark, sf_dir):
    raw = views.events_view(spark, sf_dir, views.RAW_EVENTS)
    return raw.select("event_id", filters.event_key("key").alias("key"))


@query
def validate_valid(spark, sf_dir):
    return validate.valid_rows(_judged(spark, sf_dir))


@query
def event_json(spark, sf_dir):
    valid = validate.valid_rows(_judged(spark, sf_dir))
    return valid.select("id", text.event_json(STORY_FIELDS).alias("value"))


@query
def dlq_records(spark, sf_dir):
    return validate.dead_letters(_judged(spark, sf_dir))


@query
def validate_dlq_reasons(spark, sf_dir):
    return validate.dead_letters(_judged(spark, sf_dir)).groupBy("reason", "reason_class").agg(F.count(F.lit(1)).alias("n"))


@query
def validate_split_counts(spark, sf_dir):
    return validate.split_counts(_judged(spark, sf_dir))


@query
def validate_coercion(spark, sf_dir):
    judged = validate.validate(views.events_view(spark, sf_dir, views.COERCION_EVENTS))
    return judged.select("key", "original_event", "id", "reason")


@query
def validate_light(spark, sf_dir):
    return validate.validate_light(views.events_view(spark, sf_dir, views.LIGHT_ITEMS), LIGHT_NOW)


@query
def bronze_partition_counts(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    rows = events.select(text.partition_date(ts).alias("date"), text.partition_hour(ts).alias("hour"))
    return partition_counts(rows)


# ---- text ----


@query
def clean_html(spark, sf_dir):
    return views.stories_pages(spark, sf_dir).select("id", text.clean_html("text").alias("cleaned"))


@query
def domain_of(spark, sf_dir):
    return views.stories_pages(spark, sf_dir).select("id", text.domain_of("url").alias("domain"))


@query
def build_snippet(spark, sf_dir):
    return silver.with_snippets(views.stories_pages(spark, sf_dir)).select("id", F.col("text").alias("snippet"))


@query
def link_snippet(spark, sf_dir):
    """Snippets of stories without text: the link form."""
    links = views.stories_pages(spark, sf_dir).withColumn("text", F.lit(None).cast("string"))
    return silver.with_snippets(links).select("id", F.col("text").alias("snippet"))


@query
def tokenize(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", text.tokenize("text").alias("t"))
    return docs.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


@query
def content_hash(spark, sf_dir):
    return views.table(spark, sf_dir, "documents").select("doc_id", hashing.content_hash("text").alias("content_hash"))


@query
def point_id(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", hashing.content_hash("text").alias("h"))
    return docs.select("doc_id", hashing.point_id("h").alias("point_id"))


def _details(spark, sf_dir):
    return views.view(spark, sf_dir, views.DETAILS, conversations=views.table(spark, sf_dir, "conversations"))


@query
def split_title_details(spark, sf_dir):
    parts = _details(spark, sf_dir).select("conv_id", "turn", text.split_title("title", "text").alias("p"))
    return parts.select("conv_id", "turn", F.col("p.title").alias("title"), F.col("p.details").alias("details"))


@query
def clean_event_details(spark, sf_dir):
    return _details(spark, sf_dir).select("conv_id", "turn", text.clean_event_details("details").alias("details"))


@query
def item_link(spark, sf_dir):
    return _details(spark, sf_dir).select("conv_id", "turn", text.item_link("conv_id").alias("link"))


@query
def sample_titles(spark, sf_dir):
    return telemetry.sample_titles(views.stories_pages(spark, sf_dir), 5, SAMPLE_SEED)


@query
def distinct_titles(spark, sf_dir):
    return telemetry.distinct_titles(views.stories_pages(spark, sf_dir))


# ---- Silver ----


@query
def silver_build(spark, sf_dir):
    return views.silver_docs(spark, sf_dir)


@query
def silver_dedup_report(spark, sf_dir):
    return silver.dedup_report(views.stories_docs(spark, sf_dir))


@query
def silver_merge_by_id(spark, sf_dir):
    """Existing: conversations, with repeated ids. New: documents."""
    existing = views.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("id"), F.col("turn").alias("seq"), F.col("role").alias("by"), "text"
    )
    new = views.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("n_chars").alias("seq"), F.col("source").alias("by"), "text"
    )
    return silver.merge_by_id(existing, new, "seq")


# ---- vectors ----


def _hashed(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", "source", "text", hashing.content_hash("text").alias("content_hash"))


def _ledger(spark, sf_dir):
    """Labelled documents count as synced."""
    labelled = views.table(spark, sf_dir, "labels").select("doc_id")
    return _hashed(spark, sf_dir).join(labelled, "doc_id", "left_semi").select("content_hash")


@query
def sync_new_rows(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents")
    return vectors.sync_new_rows(docs, _ledger(spark, sf_dir)).select("doc_id", "content_hash")


@query
def sync_gap(spark, sf_dir):
    return vectors.sync_gap(views.table(spark, sf_dir, "documents"), _ledger(spark, sf_dir))


@query
def ledger_union(spark, sf_dir):
    return vectors.ledger_union(_ledger(spark, sf_dir), _hashed(spark, sf_dir))


def _non_zero(df: DataFrame, *keep: str) -> DataFrame:
    parts = df.select(*keep, F.posexplode("vector").alias("bucket", "x")).where("x <> 0")
    return parts.select(*keep, F.col("bucket").cast("bigint").alias("bucket"), F.round(F.col("x").cast("double"), 6).alias("weight"))


@query
def embed_hashed(spark, sf_dir):
    docs = views.table(spark, sf_dir, "documents").select("doc_id", "text")
    return _non_zero(embed.hashed_embedder()(docs, "text", "vector"), "doc_id")


def _flat(points: DataFrame) -> DataFrame:
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return points.select(
        "point_id",
        "content_hash",
        *[F.col(f"payload.{n}").alias(n) for n in ("text", "title", "id", "by", "url", "score", "time")],
        F.size(F.filter("vector", lambda x: x != 0)).cast("bigint").alias("non_zero"),
        F.round(F.sqrt(length), 5).alias("norm"),
    )


@query
def vector_points(spark, sf_dir):
    rows = vectors.with_hash(views.silver_docs(spark, sf_dir))
    return _flat(vectors.vector_points(rows))


@query
def vector_upsert(spark, sf_dir):
    """Stored: conversation texts and labelled documents. New: all documents."""
    talk = views.table(spark, sf_dir, "conversations").select(
        "text", F.lit("conversation").alias("title"), F.col("conv_id").alias("id"), F.col("role").alias("by"), F.col("turn").alias("time")
    )
    docs = views.table(spark, sf_dir, "documents").select(
        "text", F.lit("document").alias("title"), F.col("doc_id").alias("id"), F.col("source").alias("by"), F.col("n_chars").alias("time")
    )
    labelled = views.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    stored = talk.unionByName(docs.join(labelled, "id", "left_semi").withColumn("by", F.lit("stored")))
    stored = vectors.vector_points(vectors.latest_per_hash(vectors.with_hash(stored)))
    new = vectors.vector_points(vectors.latest_per_hash(vectors.with_hash(docs)))
    return _flat(vectors.upsert(stored, new, new_is_unique=True)).drop("url", "score", "norm")


# ---- retrieval ----


@query
def bm25_doc_stats(spark, sf_dir):
    docs = views.corpus(views.silver_docs(spark, sf_dir))
    return bm25.doc_stats(docs).select("n_docs", "total_len", F.round("avgdl", 6).alias("avgdl"))


@query
def bm25_idf(spark, sf_dir):
    index = bm25.build_index(views.corpus(views.silver_docs(spark, sf_dir)))
    return index.idf.select("term", "df", F.round("idf", 6).alias("idf"))


@query
def bm25_postings(spark, sf_dir):
    return bm25.postings_of(views.corpus(views.silver_docs(spark, sf_dir)))


@query
def bm25_scores(spark, sf_dir):
    index = bm25.build_index(views.corpus(views.written_silver(spark, sf_dir)))
    scored = bm25.bm25_scores(views.search_queries(spark, sf_dir), index)
    return scored.select("query_id", "doc", F.round("score", 6).alias("score"))


@query
def bm25_topk(spark, sf_dir):
    index = bm25.build_index(views.corpus(views.written_silver(spark, sf_dir)))
    top = bm25.bm25_topk(views.search_queries(spark, sf_dir), index)
    return top.select("query_id", "doc", F.round("score", 6).alias("score"), *_bigint("rank"))


@query
def dense_topk(spark, sf_dir):
    stored = views.table(spark, sf_dir, "embeddings")
    top = dense.dense_topk(views.label_centroids(spark, sf_dir), stored, doc="vec_id", vector="embedding")
    return top.select("query_id", "doc", F.round("score", 6).alias("score"), *_bigint("rank"))


def _doc_vectors(rows: DataFrame) -> DataFrame:
    return embed.hashed_embedder()(views.corpus(rows), "text", "vector").select("doc", "vector")


def _payloads(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("id").alias("doc"), "text", vectors.payload_of(rows).alias("payload"))


@query
def dense_groundedness(spark, sf_dir):
    rows = views.written_silver(spark, sf_dir)
    embedded = embed.hashed_embedder()(views.search_queries(spark, sf_dir), "query_text", "query_vector")
    found = dense.dense_groundedness(embedded, _doc_vectors(rows), _payloads(rows))
    return found.select("query_id", *_bigint("rank"), "text", "wiki", "cosine_score", "grounded")


def _retrieve(search, spark, sf_dir) -> DataFrame:
    rows = views.written_silver(spark, sf_dir)
    index = bm25.build_index(views.corpus(rows))
    return search(views.search_queries(spark, sf_dir), _doc_vectors(rows), index, _payloads(rows))


def _fused(spark, sf_dir):
    return _retrieve(fusion.fused_pool, spark, sf_dir)


@query
def rrf_fuse(spark, sf_dir):
    return _fused(spark, sf_dir).select(
        "query_id",
        "text",
        F.round("fused_score", 9).alias("fused_score"),
        F.round("dense_score", 6).alias("dense_score"),
        F.round("bm25_score", 6).alias("bm25_score"),
        *_bigint("dense_rank", "keyword_rank"),
        F.col("payload.id").alias("id"),
    )


@query
def dynamic_threshold(spark, sf_dir):
    pools = fusion.with_threshold(_fused(spark, sf_dir))
    return pools.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("pool"), F.round(F.max("dynamic_threshold"), 9).alias("dynamic_threshold")
    )


def _hybrid(spark, sf_dir):
    return _retrieve(fusion.hybrid_search, spark, sf_dir)


def _found(results: DataFrame) -> DataFrame:
    return results.select(
        "query_id",
        *_bigint("rank"),
        "text",
        "fused_score",
        "dense_score",
        "bm25_score",
        "grounded",
        "dynamic_threshold",
        F.col("payload.id").alias("id"),
        F.col("payload.by").alias("by"),
    )


@query
def hybrid_search(spark, sf_dir):
    return _found(_hybrid(spark, sf_dir))


@query
def display_rows(spark, sf_dir):
    return fusion.display_rows(_hybrid(spark, sf_dir)).withColumn("rank", F.col("rank").cast("bigint"))


# ---- telemetry and the on-demand run ----


@query
def stage_depths(spark, sf_dir):
    depths = telemetry.topic_depths(views.events_view(spark, sf_dir, views.OFFSETS))
    bronze_rows = telemetry.row_count(views.table(spark, sf_dir, "events"))
    return telemetry.stage_depths(depths, bronze_rows)


@query
def telemetry_snapshot(spark, sf_dir):
    """Stages from the judged events, Silver from the documents, labels as the ledger."""
    counts = written(validate.split_counts(_judged(spark, sf_dir)))  # one row, asked for twice: events are judged once
    stages = counts.select(F.col("total").alias("raw"), F.col("valid").alias("validated"), "dlq")
    snap = telemetry.snapshot(
        stages,
        bronze_rows=counts.select("valid").scalar(),
        silver_rows=silver.dedup_report(views.stories_docs(spark, sf_dir)).select("rows_after").scalar(),
        points=telemetry.row_count(views.table(spark, sf_dir, "embeddings")),
        synced=telemetry.row_count(views.table(spark, sf_dir, "labels")),
    )
    return snap.withColumn("dlq_rate", F.round("dlq_rate", 6))


@query
def ingest_batch_counts(spark, sf_dir):
    """On-demand run in numbers: passed, rejected, Silver after the merge, new points."""
    lake = _new_lake(spark)
    lake.write_silver(views.silver_docs(spark, sf_dir))
    passed = lake.ingest_batch(views.events_view(spark, sf_dir, views.LIGHT_ITEMS), "run", LIGHT_NOW)
    return spark.range(1).select(
        F.lit(passed.valid).cast("bigint").alias("valid"),
        F.lit(passed.dlq).cast("bigint").alias("dlq"),
        telemetry.row_count(lake.silver.read()).alias("silver_rows"),
        telemetry.row_count(lake.store.points()).alias("new_points"),
    )


# ---- the stored path: Bronze files, Silver, vectors and index of a lake of its own ----


def _new_lake(spark) -> Lake:
    return Lake(spark, f"{scratch_dir(spark)}/lake-{uuid.uuid4().hex}", keep_replaced=False)


def _landed(spark, sf_dir, compact: bool = False):
    """A lake into which all documents come in two arrivals, the earlier half and the later one.

    The first refresh builds everything, the second follows the change. With `compact`,
    Bronze is compacted before the last refresh.
    """
    lake = _new_lake(spark)
    stories = views.stories_docs(spark, sf_dir).withColumn("descendants", F.lit(None).cast("bigint")).withColumn("_kafka_key", F.col("by"))
    at = F.to_timestamp("_ingested_at")
    stories = stories.withColumns({"date": text.partition_date(at), "hour": text.partition_hour(at)})
    half = views.table(spark, sf_dir, "documents").agg(F.avg("doc_id")).scalar()
    for batch, part in (("early", F.col("id") <= half), ("late", F.col("id") > half)):
        append_bronze(stories.where(part), lake.bronze_root, batch)
        if compact and batch == "late":
            compact_bronze(spark, lake.bronze_root)
        yield lake


def _refreshed(spark, sf_dir, vectors: bool = True, index: bool = True) -> Lake:
    """Both arrivals refreshed; of what follows Silver only that which the query returns."""
    for lake in _landed(spark, sf_dir):
        lake.refresh(vectors, index)
    return lake


@query
def bronze_compacted(spark, sf_dir):
    """Rows and files of every hour after compaction."""
    *_, lake = _landed(spark, sf_dir, compact=True)
    per_file = read_bronze(spark, lake.bronze_root).groupBy("date", "hour", F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("date", "hour").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("files"))


@query
def lake_silver(spark, sf_dir):
    return _refreshed(spark, sf_dir, vectors=False, index=False).silver.read().select(*SILVER_COLUMNS)


@query
def lake_vectors(spark, sf_dir):
    return _flat(_refreshed(spark, sf_dir, index=False).store.points())


@query
def lake_index_topk(spark, sf_dir):
    """The keyword top-k from the stored index; documents by the id of their story."""
    lake = _refreshed(spark, sf_dir, vectors=False)
    rows = lake.silver.read()
    reader = lake.index.open(bm25.corpus(rows))
    queries = views.search_queries(spark, sf_dir).select("query_id", "query_text")
    top = per_batch(queries, lambda batch: reader.topk(batch, bm25.CANDIDATES))
    named = rows.select(F.col("doc_order").alias("doc"), "id").join(F.broadcast(top), "doc")
    return named.select("query_id", F.col("id").alias("doc"), F.round("score", 6).alias("score"), *_bigint("rank"))


@query
def lake_search(spark, sf_dir):
    return _found(_refreshed(spark, sf_dir).search(views.search_queries(spark, sf_dir)))
