"""Hybrid retrieval: reciprocal rank fusion, per-query threshold, grounded verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesearch.functions.embed import Embedder, hashed_embedder
from lakesearch.functions.text import (
    NO_TITLE,
    clean_event_details,
    fixed_decimal,
    item_link,
    split_title,
)
from lakesearch.operators import bm25, dense, postings
from lakesearch.operators.batches import Batch, per_batch
from lakesearch.operators.silver import doc_part

# ---- fixed values ----
RRF_K = 60
TOP_K = 5
DYNAMIC_Z = 0.5
DENSE_FLOOR = 0.30
BM25_FLOOR = 5.0
# ----------------------
DENSE, KEYWORD = "dense", "keyword"
FUSED_DIGITS = 12
# Equal scores must clear their own mean, whatever the last bit of the sum.
THRESHOLD_SLACK = 1e-12
# Places behind any dense rank: the dense list comes first among equal scores.
_BEHIND = 1_000_000


def fuse_sides(ranked: DataFrame, k: int = RRF_K) -> DataFrame:
    """Fuse ranked rows (query_id, side, text, score, rank, payload) of both sides by text.

    Dense rows with empty text are dropped here, after ranking: they used up their rank.
    A text that occurs twice in one list gets credit twice, and its later row gives
    the score; the payload is the last dense row's, else the first keyword row's.
    """
    on = lambda side, c: F.when(F.col("side") == side, F.col(c))
    rows = ranked.where((F.col("side") != DENSE) | (F.coalesce("text", F.lit("")) != "")).select(
        "query_id",
        "text",
        "payload",
        (F.lit(1.0) / (F.lit(k) + F.col("rank"))).alias("credit"),
        on(DENSE, "rank").alias("dense_rank"),
        on(DENSE, "score").alias("dense_score"),
        on(KEYWORD, "rank").alias("keyword_rank"),
        on(KEYWORD, "score").alias("bm25_score"),
    )
    # max_by and min_by take no notice of rows without a rank on that side.
    return rows.groupBy("query_id", "text").agg(
        F.sum("credit").alias("fused_score"),
        F.max_by("dense_score", "dense_rank").alias("dense_score"),
        F.max_by("bm25_score", "keyword_rank").alias("bm25_score"),
        F.min("dense_rank").alias("dense_rank"),
        F.min("keyword_rank").alias("keyword_rank"),
        F.coalesce(F.max_by("payload", "dense_rank"), F.min_by("payload", "keyword_rank")).alias("payload"),
    )


def rrf_fuse(dense_list: DataFrame, keyword_list: DataFrame, k: int = RRF_K) -> DataFrame:
    """Fuse two ranked lists by text: a full outer join, written as union and group."""
    sides = dense_list.withColumn("side", F.lit(DENSE)), keyword_list.withColumn("side", F.lit(KEYWORD))
    return fuse_sides(sides[0].unionByName(sides[1]), k)


def with_threshold(fused: DataFrame, z: float = DYNAMIC_Z) -> DataFrame:
    """Add `dynamic_threshold`: mean + z * population stdev of the query's whole pool."""
    pool = Window.partitionBy("query_id")
    f = F.col("fused_score")
    return fused.withColumn(
        "dynamic_threshold",
        F.when(F.count(f).over(pool) < 2, F.lit(0.0)).otherwise(F.avg(f).over(pool) + z * F.stddev_pop(f).over(pool)),
    )


def is_grounded(dense_floor: float = DENSE_FLOOR, bm25_floor: float = BM25_FLOOR) -> Column:
    no = F.lit(False)
    clears_floor = F.coalesce(F.col("dense_score") >= dense_floor, no) | F.coalesce(F.col("bm25_score") >= bm25_floor, no)
    return (F.col("fused_score") >= F.col("dynamic_threshold") - THRESHOLD_SLACK) & clears_floor


def verdicts(
    fused: DataFrame,
    top_k: int = TOP_K,
    z: float = DYNAMIC_Z,
    dense_floor: float = DENSE_FLOOR,
    bm25_floor: float = BM25_FLOOR,
) -> DataFrame:
    """The top k per query with a verdict. The threshold is taken before the cut."""
    first_seen = F.coalesce("dense_rank", F.lit(_BEHIND) + F.col("keyword_rank"))
    order = Window.partitionBy("query_id").orderBy(F.round("fused_score", FUSED_DIGITS).desc(), first_seen)
    top = with_threshold(fused, z).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top_k)
    return top.select(
        "query_id",
        "rank",
        "text",
        F.round("fused_score", 5).alias("fused_score"),
        F.round("dense_score", 4).alias("dense_score"),
        F.round("bm25_score", 4).alias("bm25_score"),
        is_grounded(dense_floor, bm25_floor).alias("grounded"),
        F.round("dynamic_threshold", 5).alias("dynamic_threshold"),
        "payload",
    )


def with_payload(ranked: DataFrame, payloads: DataFrame) -> DataFrame:
    """Bring `text` and `payload` to a ranked list.

    The list holds a fixed number of rows per query of one measured batch, so it is
    the side to broadcast; the payload table is only scanned. If that table is
    partitioned by `doc_part`, the list prunes it to the partitions it needs.
    """
    keys = ["doc"]
    if "doc_part" in payloads.columns:
        ranked = ranked.withColumn("doc_part", doc_part("doc"))
        keys = ["doc_part", "doc"]
    return payloads.join(F.broadcast(ranked), keys)


def candidate_lists(
    batch: Batch,
    embedded: DataFrame,
    vectors: DataFrame,
    index: bm25.Bm25Index | postings.Reader,
    payloads: DataFrame,
    candidates: int,
    pad_zero: bool,
    vector_payloads: DataFrame | None = None,
) -> DataFrame:
    """Both ranked lists of one batch with text and payload, told apart by `side`."""
    found = index.topk(batch, candidates, pad_zero).withColumn("side", F.lit(KEYWORD))
    ref = None if vector_payloads is None else "ref"
    near = dense.measured_topk(Batch(embedded, batch.fits), vectors, candidates, "doc", "vector", ref).withColumn("side", F.lit(DENSE))
    if vector_payloads is None:
        return with_payload(near.unionByName(found), payloads)
    columns = ["query_id", "side", "text", "score", "rank", "payload"]
    near = vector_payloads.join(F.broadcast(near), "ref")
    return near.select(*columns).unionByName(with_payload(found, payloads).select(*columns))


def fused_pool(
    queries: DataFrame,
    vectors: DataFrame,
    index: bm25.Bm25Index | postings.Reader,
    payloads: DataFrame,
    embedder: Embedder | None = None,
    candidates: int = dense.CANDIDATES,
    pad_zero: bool = True,
    vector_payloads: DataFrame | None = None,
) -> DataFrame:
    """The whole fused pool of every query: dense and keyword candidates by text.

    `queries`: query_id, query_text and, if embedded already, query_vector.
    `vectors`: doc, vector. `payloads`: doc, text, payload and perhaps doc_part.
    Where vectors carry payloads of their own, `vector_payloads` has ref, text,
    payload, and `vectors` has `ref` as well.
    """
    given = "query_vector" in queries.columns
    embed = embedder or hashed_embedder()

    def search(batch: Batch) -> DataFrame:
        embedded = batch.queries if given else embed(batch.queries, "query_text", "query_vector")
        return fuse_sides(
            candidate_lists(batch, embedded, vectors, index, payloads, candidates, pad_zero, vector_payloads)
        )

    return per_batch(queries, search)


def hybrid_search(
    queries: DataFrame,
    vectors: DataFrame,
    index: bm25.Bm25Index | postings.Reader,
    payloads: DataFrame,
    embedder: Embedder | None = None,
    top_k: int = TOP_K,
    candidates: int = dense.CANDIDATES,
    z: float = DYNAMIC_Z,
    dense_floor: float = DENSE_FLOOR,
    bm25_floor: float = BM25_FLOOR,
    pad_zero: bool = True,
    vector_payloads: DataFrame | None = None,
) -> DataFrame:
    """Answer a batch of queries: the top k of each fused pool, with verdicts."""
    pool = fused_pool(queries, vectors, index, payloads, embedder, candidates, pad_zero, vector_payloads)
    return verdicts(pool, top_k, z, dense_floor, bm25_floor)


def display_rows(results: DataFrame) -> DataFrame:
    """Verdict rows as text for a table on screen."""
    parts = split_title("payload.title", "payload.text")
    df = results.withColumn("__parts", parts)
    return df.select(
        "query_id",
        "rank",
        fixed_decimal("dense_score", 4).alias("Dense"),
        fixed_decimal("bm25_score", 4).alias("BM25"),
        fixed_decimal("fused_score", 5).alias("Fused"),
        fixed_decimal("dynamic_threshold", 5).alias("Threshold"),
        F.when(F.col("grounded"), F.lit("Yes")).otherwise(F.lit("No")).alias("Grounded"),
        F.coalesce(F.nullif("__parts.title", F.lit("")), F.lit(NO_TITLE)).alias("Article Title"),
        clean_event_details("__parts.details").alias("Event / Edit Details"),
        F.col("payload.by").alias("Author"),
        item_link("payload.id").alias("Hacker News Link"),
    )
