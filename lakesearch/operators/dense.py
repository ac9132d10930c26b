"""Dense search: exact cosine top-k of query vectors over a vector table.

One batch of queries is a small matrix. Every task multiplies its Arrow batches of
vectors with it and keeps its own k best per query, so a scan of any size hands on
only k rows per task and query, and pairs are never written out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakesearch.operators.batches import Batch, per_batch, row_parts

# ---- fixed values ----
CANDIDATES = 20
DENSE_TOP_K = 5
DENSE_THRESHOLD = 0.50
# Similarities are compared at this precision.
SCORE_DIGITS = 9
# ----------------------

# Cells of one similarity matrix in a task (rows of the slice times queries).
_CELLS = 500_000
# Interim winners of a task are merged in groups before the last step per query.
_MERGE_GROUPS = 64


def _local_topk(matrix: np.ndarray, query_ids: np.ndarray, k: int, digits: int, known: np.ndarray | None = None):
    """Arrow-batch function: (doc, vector, ref) in, (query_id, doc, score, ref) out."""

    def unit(m: np.ndarray) -> np.ndarray:
        norm = np.sqrt((m * m).sum(axis=1, keepdims=True))
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(norm > 0, m / norm, np.nan)

    def keep_best(q, s, d, r):
        # Sort by query, then score down, then document up; keep k of each query.
        order = np.lexsort((d, -s, q))
        q, s, d, r = q[order], s[order], d[order], r[order]
        first = np.r_[0, np.flatnonzero(np.diff(q)) + 1] if len(q) else np.empty(0, int)
        position = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
        chosen = position < k
        return q[chosen], s[chosen], d[chosen], r[chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_queries, dim = matrix.shape
        unit_queries = unit(matrix).T
        best = (np.empty(0, int), np.empty(0), np.empty(0, np.int64), np.empty(0, object))
        bar = np.full(n_queries, -np.inf)  # k-th best so far
        step = max(1, _CELLS // max(1, n_queries))
        for batch in batches:
            docs = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            lists, refs = batch.column(1), batch.column(2)
            if len(docs) and not np.all(lists.value_lengths().to_numpy(zero_copy_only=False) == dim):
                raise ValueError(f"vector of length other than {dim}")
            vectors = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(docs), dim)
            for at in range(0, len(docs), step):
                part, part_docs = unit(vectors[at : at + step].astype(np.float64)), docs[at : at + step]
                # A similarity that is not a number (zero vector) ranks below all.
                sims = np.round(part @ unit_queries, digits)
                sims[np.isnan(sims)] = -np.inf
                if len(part_docs) > k:
                    bar = np.maximum(bar, np.partition(sims, len(part_docs) - k, axis=0)[len(part_docs) - k])
                row, q = np.nonzero(sims >= bar)
                if len(row) > k * n_queries:  # ties: only the first k of each query can count
                    row, q = _first_k(part_docs, sims, row, q, k)
                r = np.array(refs.take(pa.array(row + at)).to_pylist(), dtype=object)
                best = keep_best(
                    np.r_[best[0], q], np.r_[best[1], sims[row, q]], np.r_[best[2], part_docs[row]], np.r_[best[3], r]
                )
                counts = np.bincount(best[0], minlength=n_queries)
                full = counts >= k
                if full.any():
                    last = np.cumsum(counts) - 1
                    bar[full] = np.maximum(bar[full], best[1][last[full]])
        q, s, d, r = best
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query_ids[q], pa.int64(), mask=None if known is None else ~known[q]),
                pa.array(d, pa.int64()),
                pa.array(s, pa.float64(), mask=np.isneginf(s)),
                pa.array(r, pa.string()),
            ],
            names=["query_id", "doc", "score", "ref"],
        )

    return run


def _best(scored: DataFrame, k: int, *groups) -> DataFrame:
    w = Window.partitionBy("query_id", *groups).orderBy(F.col("score").desc_nulls_last(), "doc")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _once(scored: DataFrame) -> DataFrame:
    """One row for each query and document, of a bounded list of candidates."""
    others = [c for c in scored.columns if c not in ("query_id", "doc", "score")]
    return scored.groupBy("query_id", "doc").agg(F.max("score").alias("score"), *[F.first(c).alias(c) for c in others]).select(*scored.columns)


_NEAR = "query_id long, doc long, score double, ref string"


def batch_topk(queries: DataFrame, vectors: DataFrame, k: int, doc: str, vector: str, ref: str | None = None) -> DataFrame:
    """Top-k for one measured batch of queries; `ref` is a text column to take along."""
    rows = vectors.where(F.col(vector).isNotNull()).select(
        F.col(doc).cast("bigint").alias("doc"),
        F.col(vector).alias("vector"),
        (F.lit(None).cast("string") if ref is None else F.col(ref)).alias("ref"),
    )
    # Equal vectors of an id are one; further ones of the same id are told apart and merged below.
    held = queries.select(F.col("query_id").cast("bigint"), "query_vector").distinct().collect()
    if held:
        matrix = np.array([r["query_vector"] for r in held], dtype=np.float64)
        known = np.array([r["query_id"] is not None for r in held])
        ids = np.array([r["query_id"] or 0 for r in held], dtype=np.int64)
        near = rows.mapInArrow(_local_topk(matrix, ids, k, SCORE_DIGITS, known), _NEAR)
        if len({r["query_id"] for r in held}) < len(held):
            near = _once(near)
    else:
        near = rows.sparkSession.createDataFrame([], _NEAR)
    # Two steps, so that no task sees the winners of all tasks for one query.
    merged = _best(near, k, F.pmod(F.xxhash64("doc"), F.lit(_MERGE_GROUPS))).drop("rank")
    best = _best(merged, k)
    return best.drop("ref") if ref is None else best


def _first_k(docs: np.ndarray, sims: np.ndarray, row: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of (row, query) cells the k best of each query, ties to the smaller document."""
    order = np.lexsort((docs[row], -sims[row, q], q))
    row, q = row[order], q[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q, "left") < k
    return row[keep], q[keep]


def measured_topk(batch: Batch, vectors: DataFrame, k: int, doc: str, vector: str, ref: str | None = None) -> DataFrame:
    """Top-k for one measured batch. A query's rows are one list: each document counts once, by its best row.

    A single query of too many rows is searched part by part, and the parts' best are merged.
    """
    parts = [batch.queries] if batch.fits else row_parts(batch.queries)
    found = reduce(DataFrame.unionByName, [batch_topk(p, vectors, k, doc, vector, ref) for p in parts])
    return found if len(parts) == 1 else _best(_once(found.drop("rank")), k)


def dense_topk(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = CANDIDATES,
    doc: str = "doc",
    vector: str = "vector",
) -> DataFrame:
    """(query_id, doc, score, rank): the k nearest vectors of each query.

    `queries` has `query_id` and `query_vector`; `doc` is a BIGINT that breaks ties.
    A zero vector has no similarity (null) and ranks last. The batch of query vectors
    is measured, then held as a matrix; more queries than fit take several passes.
    """
    queries = queries.select("query_id", "query_vector")
    return per_batch(queries, lambda batch: measured_topk(batch, vectors, k, doc, vector))


def dense_groundedness(
    queries: DataFrame,
    vectors: DataFrame,
    payloads: DataFrame,
    k: int = DENSE_TOP_K,
    threshold: float = DENSE_THRESHOLD,
    doc: str = "doc",
    vector: str = "vector",
) -> DataFrame:
    """Dense-only guardrail: the nearest texts, grounded from a fixed similarity up.

    `payloads` has `doc`, `text` and, where the feed has one, `wiki`.
    """
    wiki = F.col("wiki") if "wiki" in payloads.columns else F.lit(None).cast("string").alias("wiki")
    texts = payloads.select("doc", "text", wiki)

    def search(batch: Batch) -> DataFrame:
        # At most k rows per query of a measured batch.
        return texts.join(F.broadcast(measured_topk(batch, vectors, k, doc, vector)), "doc")

    return per_batch(queries.select("query_id", "query_vector"), search).select(
        "query_id",
        "rank",
        "doc",
        "text",
        "wiki",
        F.round("score", 4).alias("cosine_score"),
        F.coalesce(F.col("score") >= threshold, F.lit(False)).alias("grounded"),
    )
