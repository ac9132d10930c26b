"""BM25 (Okapi) over tables: index, scores and the keyword top-k.

The index is sharded by document. Scores of a document come together in the task
that holds its postings, each task keeps its own best k per query, and only those
travel. `doc` is a unique BIGINT that rises in corpus order, so it also breaks ties.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesearch.functions.once import once
from lakesearch.functions.runs import with_run_lengths
from lakesearch.functions.text import tokenize
from lakesearch.operators.batches import Batch, lookup_join, per_batch
from lakesearch.operators.scoring import BEST, SCORE_DIGITS, Weights, best_of_texts, postings_of_tokens
from lakesearch.session import written

# ---- fixed values: BM25 parameters and the pool size ----
K1, B, EPSILON = 1.5, 0.75, 0.25
CANDIDATES = 20
# ---------------------------------------------------------

TERM, DOCS, LENGTH = 0, 1, 2


@dataclass
class Bm25Index:
    docs: DataFrame  # doc, text
    postings: DataFrame  # doc, dl, term, tf
    idf: DataFrame  # term, df, idf
    n_docs: Column  # scalars
    avgdl: Column
    floor: Column
    by_doc: bool = True  # a document's postings follow one another

    def topk(self, batch: Batch, k: int, pad_zero: bool = True) -> DataFrame:
        return batch_topk(batch, self, k, pad_zero)


def corpus(df: DataFrame, doc: str = "doc_order", text: str = "text") -> DataFrame:
    return df.na.drop(subset=[text]).select(F.col(doc).cast("bigint").alias("doc"), F.col(text).alias("text"))


def doc_lengths(docs: DataFrame) -> DataFrame:
    return docs.select("doc", F.size(tokenize("text")).cast("bigint").alias("dl"))


def postings_of(docs: DataFrame) -> DataFrame:
    """One row per document and distinct term. Counted inside the row: no shuffle."""
    df = docs.select(F.col("doc").cast("bigint").alias("doc"), tokenize("text").alias("tokens"))
    return df.mapInArrow(postings_of_tokens, "doc bigint, dl bigint, term string, tf bigint")


def _counts(docs: DataFrame) -> DataFrame:
    """Document frequency of every term, and the two corpus totals, in one aggregation.

    The totals ride along as rows of their own kind. All that is asked of this table
    (idf, floor, document count, mean length) then reads one and the same shuffle.
    """
    df = once(docs.select("text"), tokens=tokenize("text"))
    weighted = lambda kind, term, n: F.struct(
        F.lit(kind).alias("kind"), F.coalesce(term, F.lit("")).alias("term"), F.coalesce(n, F.lit(0)).cast("bigint").alias("weight")
    )
    totals = F.array(
        weighted(DOCS, F.lit(""), F.lit(1)),
        weighted(LENGTH, F.lit(""), F.size("tokens")),
    )
    terms = F.transform(F.array_distinct("tokens"), lambda t: weighted(TERM, t, F.lit(1)))
    rows = df.select(F.inline(F.concat(totals, terms)))
    return rows.groupBy("kind", "term").agg(F.sum("weight").alias("n"))


def raw_idf(n_docs: Column, df: Column) -> Column:
    return F.log(n_docs - df + 0.5) - F.log(df + 0.5)


def build_index(docs: DataFrame) -> Bm25Index:
    """Index over `corpus(...)` rows; the counts are written, postings computed when used. `postings.SegmentIndex` keeps one."""
    counts = written(_counts(docs))  # several passes start from it: texts are counted once
    total = lambda kind: F.max(F.when(F.col("kind") == kind, F.col("n")))
    n_docs = counts.agg(total(DOCS)).scalar()
    avgdl = counts.agg(total(LENGTH) / total(DOCS)).scalar()
    # The condition also looks at `n`, which keeps Spark from pushing it below the
    # aggregation and so making a second shuffle of it.
    is_term = F.when(F.col("kind") == TERM, F.col("n")).isNotNull()
    floor = counts.agg(EPSILON * F.avg(F.when(is_term, raw_idf(n_docs, F.col("n"))))).scalar()
    raw = raw_idf(n_docs, F.col("n"))
    idf = counts.where(is_term).select(
        "term", F.col("n").alias("df"), F.when(raw < 0, floor).otherwise(raw).alias("idf")
    )
    return Bm25Index(docs, postings_of(docs), idf, n_docs, avgdl, floor)


def doc_stats(docs: DataFrame) -> DataFrame:
    return docs.select(F.size(tokenize("text")).cast("bigint").alias("dl")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.coalesce(F.sum("dl"), F.lit(0)).alias("total_len"),
        F.avg("dl").alias("avgdl"),
    )


def query_terms(queries: DataFrame, key: str = "query_id") -> DataFrame:
    """(key, term, qtf): a token repeated in the query counts repeatedly."""
    df = queries.select(key, F.coalesce("query_text", F.lit("")).alias("__text"))
    df = with_run_lengths(df, tokenize("__text"), "term", "qtf", "__terms")
    df = df.select(key, F.explode("__terms").alias("t"))
    return df.select(key, F.coalesce("t.term", F.lit("")).alias("term"), F.col("t.qtf").alias("qtf"))


def _hits(batch: Batch, index: Bm25Index, key: str) -> DataFrame:
    """(key, doc, part): what each query term adds to each document it is in."""
    # There is one weight per query term at most: a batch that fits bounds both.
    weights = lookup_join(index.idf, query_terms(batch.queries, key), "term", "term", batch.fits).select(
        key, "term", (F.col("qtf") * F.col("idf")).alias("weight")
    )
    hits = lookup_join(index.postings, weights, "term", "doc", batch.fits)
    # A corpus without a single token has no postings, so the mean is never zero here.
    dl_part = K1 * (1 - B + B * F.col("dl") / index.avgdl)
    part = F.col("weight") * F.col("tf") * (K1 + 1) / (F.col("tf") + dl_part)
    return hits.select(key, "doc", part.alias("part"))


def _scores(batch: Batch, index: Bm25Index) -> DataFrame:
    return _hits(batch, index, "query_id").groupBy("query_id", "doc").agg(F.sum("part").alias("score"))


def weights_of(rows: DataFrame) -> Weights:
    """Weights from (n, term, w) rows of one measured batch of queries, which bounds them."""
    held = rows.groupBy("n", "term").agg(F.sum("w").alias("w")).toArrow()
    coded = held["term"].combine_chunks().dictionary_encode()
    q, t, w = held["n"].to_numpy(), coded.indices.to_numpy(), held["w"].to_numpy()
    order = np.lexsort((t, q))
    return Weights(coded.dictionary.to_pylist(), q[order].astype(np.int64), t[order].astype(np.int64), w[order].astype(np.float64))


def _best_scores(batch: Batch, index: Bm25Index, k: int) -> DataFrame:
    """(query_id, doc, score) with at least each query's k best documents."""
    if not (index.by_doc and batch.fits):
        return _scores(batch, index)
    # One measured batch of queries: they are numbered, so that tasks handle numbers only.
    numbered = batch.queries.withColumn("n", F.dense_rank().over(Window.orderBy("query_id")))
    asked = lookup_join(index.idf, query_terms(numbered, "n"), "term", "term", True)
    weights = weights_of(asked.select("n", "term", (F.col("qtf") * F.col("idf")).alias("w")))
    shared = index.docs.sparkSession.sparkContext.broadcast(weights)
    rows = index.docs.select(F.col("doc").cast("bigint").alias("doc"), tokenize("text").alias("tokens"), index.avgdl.cast("double").alias("mean"))
    best = rows.mapInArrow(best_of_texts(shared, k, K1, B), BEST)
    return best.join(F.broadcast(numbered.select("n", "query_id").distinct()), "n").select("query_id", "doc", "score")


def bm25_scores(queries: DataFrame, index: Bm25Index) -> DataFrame:
    """Score of every document that shares a term with the query; all others score 0."""
    return per_batch(queries.select("query_id", "query_text"), lambda batch: _scores(batch, index))


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.round("score", SCORE_DIGITS).desc(), "doc")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _unmatched(queries: DataFrame, index: Bm25Index, k: int) -> DataFrame:
    """Documents without any query term (score 0) that may belong in a query's top k.

    A query has room for them only if it has fewer than k positive scores. They come
    from the front of the corpus: of its first 2k documents at least k are then not
    positive, so no later one is needed. That holds while no score can be negative;
    with a negative idf floor (a tiny vocabulary) the whole corpus is looked at.
    """
    terms = F.array_distinct(tokenize(F.coalesce("query_text", F.lit(""))))
    # One batch of queries, hence of bounded size.
    asked = queries.agg(F.collect_list(F.struct("query_id", terms.alias("terms")))).scalar()
    front = index.docs.select("doc").orderBy("doc").limit(2 * k).agg(F.max("doc")).scalar()
    last = index.docs.agg(F.max("doc")).scalar()
    until = F.when(index.floor < 0, last).otherwise(front)
    zero = once(index.docs.where(F.col("doc") <= until), terms=F.array_distinct(tokenize("text")))
    zero = zero.select("doc", "terms", asked.alias("asked"))
    missed = F.filter("asked", lambda q: ~F.arrays_overlap(q.terms, F.col("terms")))
    return zero.select(F.explode(missed).alias("q"), "doc").select(F.col("q.query_id"), "doc", F.lit(0.0).alias("score"))


def bm25_topk(queries: DataFrame, index: Bm25Index, k: int = CANDIDATES, pad_zero: bool = True) -> DataFrame:
    """(query_id, doc, score, rank): the k best documents per query.

    Ties go to the earlier document. With `pad_zero`, a query that matches fewer
    than k documents is filled up with unmatched ones in corpus order.
    """

    return per_batch(queries.select("query_id", "query_text"), lambda batch: batch_topk(batch, index, k, pad_zero))


def batch_topk(batch: Batch, index: Bm25Index, k: int, pad_zero: bool) -> DataFrame:
    """Top-k for one measured batch of queries."""
    scored = _best_scores(batch, index, k)
    if pad_zero:
        scored = scored.unionByName(_unmatched(batch.queries, index, k))
    return _best(scored, k)
