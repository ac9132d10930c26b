"""BM25, dense search, fusion and verdicts against plain Python on small corpora."""

import math
import random
import re
import statistics
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from lakesearch.operators import batches, bm25, dense, fusion

WORDS = [f"w{i}" for i in range(40)]


def make_corpus(seed=1, n=60, common=True):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        words = rng.choices(WORDS, weights=range(40, 0, -1), k=rng.randrange(0, 30))
        docs.append((i * 3 + 1, " ".join((["the"] if common and i % 4 else []) + words)))
    docs[n // 2] = (docs[n // 2][0], docs[0][1])  # a text that occurs twice
    return docs


QUERIES = [
    (1, "w1 W2 w1 w30"),  # a repeated token
    (2, "w39"),  # rare: needs padding
    (3, "nothing matches"),
    (4, "the"),  # in more than half of the documents
    (5, ""),
    (6, " ".join(WORDS)),
]


def python_scores(docs, query):
    toks = [t.lower().split() for _, t in docs]
    n, avgdl = len(docs), sum(map(len, toks)) / len(docs)
    df = {}
    for t in toks:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    raw = {w: math.log(n - c + 0.5) - math.log(c + 0.5) for w, c in df.items()}
    eps = 0.25 * sum(raw.values()) / len(raw)
    idf = {w: eps if v < 0 else v for w, v in raw.items()}
    out = []
    for t in toks:
        s = 0.0
        for w in query.lower().split():
            f = t.count(w)
            s += idf.get(w, 0) * f * 2.5 / (f + 1.5 * (0.25 + 0.75 * len(t) / avgdl))
        out.append(s)
    return out


def python_topk(docs, query, k=20):
    scores = python_scores(docs, query)
    order = sorted(range(len(docs)), key=lambda i: (-round(scores[i], 9), docs[i][0]))[:k]
    return [(docs[i][0], round(scores[i], 9)) for i in order]


def frames(spark, docs, queries=QUERIES):
    d = spark.createDataFrame(docs, "doc long, text string")
    q = spark.createDataFrame(queries, "query_id long, query_text string")
    return d, q


@pytest.mark.parametrize("docs", [make_corpus(), make_corpus(2, 9), make_corpus(3, 2)], ids=["60", "9", "2"])
def test_bm25_topk(spark, docs):
    d, q = frames(spark, docs)
    got = {}
    for r in bm25.bm25_topk(q, bm25.build_index(d)).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["doc"], round(r["score"], 9)))
    assert got == {i: python_topk(docs, text) for i, text in QUERIES}


def test_bm25_negative_floor(spark):
    """A vocabulary whose every term is in most documents: matches rank below the rest."""
    docs = [(i, "a b") for i in range(50)] + [(100 + i, "zz") for i in range(3)] + [(200 + i, "a b c") for i in range(30)]
    docs = [(i, t) for i, t in docs]
    vocabulary = {"a": 80, "b": 80, "c": 30, "zz": 3}
    assert sum(math.log(83 - c + 0.5) - math.log(c + 0.5) for c in vocabulary.values()) != 0
    tiny = [(i, "a b") for i in range(70)] + [(100 + i, "q") for i in range(3)]
    for corpus in (docs, tiny, [(1, "a")]):
        d, q = frames(spark, corpus, [(1, "a"), (2, "none")])
        got = {}
        for r in bm25.bm25_topk(q, bm25.build_index(d)).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["doc"], round(r["score"], 9)))
        assert got == {1: python_topk(corpus, "a"), 2: python_topk(corpus, "none")}


def test_bm25_without_padding(spark):
    docs = make_corpus()
    d, q = frames(spark, docs)
    index = bm25.build_index(d)
    got = {(r["query_id"], r["doc"]): r["score"] for r in bm25.bm25_scores(q, index).collect()}
    for i, text in QUERIES:
        for (doc, words), s in zip(docs, python_scores(docs, text)):
            shares = set(text.lower().split()) & set(words.lower().split())
            assert ((i, doc) in got) == bool(shares)
            if shares:
                assert got[i, doc] == pytest.approx(s, abs=1e-9)
    top = bm25.bm25_topk(q, index, pad_zero=False)
    assert top.where("query_id = 3").count() == 0


def test_unbroadcast_join_gives_the_same(spark):
    docs = make_corpus()
    d, q = frames(spark, docs)
    index = bm25.build_index(d)
    whole = bm25.batch_topk(batches.Batch(q, True), index, 20, True)
    salted = bm25.batch_topk(batches.Batch(q, False), index, 20, True)
    as_set = lambda df: {(r["query_id"], r["doc"], r["rank"], round(r["score"], 9)) for r in df.collect()}
    assert as_set(whole) == as_set(salted)


def test_query_batches_are_disjoint_and_complete(spark):
    q = spark.range(100).selectExpr("id AS query_id", "repeat('x', 10) AS query_text")
    parts = batches.query_batches(q, max_rows=30)
    assert len(parts) > 1 and all(p.fits and p.queries.count() <= 30 for p in parts)
    ids = [r["query_id"] for p in parts for r in p.queries.collect()]
    assert sorted(ids) == list(range(100))
    giant = batches.query_batches(q, max_bytes=5)
    assert sum(p.queries.count() for p in giant) == 100 and not any(p.fits for p in giant)


def python_dense(vectors, query, k):
    q = np.array(query, dtype=float)
    scored = []
    for doc, v in vectors:
        v = np.array(v, dtype=np.float32).astype(float)
        norm = np.linalg.norm(v) * np.linalg.norm(q)
        scored.append((doc, None if norm == 0 else round(float(v @ q / norm), 9)))
    return sorted(scored, key=lambda p: (-(p[1] if p[1] is not None else -9), p[0]))[:k]


@pytest.mark.parametrize("k", [1, 5, 20, 500])
def test_dense_topk(spark, k):
    rng = np.random.default_rng(5)
    vectors = [(i, rng.integers(-2, 3, 6).astype(float).tolist()) for i in range(300)]
    vectors[10] = (10, [0.0] * 6)
    queries = [(j, rng.integers(-2, 3, 6).astype(float).tolist()) for j in range(7)]
    queries.append((7, [0.0] * 6))
    v = spark.createDataFrame(vectors, "doc long, vector array<float>").repartition(5)
    q = spark.createDataFrame(queries, "query_id long, query_vector array<double>")
    got = {}
    for r in dense.dense_topk(q, v, k).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["doc"], r["score"]))
    for j, query in queries:
        want = python_dense(vectors, query, k)
        assert [d for d, _ in got[j]] == [d for d, _ in want]
        assert [s for _, s in got[j]] == pytest.approx([s for _, s in want], abs=1e-8)


def test_dense_wrong_length_raises(spark):
    v = spark.createDataFrame([(1, [1.0, 2.0])], "doc long, vector array<float>")
    q = spark.createDataFrame([(1, [1.0])], "query_id long, query_vector array<double>")
    with pytest.raises(Exception, match="length other than 1"):
        dense.dense_topk(q, v).collect()


def test_dense_small_steps(spark, monkeypatch):
    """The running bar across many slices gives the same winners."""
    rng = np.random.default_rng(8)
    data = [(i, rng.integers(-1, 2, 4).astype(np.float32)) for i in range(200)]
    matrix = rng.integers(-1, 2, (3, 4)).astype(float) + 0.1
    monkeypatch.setattr(dense, "_CELLS", 21)
    import pyarrow as pa

    run = dense._local_topk(matrix, np.array([0, 1, 2]), 5, 9)
    batch = [
        pa.RecordBatch.from_arrays(
            [pa.array([d for d, _ in part]), pa.array([v.tolist() for _, v in part], pa.list_(pa.float32())), pa.array([str(d) for d, _ in part])],
            names=["doc", "vector", "ref"],
        )
        for part in (data[:120], data[120:])
    ]
    out = next(run(iter(batch))).to_pylist()
    for j in range(3):
        mine = [(r["doc"], r["ref"]) for r in out if r["query_id"] == j]
        assert mine == [(d, str(d)) for d, _ in python_dense(data, matrix[j], 5)]


def python_fuse(near, found, k=60):
    fused, info = {}, {}
    for rank, (text, score, payload) in enumerate(near):
        if not text:
            continue
        fused[text] = fused.get(text, 0.0) + 1 / (k + rank + 1)
        info[text] = [payload, score, None]
    for rank, (text, score, payload) in enumerate(found):
        fused[text] = fused.get(text, 0.0) + 1 / (k + rank + 1)
        info.setdefault(text, [payload, None, None])[2] = score
    return fused, info


def half_up(x):
    """Display rounding is half-up on decimal text; 1/64, rank 4 alone, is such a case."""
    return float(Decimal(repr(x)).quantize(Decimal("0.00001"), ROUND_HALF_UP))


def test_fusion_and_verdicts(spark):
    lists = {
        1: ([("a", 0.9, "d1"), ("b", 0.5, "d2"), ("a", 0.2, "d3"), ("", 0.1, "d4"), ("c", 0.05, "d5")],
            [("b", 9.0, "k1"), ("x", 6.0, "k2"), ("x", 4.0, "k3"), ("", 3.0, "k4"), ("y", 0.0, "k5"), ("z", 0.0, "k6")]),
        2: ([("only", 0.1, "d1")], [("only", 7.0, "k1")]),  # a pool of one: threshold 0
        3: ([("p", 0.4, "d1")], [("q", 8.0, "k1")]),  # equal scores: both clear their mean
        4: ([], [("none", 0.0, "k1"), ("of", 0.0, "k2")]),  # nothing clears a floor
    }
    rows = {"dense": [], "keyword": []}
    for qid, (near, found) in lists.items():
        for side, ranked in (("dense", near), ("keyword", found)):
            rows[side] += [(qid, t, s, i + 1, p) for i, (t, s, p) in enumerate(ranked)]
    schema = "query_id long, text string, score double, rank int, payload string"
    fused = fusion.rrf_fuse(spark.createDataFrame(rows["dense"], schema), spark.createDataFrame(rows["keyword"], schema))
    got = {}
    for r in fusion.verdicts(fused).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r)
    for qid, (near, found) in lists.items():
        scores, info = python_fuse(near, found)
        pool = list(scores.values())
        threshold = 0.0 if len(pool) < 2 else statistics.mean(pool) + 0.5 * statistics.pstdev(pool)
        order = sorted(scores.items(), key=lambda kv: round(kv[1], 12), reverse=True)[:5]
        want = []
        for text, f in order:
            payload, d, b = info[text]
            ok = f >= threshold - 1e-12 and ((d is not None and d >= 0.3) or (b is not None and b >= 5.0))
            want.append((text, half_up(f), d, b, ok, half_up(threshold), payload))
        have = [(r["text"], r["fused_score"], r["dense_score"], r["bm25_score"], r["grounded"], r["dynamic_threshold"], r["payload"]) for r in got[qid]]
        assert have == want
    assert [r["grounded"] for r in got[3]] == [True, True]


def test_equal_scores_clear_their_threshold(spark):
    """One pool of equal scores per size, up to the largest there can be."""
    rows = [(size, 1.0 / (60 + rank), 0.9, None) for rank in (1, 7) for size in range(2, 41) for _ in range(size)]
    df = spark.createDataFrame(
        [(size * 100 + int(1 / f), f, d, b) for size, f, d, b in rows],
        "query_id long, fused_score double, dense_score double, bm25_score double",
    )
    assert fusion.with_threshold(df).where(~fusion.is_grounded()).count() == 0


def test_display_rows(spark):
    row = (1, 1, "T: body", 0.03, None, 5.25, True, 0.02, ("T: body", "T", 9, "bob"))
    schema = (
        "query_id long, rank int, text string, fused_score double, dense_score double, bm25_score double, "
        "grounded boolean, dynamic_threshold double, payload struct<text: string, title: string, id: long, by: string>"
    )
    r = fusion.display_rows(spark.createDataFrame([row], schema)).first()
    assert (r["Dense"], r["BM25"], r["Fused"], r["Threshold"], r["Grounded"]) == ("—", "5.2500", "0.03000", "0.02000", "Yes")
    assert (r["Article Title"], r["Event / Edit Details"], r["Author"]) == ("T", "body", "bob")
    assert r["Hacker News Link"].endswith("id=9")


def test_no_broadcast_nested_loop(spark):
    d, q = frames(spark, make_corpus())
    plan = bm25.bm25_topk(q, bm25.build_index(d))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_topk_shuffles_no_pairs(spark):
    d, q = frames(spark, make_corpus())
    plan = bm25.bm25_topk(q, bm25.build_index(d))._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and not re.search(r"Exchange hashpartitioning\(query_id#\d+L?, doc#", plan)


def test_hits_of_a_document_over_several_arrow_batches(spark):
    d, q = frames(spark, make_corpus())
    index = bm25.build_index(d)
    want = sorted(map(tuple, bm25._best(bm25.bm25_scores(q, index), 3).select("query_id", "rank", "doc").collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        got = bm25.bm25_topk(q, index, 3, pad_zero=False).select("query_id", "rank", "doc").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert want and sorted(map(tuple, got)) == want


def test_query_batches_end_with_one_id(spark):
    q = spark.range(10).selectExpr("CAST(NULL AS BIGINT) AS query_id", "'same' AS query_text")
    parts = batches.query_batches(q, max_rows=3)
    assert [(p.queries.count(), p.fits) for p in parts] == [(10, False)]


@pytest.mark.parametrize("max_rows", [1, 2, 4096])
def test_rows_that_share_an_id_are_one_query(spark, monkeypatch, max_rows):
    """However the set is cut: k rows for each id, of all its rows."""
    d, _ = frames(spark, make_corpus())
    index = bm25.build_index(d)
    q = spark.createDataFrame([(1, "w3 w7"), (1, "w9"), (1, "w3"), (2, "w5"), (None, "w8"), (None, "w9")], "query_id long, query_text string")
    found = batches.per_batch(q, lambda b: index.topk(b, 2), max_rows)
    joined = spark.createDataFrame([(1, "w3 w7 w9 w3"), (2, "w5"), (None, "w8 w9")], "query_id long, query_text string")
    key = lambda df: sorted((str(r["query_id"]), r["rank"], r["doc"], round(r["score"], 8)) for r in df.collect())
    assert key(found) == key(bm25.bm25_topk(joined, index, 2)) and len(key(found)) == 6
    rng = np.random.default_rng(2)
    v = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(50)], "doc long, vector array<double>")
    near = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in (1, 1, 1, 2, None)], "query_id long, query_vector array<double>")
    near = near.unionByName(near)
    monkeypatch.setattr(dense, "row_parts", lambda df: batches.row_parts(df, 2))
    out = batches.per_batch(near, lambda b: dense.measured_topk(b, v, 3, "doc", "vector"), max_rows)
    want = dense.dense_topk(near, v, 3)
    assert key(out) == key(want) and len(key(out)) == 9
    assert out.select("query_id", "doc").distinct().count() == 9


def test_equal_vectors_keep_k_a_query(spark):
    v = spark.range(100_000).select(F.col("id").alias("doc"), F.array(F.lit(1.0), F.lit(2.0)).alias("vector"))
    q = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(20)], "query_id long, query_vector array<double>")
    found = dense.dense_topk(q, v, 5).collect()
    assert sorted((r["query_id"], r["doc"]) for r in found) == [(i, d) for i in range(20) for d in range(5)]
