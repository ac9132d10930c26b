"""The stored keyword index: same answers as the plan without one, through any run of changes."""

import random

import pytest
from pyspark.sql import functions as F

from lakesearch.operators import bm25, postings
from lakesearch.operators.batches import Batch

WORDS = [f"w{i}" for i in range(400)]


def texts(rng, n, first=0):
    """Frequent words, rare ones and lengths of all kinds."""
    return [(first + i, " ".join(rng.choices(WORDS, [1 / (j + 1) for j in range(len(WORDS))], k=rng.choice([0, 3, 30, 200])))) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc long, text string")


def asked(spark):
    rows = [(1, "w0"), (7, "w0 w1 w390"), (2, "w5 w5 w17 nowhere"), (3, ""), (4, "nowhere at all"), (5, " ".join(WORDS[:40])), (None, "w2 w3")]
    return spark.createDataFrame(rows, "query_id long, query_text string")


def best(df):
    return sorted((str(r["query_id"]), r["rank"], r["doc"], round(r["score"], 8)) for r in df.collect())


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(postings, "BLOCK", 4)
    monkeypatch.setattr(postings, "FANOUT", 3)


@pytest.mark.parametrize("k", [1, 7])
@pytest.mark.parametrize("pushed", [0, 1000])
def test_same_rows_as_without_an_index(spark, tmp_path, small_blocks, monkeypatch, k, pushed):
    monkeypatch.setattr(postings, "PUSHED_TERMS", pushed)
    rng = random.Random(4)
    docs = frame(spark, texts(rng, 300)).repartition(3)
    store = postings.SegmentIndex(spark, str(tmp_path / "i"))
    store.build(docs, 1)
    q = Batch(asked(spark), True)
    reader = store.open(docs)
    assert best(reader.topk(q, k)) == best(bm25.batch_topk(q, bm25.build_index(docs), k, True))
    row = reader.blocks_read(Batch(asked(spark).where("query_id = 1"), True), k).first()
    assert 0 < row["read"] < row["of_terms"] < row["all"]


def test_changes_give_the_index_of_the_whole(spark, tmp_path, small_blocks):
    rng = random.Random(9)
    now = dict(texts(rng, 60))
    store = postings.SegmentIndex(spark, str(tmp_path / "i"))
    store.build(frame(spark, list(now.items())), 1)
    for version in range(2, 9):
        came = texts(rng, rng.randrange(12), 1000 * version)
        gone = [(d, now.pop(d)) for d in rng.sample(sorted(now), 5)]
        now.update(came)
        store.apply(frame(spark, came), frame(spark, gone), version)
    docs = frame(spark, list(now.items()))
    reader, whole = store.open(docs), bm25.build_index(docs)
    assert store.silver_version() == 8 and len(store.state()["segments"]) < 8
    lengths = bm25.doc_lengths(docs).agg(F.sum("dl")).first()[0]
    assert (reader.n_docs, reader.total_len) == (len(now), lengths)
    idf = lambda df: {r["term"]: (r["df"], round(r["idf"], 9)) for r in df.collect()}
    assert idf(reader.idf()) == idf(whole.idf)
    q = Batch(asked(spark), True)
    assert best(reader.topk(q, 5)) == best(bm25.batch_topk(q, whole, 5, True))
    assert best(reader.topk(Batch(asked(spark), False), 5)) == best(bm25.batch_topk(q, whole, 5, True))
    assert store.expire() > 0
    assert best(store.open(docs).topk(q, 5)) == best(bm25.batch_topk(q, whole, 5, True))


def test_a_new_document_is_all_that_is_tokenised(spark, tmp_path, monkeypatch):
    docs = frame(spark, texts(random.Random(1), 40))
    store = postings.SegmentIndex(spark, str(tmp_path / "i"))
    store.build(docs, 1)
    seen = []
    original = bm25.postings_of
    monkeypatch.setattr(bm25, "postings_of", lambda d: (seen.append(d.count()), original(d))[1])
    store.apply(frame(spark, [(99, "w1 brand new")]), frame(spark, []), 2)
    assert sorted(seen) == [0, 1]


def test_negative_floor_and_empty_corpus(spark, tmp_path):
    docs = frame(spark, [(i, "a b" if i % 2 else "a c") for i in range(6)])  # `a` is in every document
    store = postings.SegmentIndex(spark, str(tmp_path / "i"))
    store.build(docs, 1)
    q = Batch(spark.createDataFrame([(1, "a b"), (2, "a")], "query_id long, query_text string"), True)
    assert best(store.open(docs).topk(q, 3)) == best(bm25.batch_topk(q, bm25.build_index(docs), 3, True))
    nothing = postings.SegmentIndex(spark, str(tmp_path / "e"))
    nothing.build(docs.limit(0), 1)
    assert nothing.open(docs.limit(0)).topk(q, 3).isEmpty()


def test_filters_reach_the_files(spark, tmp_path):
    docs = frame(spark, texts(random.Random(2), 100))
    store = postings.SegmentIndex(spark, str(tmp_path / "i"))
    store.build(docs, 1)
    q = Batch(asked(spark).where("query_id = 1"), True)
    plan = store.open(docs).scores(q, 3)._jdf.queryExecution().executedPlan().toString()
    assert "term" in plan and "GreaterThanOrEqual(top" in plan and "BroadcastNestedLoop" not in plan


def test_a_term_on_many_ranges(spark, tmp_path):
    """One word in every document: its postings are cut into blocks by several tasks."""
    docs = spark.range(5000).select(F.col("id").alias("doc"), F.concat(F.lit("all "), F.expr("repeat('x ', int(id % 50))"), F.when(F.col("id") % 100 == 7, F.lit("rare")).otherwise("y")).alias("text"))
    store = postings.SegmentIndex(spark, str(tmp_path / "i"))
    store.build(docs, 1)
    reader = store.open(docs)
    assert reader.blocks.where("term = 'all'").agg(F.sum("size")).first()[0] == 5000
    q = Batch(spark.createDataFrame([(1, "rare all")], "query_id long, query_text string"), True)
    assert best(reader.topk(q, 20)) == best(bm25.batch_topk(q, bm25.build_index(docs), 20, True))


def test_postings_are_no_table_of_their_own(spark, tmp_path, monkeypatch):
    """What is written beside a segment is a row a document, or a row a term that went."""
    seen = []
    monkeypatch.setattr(postings, "written", lambda df, kept=postings.written: (seen.append(set(df.columns)), kept(df))[1])
    store = postings.SegmentIndex(spark, str(tmp_path / "i"))
    store.build(frame(spark, [(1, "a b b"), (2, "a c")]), 1)
    store.apply(frame(spark, [(3, "a d")]), frame(spark, [(2, "a c")]), 2)
    assert seen and not any("tf" in columns for columns in seen)
    terms = {r["term"]: r["df"] for r in store.open(frame(spark, [])).terms.groupBy("term").agg(F.sum("df").alias("df")).collect()}
    assert terms == {"a": 2, "b": 1, "c": 0, "d": 1} and [s["rows"] for s in store.state()["segments"]] == [4, 4]
