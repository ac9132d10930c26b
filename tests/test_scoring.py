"""Matrix scores in tasks against plain sums, and what grows with the number of queries."""

import collections
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from lakesearch.operators import bm25, postings, scoring
from lakesearch.operators.batches import Batch
from lakesearch.operators.scoring import Weights


def plain(docs, weights, k, mean):
    """(n, doc): the k best of each query, by loops."""
    scores = collections.defaultdict(float)
    for doc, tokens in docs:
        for q, t, w in zip(weights.q, weights.t, weights.w):
            tf = tokens.count(weights.terms[t])
            if tf:
                scores[q, doc] += w * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(tokens) / mean))
    by = collections.defaultdict(list)
    for (q, d), s in scores.items():
        by[q].append((-round(s, 9), d))
    return {(q, d): -s for q, x in by.items() for s, d in sorted(x)[:k]}


@pytest.mark.parametrize("least, cells, tokens", [(0.1, 1_000_000, 250_000), (-1.0, 12, 7), (0.1, 3, 1)])
def test_matrix_scores_against_loops(monkeypatch, least, cells, tokens):
    monkeypatch.setattr(scoring, "CELLS", cells)
    monkeypatch.setattr(scoring, "TOKENS", tokens)
    rng = random.Random(3)
    docs = [(i, [f"w{rng.randrange(9)}" for _ in range(rng.randrange(8))]) for i in range(60)]
    pairs = [(q, t) for q in range(1, 7) for t in sorted(rng.sample(range(5), 2))]
    weights = Weights([f"w{i}" for i in range(5)], *map(np.array, zip(*pairs)), np.array([rng.uniform(least, 2) for _ in pairs]))
    batches = [
        pa.RecordBatch.from_arrays([pa.array([d for d, _ in x]), pa.array([t for _, t in x], pa.list_(pa.string())), pa.array([4.0] * len(x))], names=["doc", "tokens", "mean"])
        for x in (docs[:25], docs[25:])
    ]
    got = next(scoring.best_of_texts(SimpleNamespace(value=weights), 4, 1.5, 0.75)(iter(batches))).to_pylist()
    want = plain(docs, weights, 4, 4.0)
    assert {(r["n"], r["doc"]): round(r["score"], 9) for r in got} == pytest.approx(want)
    # The same from rows of postings, a document over two batches.
    rows = [(d, int(t[1:]), tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(x) / 4.0))) for d, x in docs for t, tf in collections.Counter(x).items() if int(t[1:]) < 5]
    parts = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + 7])], names=["doc", "t", "share"]) for i in range(0, len(rows), 7)]
    got = next(scoring.best_of_postings(SimpleNamespace(value=weights), 4)(iter(parts))).to_pylist()
    assert {(r["n"], r["doc"]): round(r["score"], 9) for r in got} == pytest.approx(want)


def test_no_row_for_a_posting_and_a_query(spark, tmp_path, monkeypatch):
    """Forty queries of the same words: tasks are given a document, or a posting, once."""
    docs = spark.createDataFrame([(i, f"a b{i % 3} c") for i in range(30)], "doc long, text string")
    queries = Batch(spark.createDataFrame([(i, "a b1 c") for i in range(40)], "query_id long, query_text string"), True)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate explode" not in plan(bm25._best_scores(queries, bm25.build_index(docs), 3)).split("MapInArrow")[-1]
    store = postings.SegmentIndex(spark, str(tmp_path / "i"))
    store.build(docs, 1)
    seen = []
    whole = postings.Reader._postings
    monkeypatch.setattr(postings.Reader, "_postings", lambda self, needs, *x: (seen.append((needs.columns, out := whole(self, needs, *x))), out)[1])
    got = store.open(docs).topk(queries, 3)
    assert sorted(map(tuple, got.select("query_id", "doc").collect())) == sorted((q, d) for q in range(40) for d in (1, 4, 7))
    needs, rows = seen[-1]
    assert "n" not in needs and rows.count() <= 90  # 30 documents of three terms
