"""The fit uses every labelled row that is not held out, however many there are and however they lie."""

import numpy as np
from pyspark.sql import functions as F

from lakesearch.llm import toxicity


def test_every_training_row_is_learned_and_no_other(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 1000)
    monkeypatch.setattr(toxicity, "FAN", 2)
    n = 6000
    # One word a text: it wins every pooling, so learning the row changes the word's numbers.
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.format_string("word%06dxx", "id").alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    net = toxicity.fit(docs, labels)
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(10)) < toxicity.CALIBRATION_TENTHS
    rows = docs.select("doc_id", "text", (~toxicity.held_out(F.col("doc_id")) & ~part).alias("train")).toPandas()
    word = toxicity.layout(rows["text"].tolist())[0][0].reshape(-1, 3)[:, 0]
    learned = (net.e[word] != toxicity.Net().e[word]).any(axis=1)
    assert rows["train"].sum() > 3000 and learned[rows["train"]].all()
    assert learned[~rows["train"]].mean() < 0.2  # words that share a number
    # Where rows lie, rows that come twice, and a list of labels too long to broadcast change nothing.
    monkeypatch.setattr(toxicity, "BROADCAST_ROWS", 0)
    again = toxicity.fit(docs.repartition(7).unionByName(docs.limit(500)), labels.unionByName(labels))
    assert np.array_equal(again.e, net.e) and all(np.array_equal(a, b) for a, b in zip(again.w, net.w))
    assert np.allclose(again.shift, net.shift)


def test_long_and_empty_texts_are_learned(spark):
    filler = "plain words of no interest " * 4000
    ids = [i for i in range(400) if i % 2 or i % 3]
    rows = [(i, None if i % 40 == 1 else f"{filler}{'vile' if i % 2 else 'kind'} end") for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    net = toxicity.fit(docs, docs.select("doc_id", (F.col("text").contains("vile")).cast("int").alias("toxic")).fillna(0))
    found = {r.doc_id: r.predicted for r in toxicity.score(docs, net).collect()}
    assert len(found) == len(ids)
    assert np.mean([found[i] == (text is not None and "vile" in text) for i, text in rows]) > 0.95


def test_thresholds_are_the_best_over_all_rows(spark):
    rng = np.random.default_rng(3)
    logit, toxic, name = rng.integers(-40, 40, 3000) / 8, rng.integers(0, 2, 3000), rng.integers(0, 3, 3000)
    toxic = np.where(rng.random(3000) < 0.8, logit > name, toxic).astype(int)
    rows = spark.createDataFrame([(int(k), float(x), int(t)) for k, x, t in zip(name, logit, toxic)], "language int, logit double, toxic long").repartition(5)

    def best(x, t):
        places = np.unique(x)[::-1]
        f1 = np.array([2 * t[x >= p].sum() / ((x >= p).sum() + t.sum()) for p in places])
        i = int(np.argmax(f1))
        return (places[i] + (places[i + 1] if i + 1 < len(places) else places[i] - 1)) / 2, t.sum()

    assert toxicity._best_cuts(rows, []) == {(): best(logit, toxic)}
    assert toxicity._best_cuts(rows, ["language"]) == {(k,): best(logit[name == k], toxic[name == k]) for k in range(3)}


def test_a_model_of_one_shard_is_that_of_its_texts(spark):
    texts, toxic = [f"good {i} day" if i % 3 else f"you clown {i}" for i in range(60)], [int(i % 3 == 0) for i in range(60)]
    rows = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(zip(texts, toxic))], "doc_id long, text string, toxic int")
    one, here = toxicity.train_shards(rows, 1), toxicity.train(texts, np.array(toxic, float))
    assert np.allclose(one.e, here.e, atol=1e-3) and np.allclose(one.u, here.u, atol=1e-3)
