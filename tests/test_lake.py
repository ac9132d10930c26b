"""Refresh by what changed: buckets, change log, merged vectors, tiers. All against a rebuild of the whole."""

import random

import pytest
from pyspark.sql import functions as F

from lakesearch.functions.embed import hashed_embedder
from lakesearch.operators import bm25, silver, vectors
from lakesearch.operators.batches import Batch
from lakesearch.plans.refresh import Lake
from lakesearch.schemas import LEDGER, SILVER_COLUMNS
from lakesearch.sources import bronze, tables
from lakesearch.sources.tables import MergedTable, Table


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), dim=16, embedder=hashed_embedder(16))


def land(spark, lake, batch, rows, at):
    """Stories (id, title, text) that arrive at second `at`."""
    df = spark.createDataFrame(rows, "id long, title string, text string")
    df = df.select(F.lit("k").alias("key"), "id", "title", F.lit("by").alias("by"), F.col("id").alias("time"), F.lit("story").alias("type"), "text")
    df = df.withColumns({"url": F.lit(None).cast("string"), "score": F.lit(1).cast("long"), "descendants": F.lit(0).cast("long")})
    bronze.append_bronze(bronze.with_bronze_columns(df, F.timestamp_seconds(F.lit(1704067200 + at))), lake.bronze_root, batch)


def rows_of(df):
    return sorted(tuple(str(r[c]) for c in SILVER_COLUMNS) for r in df.collect())


def whole(spark, lake):
    return silver.build_silver(bronze.read_bronze(spark, lake.bronze_root))


def runs(lake):
    return lake.silver.state()["runs"]


def test_refresh_by_change_equals_a_rebuild(spark, lake):
    rng = random.Random(3)
    land(spark, lake, "b0", [(i, f"title {i % 40}", f"some longer text {i % 40}") for i in range(60)], 0)
    assert lake.refresh() == 40
    for step in range(1, 5):
        rows = [(100 * step + i, f"title {(t := rng.randrange(60))}", f"some longer text {t}") for i in range(rng.randrange(1, 9))]
        land(spark, lake, f"b{step}", rows, 100 * step)
        lake.refresh()
        assert rows_of(lake.silver.read()) == rows_of(whole(spark, lake))
    texts = {r["text"] for r in lake.silver.read().collect()}
    assert {r["payload"]["text"] for r in lake.store.points().collect()} == texts and lake.store.points().count() == len(texts)
    # Numbers rise with arrival, name their bucket, and are those that the index knows.
    numbered = sorted((r["doc_order"], r["_ingested_at"], r["id"], r["doc_part"]) for r in lake.silver.read().collect())
    assert [r[1:3] for r in numbered] == sorted(r[1:3] for r in numbered) and len({r[0] for r in numbered}) == len(numbered)
    assert all(r[0] & (silver.BUCKETS - 1) == r[3] for r in numbered)
    docs = bm25.corpus(lake.silver.read())
    q = Batch(spark.createDataFrame([(1, "title 7"), (2, "longer text 33 44"), (3, "none")], "query_id long, query_text string"), True)
    got, want = (sorted((r["query_id"], r["rank"], r["doc"], round(r["score"], 8)) for r in df.collect()) for df in (lake.index.open(docs).topk(q, 9), bm25.batch_topk(q, bm25.build_index(docs), 9, True)))
    assert got == want
    assert lake.changes.read().isEmpty()


def test_one_changed_story_writes_one_bucket(spark, lake):
    land(spark, lake, "a", [(i, f"title {i}", f"a text of its own {i}") for i in range(300)], 0)
    lake.refresh()
    before, files = runs(lake), lake.index.state()["segments"]
    land(spark, lake, "b", [(900, "title 5", "a text of its own 5")], 50)  # a later arrival of a known text
    assert lake.refresh() == 0
    after = runs(lake)
    assert sum(before[b] != after[b] for b in before) == 1 and set(before) == set(after)
    assert lake.silver.read().where("title = 'title 5'").first()["id"] == 900
    new = [s for s in lake.index.state()["segments"] if s not in files]
    assert len(new) == 1 and new[0]["n_docs"] == 0  # one went, one came
    assert lake.silver.expire() > 0 and lake.silver.read().count() == 300


def test_old_arrivals_and_compacted_files_change_nothing(spark, lake):
    land(spark, lake, "a", [(i, "title", f"a text of its own {i}") for i in range(20)], 500)
    lake.refresh()
    version = lake.silver.version()
    land(spark, lake, "b", [(3, "title", "a text of its own 3")], 10)  # arrived earlier than what is there
    assert lake.refresh() == 0 and lake.silver.version() == version
    bronze.compact_bronze(spark, lake.bronze_root)
    assert lake.refresh() == 0 and lake.silver.version() == version
    assert rows_of(lake.silver.read()) == rows_of(whole(spark, lake))


@pytest.mark.parametrize("broken", ["silver", "source", "synced", "index"])
def test_a_refresh_cut_short_is_finished_by_the_next(spark, lake, monkeypatch, broken):
    land(spark, lake, "a", [(i, "title", f"a text of its own {i}") for i in range(20)], 0)
    lake.refresh()
    land(spark, lake, "b", [(40 + i, "title", f"a text of its own {15 + i}") for i in range(10)], 100)

    def crash(*args, **kwargs):
        raise KeyboardInterrupt

    target = {"silver": (lake.silver, "write"), "source": (lake.source, "append"), "synced": (lake.store, "note_synced"), "index": (lake.index, "apply")}[broken]
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(*target, crash)
        lake.refresh()
    land(spark, lake, "c", [(80, "title", "the very last text")], 200)
    lake.refresh()
    assert rows_of(lake.silver.read()) == rows_of(whole(spark, lake))
    assert lake.store.points().count() == 26
    docs = bm25.corpus(lake.silver.read())
    reader = lake.index.open(docs)
    assert reader.n_docs == 26
    found = reader.postings().select("doc").distinct()
    assert found.exceptAll(docs.select("doc")).isEmpty() and docs.select("doc").exceptAll(found).isEmpty()


def point(spark, ids, by):
    return spark.createDataFrame([(str(i), f"h{i}", [float(i), 1.0], ("t", "t", i, by, None, 1, 1)) for i in ids], "point_id string, content_hash string, vector array<float>, payload struct<text:string,title:string,id:long,by:string,url:string,score:long,time:long>")


def test_a_clash_rewrites_no_vector(spark, tmp_path):
    store = vectors.VectorStore(spark, str(tmp_path), 2)
    store.ensure()
    store.upsert(point(spark, range(100), "old"))
    first = store.vectors.parts()
    store.upsert(point(spark, [3, 4, 200], "new"))
    assert store.vectors.parts()[: len(first)] == first and len(store.vectors.parts()) == 2
    by = {r["point_id"]: r["payload"]["by"] for r in store.points().collect()}
    assert len(by) == store.points().count() == 101 and by["3"] == by["200"] == "new" and by["5"] == "old"
    store.upsert(point(spark, [3], "newest"))
    assert {r["point_id"]: r["payload"]["by"] for r in store.points().collect()}["3"] == "newest" and store.points().count() == 101
    reader = store.points()
    store.upsert(point(spark, range(50), "third"))  # more than a tenth is dead now: folded in
    assert store.vectors.state()["dead"] == [] and store.points().count() == 101
    assert reader.count() == 101  # a reader keeps what it started with
    assert store.vectors.expire() > 0 and store.points().count() == 101


def test_parts_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_PART", 1)
    table = Table(spark, str(tmp_path / "t"), LEDGER)
    for i in range(20):
        table.append(spark.createDataFrame([(f"h{i}", "text")], LEDGER))
        before = table.read()
        table.compact(4)
        assert len(table.parts()) <= 3 * 3
        assert before.count() == table.read().count() == i + 1
    assert table.expire() >= 20 and table.read().distinct().count() == 20


def test_merged_table_keeps_the_order_of_changes_through_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "SMALL_PART", 1 << 20)
    monkeypatch.setattr(MergedTable, "FOLD_SHARE", 9.0)
    table = MergedTable(spark, str(tmp_path / "t"), LEDGER, "content_hash")
    want = {}
    rng = random.Random(5)
    for step in range(9):
        keys = rng.sample(range(12), 4)
        rows = spark.createDataFrame([(f"h{k}", f"step {step}") for k in keys], LEDGER)
        clash = rows.join(table.read().select("content_hash"), "content_hash", "left_semi")
        table.merge(rows, clash)
        want |= {f"h{k}": f"step {step}" for k in keys}
        table.compact(3)
        assert {r[0]: r[1] for r in table.read().collect()} == want and table.read().count() == len(want)
    assert len(table.parts()) <= 3
