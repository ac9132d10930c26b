"""Streams from folders, and the composite jobs."""

import json
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from lakesearch.functions.embed import hashed_embedder
from lakesearch.operators import telemetry
from lakesearch.plans.refresh import Lake
from lakesearch.sources.bronze import append_bronze, read_bronze
from lakesearch.streaming import counters, jobs


def story(i, **changes):
    return json.dumps({"id": i, "title": f"title {i}", "by": "b", "time": 1704067200 + i, "type": "story", "text": f"words of {i}"} | changes)


def drop_file(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def run_chain(spark, tmp_path, max_files=None):
    raw = jobs.read_text_folder(spark, str(tmp_path / "in"), max_files)
    q = jobs.start_validator(raw, str(tmp_path / "topics"), str(tmp_path / "cp1"), drain=True)
    q.awaitTermination(120)
    validated = jobs.read_message_folder(spark, str(tmp_path / "topics" / "validated" / "batch=*"), max_files)
    b = jobs.start_bronze_writer(validated, str(tmp_path / "bronze"), str(tmp_path / "cp2"), drain=True)
    b.awaitTermination(120)
    assert q.exception() is None and b.exception() is None
    return q


def test_raw_to_bronze(spark, tmp_path):
    drop_file(tmp_path / "in", "a.txt", [story(1), story(2, title=""), "{broken", "[1]"])
    q = run_chain(spark, tmp_path)
    metrics = [p.observedMetrics["validation"] for p in q.recentProgress if "validation" in p.observedMetrics]
    assert [(m["valid"], m["dlq"], m["total"]) for m in metrics if m["total"]] == [(1, 3, 4)]
    dead = spark.read.parquet(str(tmp_path / "topics" / "dlq"))
    assert sorted(r["reason"] for r in dead.collect()) == [
        "malformed_json: invalid JSON text",
        "malformed_json: not a JSON object",
        "validation_failed: String should have at least 1 character",
    ]
    drop_file(tmp_path / "in", "b.txt", [story(3), story(4)])
    run_chain(spark, tmp_path)  # picks up where it stopped
    rows = read_bronze(spark, str(tmp_path / "bronze"))
    assert sorted((r["id"], r["_kafka_key"], r["text"]) for r in rows.collect()) == [
        (i, "unknown", f"words of {i}") for i in (1, 3, 4)
    ]
    run_chain(spark, tmp_path)
    assert read_bronze(spark, str(tmp_path / "bronze")).count() == 3


def test_counters_survive_a_restart_and_equal_the_batch_counts(spark, tmp_path):
    root = str(tmp_path / "counts")
    assert counters.totals(spark, root).first() == (0, 0, 0)

    def run(lines):
        listener = counters.CounterListener(spark, root)  # a new driver has a listener of its own
        spark.streams.addListener(listener)
        try:
            for name, own in lines:
                drop_file(tmp_path / "in", name, own)
            return run_chain(spark, tmp_path, max_files=1)
        finally:
            spark._jsparkSession.sparkContext().listenerBus().waitUntilEmpty()
            time.sleep(1)  # the events of the bus are handed on to Python listeners
            spark.streams.removeListener(listener)

    run([("a.txt", [story(1), story(2, title=""), "{broken"]), ("b.txt", [story(3)])])
    first = counters.counts(spark, root).where("metric = 'validation'").count()
    q = run([("c.txt", [story(5), "[]"])])
    row = counters.totals(spark, root).first()
    dead = spark.read.parquet(str(tmp_path / "topics" / "dlq")).count()
    assert first >= 2 and (row["valid"], row["dlq"], row["total"]) == (3, dead, 6) == (3, 3, 6)
    # An event that comes twice counts once.
    again = counters.CounterListener(spark, root)
    for p in q.recentProgress:
        again.onQueryProgress(SimpleNamespace(progress=p))
    assert counters.totals(spark, root).first() == row
    snap = telemetry.snapshot(counters.stages(spark, root), F.lit(3), F.lit(3), F.lit(3), F.lit(3)).first()
    assert (snap["raw"], snap["validated"], snap["dlq"], snap["dlq_rate"], snap["health"]) == (6, 3, 3, 50.0, "bad")


def test_finished_batch_folder_is_left_alone(spark, tmp_path):
    path = str(tmp_path / "batch=1")
    jobs._write_once(spark.range(3), path)
    first = sorted(p.name for p in (tmp_path / "batch=1").glob("part-*"))
    jobs._write_once(spark.range(3), path)
    assert sorted(p.name for p in (tmp_path / "batch=1").glob("part-*")) == first
    (tmp_path / "batch=1" / "_SUCCESS").unlink()  # as after a crash in the middle
    jobs._write_once(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_a_new_stream_never_replaces_an_old_one(spark, tmp_path):
    for name in ("one", "two"):
        drop_file(tmp_path / f"in-{name}", "a.txt", [story(1 if name == "one" else 2)])
        raw = jobs.read_text_folder(spark, str(tmp_path / f"in-{name}"))
        jobs.start_validator(raw, str(tmp_path / name), str(tmp_path / f"cp-{name}"), drain=True).awaitTermination(120)
        validated = jobs.read_message_folder(spark, str(tmp_path / name / "validated" / "batch=*"))
        # Both start at batch 0 and land in the same Bronze.
        jobs.start_bronze_writer(validated, str(tmp_path / "bronze"), str(tmp_path / f"cpb-{name}"), drain=True).awaitTermination(120)
    assert sorted(r["id"] for r in read_bronze(spark, str(tmp_path / "bronze")).collect()) == [1, 2]


def test_new_ids(spark, tmp_path):
    drop_file(tmp_path / "in", "a.txt", [story(i) for i in (1, 2, 2, 3)])
    drop_file(tmp_path / "in", "b.txt", [story(i) for i in (3, 4, 1)])
    lines = jobs.read_text_folder(spark, str(tmp_path / "in"), max_files=1)
    items = lines.select(F.from_json("value", "id long, time long").alias("e")).select("e.*")
    primed = spark.createDataFrame([(4,)], "id long")
    for name, fresh in (("ids_plain", jobs.new_ids(items, primed)), ("ids_timed", jobs.new_ids(items, primed, "7 days"))):
        q = fresh.writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert sorted(r["id"] for r in spark.table(name).collect()) == [1, 2, 3]


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), dim=32, embedder=hashed_embedder(32))


def items(spark, rows):
    return spark.createDataFrame(rows, "id long, type string, title string, text string, by string, score long, time long")


def test_ingest_refresh_search(spark, lake):
    assert lake.refresh() == 0  # nothing there yet
    batch = items(
        spark,
        [(i, "story", f"title {i}", f"word{i} common text", "bob", 1, 100 + i) for i in range(1, 9)]
        + [(50, "job", "x", "y", "bob", 1, 1), (51, "story", None, "y", "bob", 1, 1)],
    )
    assert lake.ingest_batch(batch, "run-1", now=5) == (8, 2)
    assert lake.silver.read().count() == 8
    assert {r["point_id"] for r in lake.store.vectors.read().collect()} == {str(i) for i in range(1, 9)}
    # The same batch again changes nothing.
    assert lake.ingest_batch(batch, "run-1", now=5) == (8, 2)
    assert lake.silver.read().count() == 8 and lake.store.vectors.read().count() == 8
    assert read_bronze(spark, lake.bronze_root).where("batch = 'run-1'").select("id").distinct().count() == 8

    # The main path: Silver rebuilt from Bronze, snippets embedded under content ids.
    assert lake.refresh() == 8
    assert lake.refresh() == 0
    assert lake.store.vectors.read().count() == 16
    rows = lake.silver.read()
    assert {r["text"] for r in rows.collect()} == {f"title {i}: word{i} common text" for i in range(1, 9)}

    queries = spark.createDataFrame([(1, "word3"), (2, "zzz")], "query_id long, query_text string")
    top = lake.search(queries, bm25_floor=0.5).where("query_id = 1 AND rank = 1").first()
    assert top["text"] == "title 3: word3 common text" and top["grounded"]
    assert top["payload"]["id"] == 3
    assert not any(r["grounded"] for r in lake.search(queries).where("query_id = 2").collect() if r["dense_score"] in (None, 0.0))

    version = lake.silver.version()
    lake.ingest_batch(items(spark, [(99, "story", "fresh", "brandnew", "eve", 1, 1)]), "run-2", now=5)
    assert lake.silver.version() > version
    found = lake.search(spark.createDataFrame([(1, "brandnew")], "query_id long, query_text string"))
    assert any("brandnew" in r["text"] for r in found.collect())  # the keyword index has followed


def test_idle_refresh_leaves_silver_and_index(spark, lake):
    batch = [(i, "story", f"title {i}", "the same text", "bob", 1, 100 + i) for i in range(4)]
    lake.ingest_batch(items(spark, batch), "a", now=5)
    assert lake.refresh() == 4

    def state():
        return lake.silver.version(), lake.index.versions.latest(), lake.store.vectors.version()

    before = state()
    assert lake.refresh() == 0 and state() == before
    lake.search(spark.createDataFrame([(1, "same")], "query_id long, query_text string")).count()
    assert state() == before  # the refresh had built the index already
    append_bronze(read_bronze(spark, lake.bronze_root).withColumn("id", F.col("id") + 10).withColumn("title", F.concat("title", F.lit("b"))).drop("batch"), lake.bronze_root, "b")
    assert lake.refresh() == 4
    assert lake.silver.read().count() == 8 and state()[1] > before[1]


def test_refresh_ignores_empty_bronze(spark, lake):
    assert lake.build_silver() is False
    assert not lake.silver.exists()


def test_search_before_anything_is_there(spark, lake):
    lake.store.ensure()
    queries = spark.createDataFrame([(1, "word")], "query_id long, query_text string")
    assert lake.search(queries).count() == 0
