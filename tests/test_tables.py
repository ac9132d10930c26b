"""Bronze, Silver, vector tables and telemetry on small data in temporary folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakesearch.functions.embed import hashed_embedder, model_embedder
from lakesearch.operators import silver, telemetry, vectors
from lakesearch.schemas import BRONZE, LEDGER, SILVER, STORY_EVENT
from lakesearch.sources import bronze, kafka
from lakesearch.sources.files import Files
from lakesearch.sources.tables import Table, Versions


def stories(spark, rows):
    """rows: (id, title, text, url, _ingested_at)"""
    return spark.createDataFrame(rows, "id long, title string, text string, url string, _ingested_at string")


def test_silver_keeps_last_and_drops_short(spark):
    rows = [
        (1, "T", "<p>same</p>", None, "2024-01-01"),
        (2, "T", "same", None, "2024-01-03"),
        (3, "T", " same ", None, "2024-01-02"),
        (5, "T", "later id wins", None, "2024-01-01"),
        (4, "T", "later id wins", None, "2024-01-01"),
        (6, "abcd", None, None, "2024-01-01"),
        (7, "abcde", None, None, "2024-01-01"),
        (8, None, None, None, "2024-01-01"),
        (9, "L", "", "http://www.x.org/p", "2024-01-01"),
    ]
    df = stories(spark, rows)
    out = {r["text"]: r["id"] for r in silver.build_silver(df).collect()}
    assert out == {"T: same": 2, "T: later id wins": 5, "abcde": 7, "L (link: x.org)": 9}
    report = silver.dedup_report(df).first()
    assert tuple(report) == (9, 4, 5)
    assert silver.build_silver(df).columns == silver.SILVER_COLUMNS


def test_hot_duplicate_is_cut_before_the_shuffle(spark):
    df = spark.range(3000).select(
        "id",
        F.lit("t").alias("title"),
        F.when(F.col("id") < 2000, "the same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"),
        F.lit(None).cast("string").alias("url"),
        F.lpad(F.col("id").cast("string"), 6, "0").alias("_ingested_at"),
    )
    out = silver.build_silver(df)
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == 1001
    assert out.where("text = 't: the same text'").first()["id"] == 1999


@pytest.mark.parametrize("unique", [False, True])
def test_merge_by_id(spark, unique):
    old = stories(spark, [(1, "old", "a", None, "3"), (2, "old", "b", None, "1")])
    new = stories(spark, [(2, "new", "c", None, "1"), (3, "second", "d", None, "2"), (3, "first", "e", None, "1")])
    out = {r["id"]: r["title"] for r in silver.merge_by_id(old, new, existing_is_unique=unique).collect()}
    assert out == {1: "old", 2: "old", 3: "first"}
    if not unique:
        twice = old.unionByName(stories(spark, [(1, "older", "z", None, "0")]))
        assert silver.merge_by_id(twice, new).where("id = 1").collect()[0]["title"] == "older"


def test_doc_order_is_unique_and_follows_arrival(spark):
    df = spark.range(500).select(
        "id", F.col("id").cast("string").alias("text"), F.lpad((F.col("id") % 37).cast("string"), 4, "0").alias("_ingested_at")
    )
    rows = silver.with_doc_order(df.repartition(5)).collect()
    by_order = sorted(rows, key=lambda r: r["doc_order"])
    assert len({r["doc_order"] for r in rows}) == 500
    keys = [(r["_ingested_at"], r["id"]) for r in by_order]
    assert keys == sorted(keys)


def valid_events(spark, n, first=0):
    return spark.range(first, first + n).select(
        F.lit("k").alias("key"),
        "id",
        F.lit("title").alias("title"),
        F.lit("by").alias("by"),
        F.lit(1).cast("long").alias("time"),
        F.lit("story").alias("type"),
        F.concat(F.lit("text "), "id").alias("text"),
        F.lit(None).cast("string").alias("url"),
        F.lit(None).cast("long").alias("score"),
        F.lit(None).cast("long").alias("descendants"),
    )


def land(spark, root, batch, n, first, hour=5):
    now = F.timestamp_seconds(F.lit(1704067200 + hour * 3600))
    bronze.append_bronze(bronze.with_bronze_columns(valid_events(spark, n, first), now), root, batch)


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_bronze_layout_and_repeat(spark, tmp_path):
    root = str(tmp_path / "bronze")
    assert bronze.read_bronze(spark, root).count() == 0
    land(spark, root, "b1", 10, 0)
    land(spark, root, "b2", 5, 10, hour=17)
    land(spark, root, "b2", 5, 10, hour=17)  # the same batch again
    df = bronze.read_bronze(spark, root)
    assert ids(df) == list(range(15))
    assert {(r["date"], r["hour"]) for r in df.select("date", "hour").collect()} == {("2024-01-01", "05"), ("2024-01-01", "17")}
    assert df.first()["_ingested_at"].endswith("+00:00")
    stats = bronze.bronze_stats(df).first()
    assert stats["row_count"] == 15 and stats["file_count"] >= 2
    pruned = df.where("hour = '17'")
    assert "PartitionFilters: [isnotnull(hour" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 5


def test_bronze_reads_files_without_batch_folders(spark, tmp_path):
    root = str(tmp_path / "flat")
    df = valid_events(spark, 4).drop("url", "type", "descendants", "key")
    df = df.withColumn("date", F.lit("2024-01-01")).withColumn("hour", F.lit("07"))
    df.write.partitionBy("date", "hour").parquet(root)
    other = str(tmp_path / "other")
    land(spark, other, "x", 3, 100)
    both = bronze.read_bronze(spark, root, other)
    assert ids(both) == [0, 1, 2, 3, 100, 101, 102]
    assert both.where("hour = '07'").first()["url"] is None
    assert [f.name for f in both.schema] == BRONZE.fieldNames()


def test_compaction_twice_loses_nothing(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for i in range(4):
        land(spark, root, f"b{i}", 10, i * 10)
    land(spark, root, "solo", 3, 500, hour=9)
    land(spark, root, "new", 3, 600, hour=20)
    want = ids(bronze.read_bronze(spark, root))
    hours = bronze.compact_bronze(spark, root, before=("2024-01-01", "20"))
    assert ("2024-01-01", "05") in hours and ("2024-01-01", "20") not in hours
    assert ids(bronze.read_bronze(spark, root)) == want
    land(spark, root, "b9", 10, 900)
    want = ids(bronze.read_bronze(spark, root))
    bronze.compact_bronze(spark, root, before=("2024-01-01", "20"))
    assert ids(bronze.read_bronze(spark, root)) == want
    assert bronze.compact_bronze(spark, root, before=("2024-01-01", "20")) == []
    per_hour = bronze.read_bronze(spark, root).where("hour = '05'")
    assert bronze.bronze_stats(per_hour).first()["file_count"] == 1
    assert not Files(spark, root).list(f"{root}/_compaction")


def test_compaction_splits_a_large_hour(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for i in range(6):
        land(spark, root, f"b{i}", 200, i * 200)
    want = ids(bronze.read_bronze(spark, root))
    # Partitions this small would be joined again by AQE.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bronze.compact_bronze(spark, root, target_bytes=10_000)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    df = bronze.read_bronze(spark, root)
    assert ids(df) == want
    assert 1 < bronze.bronze_stats(df).first()["file_count"]


def stop_after(monkeypatch, n):
    """Let `n` steps (commits, moves) of a compaction through, then fail as a crash would."""
    left = [n]

    def counted(step, counts):
        def run(self, *args):
            if counts(self, *args):
                if not left[0]:
                    raise KeyboardInterrupt
                left[0] -= 1
            return step(self, *args)

        return run

    monkeypatch.setattr(Files, "rename", counted(Files.rename, lambda self, source, target: "/new/" in source))
    monkeypatch.setattr(Versions, "write", counted(Versions.write, lambda self, state: self.root.endswith("_commits")))


@pytest.mark.parametrize("steps", [0, 1, 2, 3])
def test_interrupted_compaction_is_finished(spark, tmp_path, monkeypatch, steps):
    root = str(tmp_path / "bronze")
    land(spark, root, "a", 5, 0)
    land(spark, root, "b", 5, 5)
    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        stop_after(patch, steps)
        bronze.compact_bronze(spark, root)
    assert ids(bronze.read_bronze(spark, root)) == list(range(10))  # at every point a reader sees each row once
    land(spark, root, "late", 3, 50)  # a batch lands between the crash and the next run
    for _ in range(2):
        bronze.finish_compaction(spark, root)
        assert ids(bronze.read_bronze(spark, root)) == [*range(10), 50, 51, 52]


def test_readers_never_see_a_gap(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    land(spark, root, "a", 5, 0)
    land(spark, root, "b", 5, 5)
    before, seen = bronze.read_bronze(spark, root), []
    rename, write = Files.rename, Versions.write
    monkeypatch.setattr(Files, "rename", lambda self, a, b: (rename(self, a, b), seen.append(ids(bronze.read_bronze(spark, root))))[0])
    monkeypatch.setattr(Versions, "write", lambda self, state: (write(self, state), seen.append(ids(bronze.read_bronze(spark, root))))[0])
    bronze.compact_bronze(spark, root)
    assert len(seen) >= 4 and all(s == list(range(10)) for s in seen)
    assert ids(before) == list(range(10))  # its files are still there
    assert bronze.delete_replaced(spark, root) > 0 and ids(bronze.read_bronze(spark, root)) == list(range(10))
    assert Files(spark, root).list(f"{root}/date=2024-01-01/hour=05") == ["batch=compacted-" + n for n in [bronze.read_bronze(spark, root).first()["batch"].removeprefix("compacted-")]]


def test_a_batch_lands_once_in_whatever_hour(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    land(spark, root, "s-1", 5, 0, hour=5)
    land(spark, root, "s-1", 5, 0, hour=6)  # repeated in a later hour
    assert ids(bronze.read_bronze(spark, root)) == list(range(5))
    land(spark, root, "s-0", 2, 90, hour=5)
    bronze.compact_bronze(spark, root)
    land(spark, root, "s-1", 5, 0, hour=7)  # repeated after its files are compacted
    assert ids(bronze.read_bronze(spark, root)) == [0, 1, 2, 3, 4, 90, 91]
    write = Files.write_new

    def crash(self, path, text):
        if path.endswith("/landed"):
            raise KeyboardInterrupt
        write(self, path, text)

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(Files, "write_new", crash)
        land(spark, root, "s-2", 3, 200, hour=8)  # rows written, mark not
    land(spark, root, "s-2", 3, 200, hour=9)
    rows = bronze.read_bronze(spark, root).where("id >= 200").collect()
    assert sorted(r["id"] for r in rows) == [200, 201, 202] and {r["hour"] for r in rows} == {"09"}


def test_a_batch_that_lands_during_compaction_stays(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    land(spark, root, "a", 5, 0)
    land(spark, root, "b", 5, 5)
    finish = bronze.finish_compaction
    calls = []

    def late(session, at):
        if calls:
            land(session, root, "late", 2, 70)
        calls.append(at)
        finish(session, at)

    monkeypatch.setattr(bronze, "finish_compaction", late)
    bronze.compact_bronze(spark, root)
    assert ids(bronze.read_bronze(spark, root)) == [*range(10), 70, 71]


def test_a_batch_written_anew_during_compaction_is_not_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "bronze")
    land(spark, root, "a", 5, 0)
    land(spark, root, "b", 5, 5)
    finish = bronze.finish_compaction
    calls = []

    def again(session, at):
        if calls:
            land(session, root, "b", 5, 5)
        calls.append(at)
        finish(session, at)

    monkeypatch.setattr(bronze, "finish_compaction", again)
    bronze.compact_bronze(spark, root)
    assert ids(bronze.read_bronze(spark, root)) == list(range(10))


def test_the_current_hour_is_left_alone(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for name in "ab":
        bronze.append_bronze(bronze.with_bronze_columns(valid_events(spark, 2)), root, name)
    assert bronze.compact_bronze(spark, root) == []


def test_prune_knows_both_kinds_of_hashes(spark, tmp_path):
    store = vectors.VectorStore(spark, str(tmp_path / "v"), 8)
    rows = silver_rows(spark, ["a b", "c d"])
    store.sync(rows, embed_col="title", id_mode="item")
    points = store.vectors.read().count()
    store.prune(rows)
    assert points and store.vectors.read().count() == points and store.ledger.read().count() == points


def test_one_point_a_title_in_item_mode(spark, tmp_path):
    store = vectors.VectorStore(spark, str(tmp_path / "v"), 8)
    rows = spark.createDataFrame([(f"t{i}", t, i) for i, t in enumerate(["same", "same", "other"])], "text string, title string, id long").withColumn("time", F.col("id"))
    assert store.sync(rows, embed_col="title", id_mode="item") == 2
    assert sorted(r["point_id"] for r in store.vectors.read().collect()) == ["0", "2"]


def test_table_versions(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"), LEDGER)
    one = spark.createDataFrame([("a", "text")], LEDGER)
    assert table.read().count() == 0 and not table.exists()
    table.append(one)
    table.append(spark.createDataFrame([("b", "text")], LEDGER))
    before = table.read()
    table.replace(table.read().where("content_hash = 'b'"))
    assert before.count() == 2  # a reader keeps what it started with
    assert [r["content_hash"] for r in table.read().collect()] == ["b"]
    assert table.version() == 3 and table.modified_ms() > 0
    assert table.expire() == 2 and table.read().count() == 1
    table.clear()
    assert table.read().count() == 0


def silver_rows(spark, texts):
    rows = [(t, "title " + t, i, "by", None, 1, i, "2024", i, 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SILVER)


def test_sync_is_incremental_and_repeatable(spark, tmp_path):
    store = vectors.VectorStore(spark, str(tmp_path), dim=16)
    calls = spark.sparkContext.accumulator(0)

    def counted(df, text, out):
        def tick(frames):
            for f in frames:
                calls.add(len(f))
                yield f

        schema = df.schema
        return hashed_embedder(16)(df.mapInPandas(tick, schema), text, out)

    assert store.sync(silver_rows(spark, ["a b", "c d"]), counted) == 2
    assert calls.value == 2
    assert store.sync(silver_rows(spark, ["a b", "c d"]), counted) == 0
    assert calls.value == 2
    assert store.sync(silver_rows(spark, ["a b", "c d", "e"]), counted) == 1
    assert calls.value == 3
    assert store.vectors.read().count() == 3 and store.ledger.read().count() == 3
    # Vectors written, ledger not: the run is repeated and changes nothing.
    points = {tuple(r) for r in store.vectors.read().select("point_id", "content_hash").collect()}
    store.ledger.clear()
    assert store.sync(silver_rows(spark, ["a b", "c d", "e"]), counted) == 3
    assert {tuple(r) for r in store.vectors.read().select("point_id", "content_hash").collect()} == points
    assert store.vectors.read().count() == 3
    store.prune(silver_rows(spark, ["e"]))
    assert store.vectors.read().count() == 1 and store.ledger.read().count() == 1
    store.reset()
    assert store.vectors.read().count() == 0
    assert store.sync(silver_rows(spark, ["e"]), counted) == 1


def test_wrong_dimension_is_refused(spark, tmp_path):
    store = vectors.VectorStore(spark, str(tmp_path), dim=8)
    with pytest.raises(Exception, match="vector of length other than 8"):
        store.sync(silver_rows(spark, ["a"]), hashed_embedder(16))
    assert store.ledger.read().count() == 0


def test_model_embedder_batches(spark):
    def load():
        import numpy as np

        return lambda texts: np.array([[len(t), len(texts)] for t in texts])

    df = spark.createDataFrame([(i, "x" * i) for i in range(5)], "i int, t string").coalesce(1)
    out = {r["i"]: r["v"] for r in model_embedder(load, batch_size=2)(df, "t", "v").collect()}
    assert out == {0: [0, 2], 1: [1, 2], 2: [2, 2], 3: [3, 2], 4: [4, 1]}


def test_hashed_embedder_against_python(spark):
    import hashlib
    import math

    texts = ["a b a", "", "Éa  x", "t " * 50 + "u"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["v"] for r in hashed_embedder(32)(df, "t", "v").collect()}
    for t in texts:
        want = [0.0] * 32
        for tok in t.lower().split():
            want[int(hashlib.sha1(tok.encode()).hexdigest()[:4], 16) % 32] += 1
        norm = math.sqrt(sum(x * x for x in want))
        assert got[t] == pytest.approx([x / norm if norm else 0.0 for x in want], abs=1e-6)


def test_telemetry(spark):
    one = lambda raw, ok, dlq: spark.createDataFrame([(raw, ok, dlq)], "raw long, validated long, dlq long")

    def snap(stages, b, s, p, y):
        return telemetry.snapshot(stages, F.lit(b), F.lit(s), F.lit(p), F.lit(y)).first()

    assert (snap(one(0, 0, 0), 0, 0, 0, 0)["health"], snap(one(0, 0, 0), 0, 0, 0, 0)["dlq_rate"]) == ("warn", 0.0)
    bad = snap(one(100, 80, 20), 80, 9, 5, 9)
    assert (bad["health"], bad["dlq_rate"], bad["message"]) == ("bad", 20.0, "20.0% of events are rejected: look at the dead letters.")
    edge = snap(one(100, 85, 15), 80, 9, 5, 4)
    assert (edge["health"], edge["sync_gap"]) == ("warn", 5)
    ok = snap(one(0, 85, 15), 80, 3, 5, 9)
    assert (ok["health"], ok["sync_gap"], ok["shown_raw"], ok["raw"]) == ("ok", 0, 80, 0)


def test_stage_depths(spark):
    offsets = spark.createDataFrame(
        [(kafka.RAW_TOPIC, 0, 5), (kafka.RAW_TOPIC, 0, 9), (kafka.RAW_TOPIC, 1, 3), ("else", 0, 1)],
        "topic string, partition int, offset long",
    )
    assert tuple(telemetry.stage_depths(telemetry.topic_depths(offsets), F.lit(7)).first()) == (6, 0, 0)
    assert tuple(telemetry.stage_depths(None, F.lit(7)).first()) == (7, 7, 0)
    marks = spark.createDataFrame([(kafka.DLQ_TOPIC, 0, 2, 6), (kafka.DLQ_TOPIC, 1, 0, 1)], "topic string, partition int, low long, high long")
    assert tuple(telemetry.stage_depths(telemetry.watermark_depths(marks), F.lit(7)).first()) == (0, 0, 5)


def test_titles(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "title string")
    assert sorted(r["title"] for r in telemetry.distinct_titles(df).collect()) == ["a", "b"]
    assert telemetry.sample_titles(df, 5).count() == 2
    assert telemetry.sample_titles(df, 1, "s").collect() == telemetry.sample_titles(df, 1, "s").collect()


def test_table_stats(spark, tmp_path):
    ledger = Table(spark, str(tmp_path / "l"), LEDGER)
    assert tuple(telemetry.table_stats(ledger).first()) == (0, None)
    ledger.append(spark.createDataFrame([("a", "text")], LEDGER))
    row = telemetry.table_stats(ledger).first()
    assert row["row_count"] == 1 and abs(row["last_modified"] - dt.datetime.now()) < dt.timedelta(minutes=5)
    assert telemetry.vector_stats(ledger, ledger).first()["synced_hash_count"] == 1


def test_kafka_options():
    assert kafka.source_options("h:1", "t", 50) == {
        "kafka.bootstrap.servers": "h:1",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "50",
    }
    flushed = kafka.source_options("h:1", "t", flush_rows=50, flush_seconds=30)
    assert (flushed["minOffsetsPerTrigger"], flushed["maxTriggerDelay"]) == ("50", "30s")
    assert kafka.sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    assert [f.nullable for f in STORY_EVENT][:5] == [False] * 5
