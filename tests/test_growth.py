"""What must not grow faster than the tables: files of a landing, passes over the events, work nobody asked for."""

import os
import re
import time

from pyspark.sql import functions as F

from lakesearch.functions.embed import hashed_embedder
from lakesearch.operators import bm25, silver
from lakesearch.plans.refresh import Lake
from lakesearch.plans.registry import QUERIES
from lakesearch.schemas import BRONZE, SILVER_COLUMNS
from lakesearch.session import scratch_dir
from lakesearch.sources import buckets
from lakesearch.sources.bronze import append_bronze, read_bronze
from lakesearch.sources.files import write_parquet


def bronze_rows(spark, first, n):
    rows = spark.range(first, first + n).select(
        "id", F.lit("t").alias("title"), F.lit("b").alias("by"), F.concat(F.lit("some words number "), F.col("id").cast("string")).alias("text"), F.col("id").alias("time"),
        F.lit("story").alias("type"), F.format_string("2024-01-01T%02d:00:00.000000+00:00", F.col("id") % 5).alias("_ingested_at"),
        F.lit("2024-01-01").alias("date"), F.format_string("%02d", F.col("id") % 5).alias("hour"),
    )
    missing = [f for f in BRONZE if f.name not in (*rows.columns, "batch")]
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})


def test_a_landing_has_one_file_an_hour(spark, tmp_path):
    root = str(tmp_path / "bronze")
    append_bronze(bronze_rows(spark, 0, 200).repartition(7), root, "a")
    files = read_bronze(spark, root).groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(files) == 5 and sum(r["count"] for r in files) == 200


def test_what_did_not_follow_catches_up(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"), dim=16, embedder=hashed_embedder(16))
    for batch in (0, 1):
        append_bronze(bronze_rows(spark, batch * 20, 20), lake.bronze_root, batch)
        assert lake.refresh(vectors=False, index=False) == 0
    assert lake.silver.read().count() == 40 and lake.store.points().isEmpty() and not lake.index.state()["segments"]
    assert lake.refresh() == 40
    assert lake.store.points().count() == 40 and lake.index.open(bm25.corpus(lake.silver.read())).n_docs == 40


def test_events_are_judged_once_for_a_snapshot(spark, tmp_path):
    tables = {
        "events": "id AS event_id, id AS user_id, 'view' AS event_type, timestamp_seconds(id) AS ts",
        "documents": "id AS doc_id, concat('words ', id) AS text, 's' AS source, 'en' AS lang, 8L AS n_chars",
        "embeddings": "id AS vec_id, array(1.0F) AS embedding, 0 AS label",
        "labels": "id AS doc_id, 1 AS quality, 0 AS toxic",
    }
    for name, columns in tables.items():
        spark.range(40).selectExpr(*[c for c in columns.replace("concat('words ', id)", "concat('words '||id)").split(", ")]).write.parquet(f"{tmp_path}/{name}.parquet")
    snap = QUERIES["telemetry_snapshot"](spark, str(tmp_path))
    assert "variant" not in snap._jdf.queryExecution().analyzed().toString().lower()
    row = snap.first()
    assert row["raw"] == 40 and row["bronze_rows"] == row["validated"] and row["silver_rows"] == 40


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: set(re.findall(r"shuffle_\w+", str(blocks.getAllBlocks())))
    before = shuffled()
    write_parquet(spark.range(1000).repartition(3, "id"), str(tmp_path / "t"))
    until = time.time() + 10
    while (left := shuffled() - before) and time.time() < until:  # they are deleted in the background
        time.sleep(0.1)
    assert not left and spark.read.parquet(str(tmp_path / "t")).count() == 1000


def test_a_refresh_leaves_the_lake_and_nothing_beside_it(spark, tmp_path, monkeypatch):
    """No scratch tables, no second copy of a text in the change log, and where nobody else reads nothing that was replaced."""
    monkeypatch.setattr(buckets, "PASS_BYTES", 1)  # every write of Silver in passes
    top = scratch_dir(spark).removeprefix("file:")
    before = set(os.listdir(top))
    lake = Lake(spark, str(tmp_path / "lake"), dim=16, embedder=hashed_embedder(16), keep_replaced=False)
    append_bronze(bronze_rows(spark, 0, 60), lake.bronze_root, "a")
    assert lake.refresh() == 60
    later = bronze_rows(spark, 40, 40).withColumns({"id": F.col("id") + 1000, "_ingested_at": F.lit("2025-01-01T00:00:00.000000+00:00")})
    append_bronze(later, lake.bronze_root, "b")
    lake.build_silver()
    noted = lake.changes.read().collect()
    assert sorted((r["sign"], r["text"] is None) for r in noted) == [*[(-1, False)] * 20, (1, True)]
    assert lake.refresh() == 20 and lake.store.points().count() == 80
    rows = lambda df: sorted(map(str, df.select(*SILVER_COLUMNS).collect()))
    assert rows(lake.silver.read()) == rows(silver.build_silver(read_bronze(spark, lake.bronze_root)))
    assert lake.index.open(bm25.corpus(lake.silver.read())).n_docs == 80
    assert set(os.listdir(top)) <= before
    runs = lake.silver.state()["runs"]
    for bucket in range(silver.BUCKETS):
        assert lake.silver.files.list(f"{lake.silver.root}/doc_part={bucket}") == [f"run={run}" for run in [runs.get(str(bucket))] if run]
    for table in (lake.changes, lake.store.vectors, lake.store.ledger):
        assert {n for n in table.files.list(table.root) if n.startswith("part-")} == table._named()
