"""Bronze: validated events as Parquet under `date=YYYY-MM-DD/hour=HH/`."""

from __future__ import annotations

import json
import uuid
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesearch.functions.text import iso_utc, partition_date, partition_hour
from lakesearch.operators.filters import event_key
from lakesearch.schemas import BRONZE, STORY_FIELDS
from lakesearch.sources.files import Files, write_parquet
from lakesearch.sources.tables import Versions

# A compacted file aims at this size; a larger partition gets several.
TARGET_FILE_BYTES = 512 * 1024 * 1024


def with_bronze_columns(valid: DataFrame, now: Column | None = None) -> DataFrame:
    """Add key, arrival time and partition values, all taken from the flush time.

    On a stream `current_timestamp()` is the batch's time as kept in the checkpoint:
    a batch that is run again gets the same values.
    """
    now = F.current_timestamp() if now is None else now
    return valid.select(
        *STORY_FIELDS,
        event_key("key").alias("_kafka_key"),
        iso_utc(now).alias("_ingested_at"),
        partition_date(now).alias("date"),
        partition_hour(now).alias("hour"),
    )


def append_bronze(df: DataFrame, root: str, batch: str | int) -> bool:
    """Land one batch, once: a batch that has landed is left as it is, whatever hour it is now.

    Before the rows a plan is written with the hours they go to, after them a mark that they are there.
    A batch cut short has a plan and no mark: what it left is deleted before it lands anew, so
    it may land in another hour than at first. Returns whether the batch was written.
    """
    files, record = Files(df.sparkSession, root), f"{root}/_batches/{quote(str(batch), safe='')}"
    if files.exists(f"{record}/landed"):
        return False
    hours = sorted({(r["date"], r["hour"]) for r in df.select("date", "hour").distinct().collect()})  # those of one flush
    for name in files.list(record):
        for date, hour in json.loads(files.read_text(f"{record}/{name}")):
            files.delete(f"{root}/date={date}/hour={hour}/batch={batch}")
    files.write_new(f"{record}/plan-{uuid.uuid4().hex}", json.dumps(hours))
    # An hour is one file, unless it is too large for one task: else every task has a file for every hour.
    rows = df.withColumn("batch", F.lit(str(batch))).hint("rebalance", "date", "hour")
    write_parquet(rows, root, ("date", "hour", "batch"), "overwrite", partitionOverwriteMode="dynamic")
    files.write_new(f"{record}/landed", json.dumps(hours))
    return True


def _versions(spark: SparkSession, root: str) -> Versions:
    return Versions(spark, f"{root.rstrip('/')}/_commits")


#: Files whose rows are in compacted ones, compactions not in force yet, and those that are.
_NO_COMMITS = {"replaced": [], "pending": [], "done": []}


def read_bronze(spark: SparkSession, *roots: str) -> DataFrame:
    """All partitions of all roots, by name, missing columns as nulls.

    The schema is given, not inferred: `hour=05` must stay text. A root may have its
    files directly under the hour (no batch folders); filters on `date` and `hour`
    prune folders either way. Without any data the result is empty. A compaction counts as a whole
    or not at all: the version of commits that a reader starts with says which files it leaves out.
    """
    found = None
    for root in roots:
        files = Files(spark, root)
        if any(name.startswith("date=") for name in files.list(root)):
            state = _versions(spark, root).read(_NO_COMMITS)
            one = spark.read.schema(BRONZE).parquet(root)
            if state["pending"]:
                one = one.where(~F.coalesce("batch", F.lit("")).isin([f"compacted-{run}" for run in state["pending"]]))
            if state["replaced"]:
                one = one.where(~F.col("_metadata.file_path").isin(state["replaced"]))
            one = one.select(*BRONZE.fieldNames())
            found = one if found is None else found.unionByName(one, allowMissingColumns=True)
    return spark.createDataFrame([], BRONZE) if found is None else found


def bronze_stats(bronze: DataFrame) -> DataFrame:
    """File and row count. No column is read: paths come from the file metadata."""
    per_file = bronze.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))


def bronze_files(bronze: DataFrame) -> DataFrame:
    """(path, changed) of the files that Bronze is made of; no column is read."""
    return bronze.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("changed")).distinct()


def read_files(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """The rows of some files of Bronze."""
    return spark.read.schema(BRONZE).option("basePath", root).parquet(*paths).select(*BRONZE.fieldNames())


def partition_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("date", "hour").agg(F.count(F.lit(1)).alias("rows"))


def _partition_files(bronze: DataFrame) -> DataFrame:
    """One row per (date, hour): its files, bytes and rows."""
    per_file = bronze.groupBy(
        "date", "hour", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
    ).agg(F.count(F.lit(1)).alias("n"))
    return per_file.groupBy("date", "hour").agg(
        F.collect_list("path").alias("files"), F.sum("bytes").alias("bytes"), F.sum("n").alias("rows")
    )


def compact_bronze(spark: SparkSession, root: str, before: tuple[str, str] | None = None, target_bytes: int = TARGET_FILE_BYTES) -> list[tuple[str, str]]:
    """Merge the files of every (date, hour) that has too many, and name those compacted.

    Every file of a partition takes part, earlier compacted ones included, so running
    twice loses nothing. One job rewrites all chosen partitions into a staging folder,
    and a partition larger than `target_bytes` is dealt out over several tasks. Then
    the new files come in and those that were read, and no others, go out by one commit: a batch
    that lands meanwhile is left alone, and readers see either side. `finish_compaction` completes
    this after a crash. Replaced files are deleted by the next compaction, so readers have that long.
    Only hours before `before` take part; by default all but the current one.
    """
    root = root.rstrip("/")
    finish_compaction(spark, root)
    delete_replaced(spark, root)
    if before is None:
        now = spark.range(1).select(partition_date(F.current_timestamp()), partition_hour(F.current_timestamp())).first()
        before = (now[0], now[1])
    bronze = read_bronze(spark, root).where(F.struct("date", "hour") < F.struct(F.lit(before[0]), F.lit(before[1])))
    if not any(name.startswith("date=") for name in Files(spark, root).list(root)):
        return []
    want = F.ceil(F.col("bytes") / target_bytes)
    stats = _partition_files(bronze).withColumn("slots", want).where(F.size("files") > F.col("slots"))
    # One row per hour of history with the names of its files: needed here to move them.
    chosen = stats.collect()
    if not chosen:
        return []
    pairs = [(r["date"], r["hour"]) for r in chosen]
    run = uuid.uuid4().hex
    stage = f"{root}/_compaction/{run}"
    dates = sorted({d for d, _ in pairs})
    slots = spark.createDataFrame([(r["date"], r["hour"], r["slots"]) for r in chosen], "date string, hour string, slots long")
    rows = (
        bronze.where(F.col("date").isin(dates))
        .withColumn("__row", F.col("_metadata.row_index"))
        .drop("batch")
        .join(slots, ["date", "hour"])
        .withColumn("__slot", F.pmod("__row", "slots"))
    )
    write_parquet(rows.repartition("date", "hour", "__slot").drop("__row", "__slot", "slots"), f"{stage}/new", ("date", "hour"))
    expected = sum(r["rows"] for r in chosen)
    written = spark.read.schema(BRONZE).parquet(f"{stage}/new").count()
    if written != expected:
        raise RuntimeError(f"compaction wrote {written} of {expected} rows; originals are untouched")
    listed = {f"date={r['date']}/hour={r['hour']}": sorted(r["files"]) for r in chosen}
    Files(spark, root).write_new(f"{stage}/_ready", json.dumps(listed))
    finish_compaction(spark, root)
    return sorted(pairs)


def finish_compaction(spark: SparkSession, root: str) -> None:
    """Put staged partitions in force; safe to call at any time, any number of times.

    The run is noted as pending, so that nobody reads its folders while they are moved in; then one commit
    makes it count and the files that it read not count any more. If one of those is gone by
    then, its batch was written anew; that partition keeps its files and the staged ones are dropped.
    """
    root = root.rstrip("/")
    files, versions = Files(spark, root), _versions(spark, root)
    for run in files.list(f"{root}/_compaction"):
        stage = f"{root}/_compaction/{run}"
        state = versions.read(_NO_COMMITS)
        if files.exists(f"{stage}/_ready") and run not in state["done"]:
            if run not in state["pending"]:
                versions.write({**state, "pending": [*state["pending"], run]})
            replaced = []
            for partition, listed in json.loads(files.read_text(f"{stage}/_ready")).items():
                new, there = f"{stage}/new/{partition}", f"{root}/{partition}/batch=compacted-{run}"
                if not all(files.exists(path) for path in listed):
                    files.delete(there)
                    continue
                if not files.exists(there):
                    files.rename(new, there)
                replaced += listed
            state = versions.read(_NO_COMMITS)
            versions.write({"replaced": [*state["replaced"], *replaced], "pending": [r for r in state["pending"] if r != run], "done": [*state["done"], run]})
        files.delete(stage)
    state = versions.read(_NO_COMMITS)
    if state["done"]:
        versions.write({**state, "done": []})


def delete_replaced(spark: SparkSession, root: str) -> int:
    """Delete files that an earlier compaction replaced, and the folders they leave empty."""
    root = root.rstrip("/")
    files, versions = Files(spark, root), _versions(spark, root)
    state = versions.read(_NO_COMMITS)
    for path in state["replaced"]:
        files.delete(path)
        folder = path.rsplit("/", 1)[0]
        if files.exists(folder) and not files.list(folder):
            files.delete(folder)
    if state["replaced"]:
        versions.write({**state, "replaced": []})
        versions.expire()
    return len(state["replaced"])
