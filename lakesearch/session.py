"""Session defaults. `configure` also applies to a session somebody else made."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from lakesearch.sources.files import Files, write_parquet

# Runtime settings every job relies on. Shuffle partitions are not fixed here:
# AQE coalesces from whatever initial number the cluster names.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A repeated key in a JSON object: the last one wins, as in Python's json.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Ids seen by a stream are kept on disk, not in executor memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "lakesearch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the cluster's `spark.checkpoint.dir`.

    Only a local session that names none falls back to a folder of its own; on a
    cluster a machine-local path would not be seen by the other executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="lakesearch-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_written: list[str] = []
_scope = threading.local()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that this thread writes inside are deleted on leaving: nothing built on them may be used after."""
    outer, _scope.paths = getattr(_scope, "paths", None), []
    try:
        yield
    finally:
        own, _scope.paths = _scope.paths, outer
        for path in own:
            Files(spark, path).delete(path)


def discard(df: DataFrame) -> None:
    """Delete a table that `written` has returned, once nothing built on it is needed."""
    Files(df.sparkSession, df._lakesearch_path).delete(df._lakesearch_path)


def discard_written(spark: SparkSession) -> None:
    """Delete this process's scratch tables, once nothing built on them is needed."""
    while _written:
        path = _written.pop()
        Files(spark, path).delete(path)


def written(df: DataFrame) -> DataFrame:
    """Write the rows to a table of their own in the scratch folder and read it back.

    For a result that several passes start from: it is computed once, later passes
    prune its columns, and a lost executor only repeats its own reads. The folder
    stays until `discard_written`, as results built on it are computed later; inside
    `scratch` it goes with the scope.
    """
    path = f"{scratch_dir(df.sparkSession)}/lakesearch-{uuid.uuid4().hex}"
    own = getattr(_scope, "paths", None)
    (_written if own is None else own).append(path)
    if own is None:
        df.write.parquet(path)
    else:
        write_parquet(df, path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._lakesearch_path = path
    return out
