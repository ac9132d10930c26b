"""Running counters of streams, kept in a table.

A listener notes what each micro-batch counted, once: one small file named by stream and batch. A
stream keeps its id over restarts, and a batch that runs again has the same number, so counts are
neither lost nor doubled; they may be read at any time, also after the stream is gone.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from lakesearch.sources.files import Files

COUNTS = "stream STRING, batch BIGINT, at STRING, metric STRING, counts MAP<STRING, BIGINT>"


class CounterListener(StreamingQueryListener):
    """Append the observed metrics of every progress to the folder `root`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for metric, row in progress.observedMetrics.items():
            path = f"{self.root}/stream={progress.id}/{metric}-{progress.batchId:012d}.json"
            if not self.files.exists(path):
                noted = {"stream": str(progress.id), "batch": progress.batchId, "at": progress.timestamp, "metric": metric, "counts": row.asDict()}
                self.files.write_new(path, json.dumps(noted))


def counts(spark: SparkSession, root: str) -> DataFrame:
    """(stream, batch, at, metric, counts): one row for each micro-batch and metric."""
    if not Files(spark, root).list(root):
        return spark.createDataFrame([], COUNTS)
    return spark.read.schema(COUNTS).option("recursiveFileLookup", "true").json(root)


def totals(spark: SparkSession, root: str, metric: str = "validation") -> DataFrame:
    """One row: valid, dlq and total over all batches of all streams."""
    of = lambda name: F.coalesce(F.sum(F.col("counts")[name]), F.lit(0)).cast("bigint").alias(name)
    return counts(spark, root).where(F.col("metric") == metric).agg(of("valid"), of("dlq"), of("total"))


def stages(spark: SparkSession, root: str) -> DataFrame:
    """The counters as `telemetry.snapshot` takes them: raw, validated, dlq."""
    return totals(spark, root).select(F.col("total").alias("raw"), F.col("valid").alias("validated"), "dlq")
