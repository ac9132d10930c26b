"""A table in hash buckets, copied on write bucket by bucket.

Rows lie in `<root>/<column>=<bucket>/run=<id>`. A version names the run in force for each bucket;
a change writes new runs of the buckets it touches and one small version file, so bytes
written follow the change. Readers keep the runs they started with; nothing is moved or overwritten.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesearch.sources.files import Files, input_bytes, write_parquet
from lakesearch.sources.tables import Versions

#: A write from more bytes of files is made in several passes, up to PASSES: the share that lies in shuffle files at a time.
PASS_BYTES = 32 << 20
PASSES = 8


class BucketTable:
    """`schema` includes the bucket number, an integer below `buckets`, as column `bucket`."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, bucket: str, buckets: int):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.bucket, self.buckets = bucket, buckets
        self.files = Files(spark, self.root)
        self.versions = Versions(spark, self.root)

    def version(self) -> int:
        return self.versions.latest()

    def exists(self) -> bool:
        return self.version() > 0

    def modified_ms(self) -> int | None:
        version = self.version()
        return self.files.modified_ms(self.versions.pointer(version)) if version else None

    def state(self) -> dict:
        """{"runs": {bucket: run}, ...}: whatever else a version was given."""
        return self.versions.read({"runs": {}})

    def _folder(self, bucket: int | str, run: str) -> str:
        return f"{self.root}/{self.bucket}={bucket}/run={run}"

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The rows in force, of all buckets or of some."""
        runs = self.state()["runs"]
        wanted = {str(b) for b in buckets} if buckets is not None else runs.keys()
        paths = [self._folder(b, r) for b, r in sorted(runs.items()) if b in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.root).parquet(*paths).select(*self.schema.fieldNames())

    def write(self, rows: DataFrame, touched: list[int] | None = None, **noted) -> None:
        """Make `rows` the content of the buckets `touched` (by default of all).

        Every other bucket keeps its run. `rows` may be computed from this very table.
        `noted` is kept with the version. Many rows are written in passes, each for a range of buckets, so
        that only a part of them lies in shuffle files at a time; the version comes after the last.
        """
        run = uuid.uuid4().hex
        columns = [f for f in self.schema.fieldNames() if f != self.bucket]
        out = rows.select(*columns, self.bucket, F.lit(run).alias("run"))
        wanted = sorted(set(range(self.buckets) if touched is None else touched))
        passes = min(PASSES, len(wanted), -(-input_bytes(out) // PASS_BYTES))
        for i in range(max(1, passes)):
            own = wanted[len(wanted) * i // passes : len(wanted) * (i + 1) // passes] if passes > 1 else []
            part = out.where(F.col(self.bucket).between(own[0], own[-1])) if own else out
            # A bucket is one file, unless it is too large for one task: then the rebalancing splits it.
            write_parquet(part.hint("rebalance", self.bucket), self.root, (self.bucket, "run"), "append")
        before = self.state()
        kept = {b: r for b, r in before["runs"].items() if touched is not None and int(b) not in set(touched)}
        there = [b for b in range(self.buckets) if touched is None or b in set(touched)]
        new = {str(b): run for b in there if self.files.exists(self._folder(b, run))}
        self.versions.write({**{k: v for k, v in before.items() if k != "runs"}, **noted, "runs": {**kept, **new}})

    def replace(self, rows: DataFrame, **noted) -> None:
        self.write(rows, None, **noted)

    def expire(self) -> int:
        """Delete runs and versions no longer in force. Only for times without readers."""
        live = self.state()["runs"]
        gone = 0
        for b in range(self.buckets):
            for name in self.files.list(f"{self.root}/{self.bucket}={b}"):
                if name.removeprefix("run=") != live.get(str(b)):
                    self.files.delete(f"{self.root}/{self.bucket}={b}/{name}")
                    gone += 1
        self.versions.expire()
        return gone
