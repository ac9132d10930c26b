"""Tables that can be replaced or added to while they are being read.

A table is a folder of immutable parts. Each change writes one small `_v-<n>.json`
naming the parts then in force, and the highest number counts. Readers see the list
as it was when they started, a failed write changes nothing, and nothing is ever
overwritten in place. There is one writer at a time, as in the pipeline.
"""

from __future__ import annotations

import json
import math
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesearch.sources.files import Files, write_parquet

_PREFIX, _SUFFIX = "_v-", ".json"

#: Parts of one size class that are merged into one; parts up to SMALL_PART bytes are one class.
FANOUT = 8
SMALL_PART = 1 << 20
#: Bytes of one file of a merged part.
PART_FILE = 256 << 20


class Versions:
    """One small JSON file for each version below a folder; the highest number counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.root, self.files = root.rstrip("/"), Files(spark, root)

    def pointer(self, version: int) -> str:
        return f"{self.root}/{_PREFIX}{version:08d}{_SUFFIX}"

    def latest(self) -> int:
        names = [n for n in self.files.list(self.root) if n.startswith(_PREFIX) and n.endswith(_SUFFIX)]
        return max((int(n[len(_PREFIX) : -len(_SUFFIX)]) for n in names), default=0)

    def read(self, default):
        version = self.latest()
        return json.loads(self.files.read_text(self.pointer(version))) if version else default

    def write(self, state) -> int:
        version = self.latest() + 1
        self.files.write_new(self.pointer(version), json.dumps(state))
        return version

    def expire(self) -> None:
        for n in range(1, self.latest()):
            self.files.delete(self.pointer(n))


class Table:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.files = Files(spark, self.root)
        self.versions = Versions(spark, self.root)

    def version(self) -> int:
        return self.versions.latest()

    def parts(self) -> list[str]:
        return self.versions.read([])

    def exists(self) -> bool:
        return self.version() > 0

    def modified_ms(self) -> int | None:
        version = self.version()
        return self.files.modified_ms(self.versions.pointer(version)) if version else None

    def read(self) -> DataFrame:
        """The rows in force; an empty DataFrame of the same schema if there are none."""
        parts = [f"{self.root}/{p}" for p in self.parts()]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*parts)

    def _commit(self, parts: list[str]) -> None:
        self.versions.write(parts)

    def _write_part(self, df: DataFrame, partition_by: tuple[str, ...]) -> str:
        part = f"part-{uuid.uuid4().hex}"
        write_parquet(df.select(*self.schema.fieldNames()), f"{self.root}/{part}", partition_by)
        return part

    def replace(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        """Full overwrite. `df` may be computed from this very table."""
        self._commit([self._write_part(df, partition_by)])

    def append(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        parts = self.parts()
        self._commit([*parts, self._write_part(df, partition_by)])

    def clear(self) -> None:
        """Empty the table; earlier parts stay on disk until `expire`."""
        self._commit([])

    def compact(self, fanout: int = FANOUT) -> int:
        """Merge parts while `fanout` of them are of one size class; returns how many merges there were.

        A class spans a factor of `fanout` in bytes, so a row is rewritten once a class and the parts
        number at most `fanout` for each: both grow with the logarithm of the table. Readers see
        either the parts or their merge, by the version they started with.
        """
        merges = 0
        while True:
            classes: dict[int, list[str]] = {}
            for part in self.parts():
                size = max(SMALL_PART, self.files.size(f"{self.root}/{part}"))
                classes.setdefault(int(math.log(size, fanout)), []).append(part)
            full = next((c for _, c in sorted(classes.items()) if len(c) >= fanout), None)
            if full is None:
                return merges
            rows = self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{p}" for p in full])
            size = sum(self.files.size(f"{self.root}/{p}") for p in full)
            part = self._write_part(rows.coalesce(max(1, size // PART_FILE)), ())
            self._commit([p for p in self.parts() if p not in full] + [part])
            merges += 1

    def _named(self) -> set[str]:
        """Folders that the version in force names."""
        return set(self.parts())

    def expire(self) -> int:
        """Delete parts no longer in force. Only for times without readers."""
        live = self._named()
        old = [n for n in self.files.list(self.root) if n.startswith("part-") and n not in live]
        for name in old:
            self.files.delete(f"{self.root}/{name}")
        self.versions.expire()
        return len(old)


class MergedTable(Table):
    """A keyed table, merged on read: a new row of a known key is added, and its key noted as dead before.

    Rows carry the number of their change. Dead keys are a small list of (key, change): a row
    counts unless its key is dead before a later change. Lists are folded into the rows once
    they hold FOLD_SHARE of them.
    """

    FOLD_SHARE = 0.1

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str):
        super().__init__(spark, root, T.StructType([*schema, T.StructField("_change", T.LongType())]))
        self.plain, self.key = schema, key
        self.dead_schema = T.StructType([schema[key], T.StructField("_before", T.LongType())])

    def state(self) -> dict:
        return self.versions.read({"parts": [], "dead": [], "next": 1, "rows": 0, "dead_rows": 0})

    def parts(self) -> list[str]:
        return self.state()["parts"]

    def _commit(self, parts: list[str]) -> None:
        self.versions.write({**self.state(), "parts": parts})

    def _named(self) -> set[str]:
        state = self.state()
        return {*state["parts"], *state["dead"]}

    def read(self) -> DataFrame:
        state = self.state()
        rows = super().read()
        if state["dead"]:
            dead = self.spark.read.schema(self.dead_schema).parquet(*[f"{self.root}/{p}" for p in state["dead"]])
            dead = dead.groupBy(F.col(self.key).alias("_key")).agg(F.max("_before").alias("_before"))
            rows = rows.join(dead, (F.col(self.key) == F.col("_key")) & (F.col("_change") < F.col("_before")), "left_anti")
        return rows.select(*self.plain.fieldNames())

    def merge(self, df: DataFrame, replaced: DataFrame | None = None) -> None:
        """Add rows of distinct keys; `replaced` are those of their keys that are there already."""
        self.merge_staged(self.stage(df), replaced)

    def stage(self, df: DataFrame) -> str:
        """Write rows of distinct keys as a part that is not in force yet."""
        return self._write_part(df.withColumn("_change", F.lit(self.state()["next"]).cast("bigint")), ())

    def staged(self, part: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/{part}").select(*self.plain.fieldNames())

    def drop_staged(self, part: str) -> None:
        self.files.delete(f"{self.root}/{part}")

    def merge_staged(self, part: str, replaced: DataFrame | None = None) -> None:
        """`merge` of the rows of a staged part, the last one that was written."""
        state = self.state()
        change = state["next"]
        count = lambda name: self.spark.read.parquet(f"{self.root}/{name}").count()
        state |= {"parts": [*state["parts"], part], "next": change + 1, "rows": state["rows"] + count(part)}
        if replaced is not None:
            dead = f"part-{uuid.uuid4().hex}"
            write_parquet(replaced.select(self.key, F.lit(change).cast("bigint").alias("_before")), f"{self.root}/{dead}")
            state |= {"dead": [*state["dead"], dead], "dead_rows": state["dead_rows"] + count(dead)}
        self.versions.write(state)

    def append(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        self.merge(df)

    def replace(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> None:
        change = self.state()["next"]
        part = self._write_part(df.withColumn("_change", F.lit(change).cast("bigint")), ())
        rows = self.spark.read.parquet(f"{self.root}/{part}").count()
        self.versions.write({"parts": [part], "dead": [], "next": change + 1, "rows": rows, "dead_rows": 0})

    def clear(self) -> None:
        self.versions.write({"parts": [], "dead": [], "next": self.state()["next"], "rows": 0, "dead_rows": 0})

    def compact(self, fanout: int = FANOUT) -> int:
        """Fold dead keys in if they are many; else merge parts of like size, which keep the numbers of their changes."""
        state = self.state()
        if state["dead_rows"] > self.FOLD_SHARE * state["rows"]:
            self.replace(self.read())
            return 1
        return super().compact(fanout)
