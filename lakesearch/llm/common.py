"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakesearch.session import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(text: Column | str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ranged(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """The rows in ranges of `order`, each with its range's number `part`, as a written table.

    It is written so that later passes agree on the numbers, whatever partitions the
    optimizer merges for each of them.
    """
    by = [F.col(c) for c in order]
    rows = (df.repartitionByRange(*by) if parts is None else df.repartitionByRange(parts, *by)).withColumn("part", F.spark_partition_id())
    return written(rows)


def within_part(order: list[str]):
    return Window.partitionBy("part").orderBy(*order)


#: Rows of ids (16 MB of longs at most) up to which a list of rejected rows is broadcast.
BROADCAST_ROWS = 1_000_000


def without(rows: DataFrame, rejected: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys are not among `rejected` (distinct keys, at most two longs).

    The list is written and counted first: a short one is sent to the tasks, so that the texts
    stay where they are; a longer one is joined by a shuffle.
    """
    rejected = written(rejected)
    short = rejected.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(rejected) if short else rejected, keys, "left_anti")
