"""Query batches of a checked size.

Retrieval sends the queries to the corpus, never the corpus to the queries. What is
broadcast or closed over is therefore one batch of queries; these functions measure
it first and cut a larger set into several passes. Nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One pass takes at most so many queries and so many bytes of them. A text of n bytes
# has at most n/2 + 1 tokens, so the bytes also bound the table of query terms.
MAX_QUERIES = 4096
MAX_BYTES = 16 * 1024 * 1024


def _row_bytes(df: DataFrame):
    total = F.lit(0).cast("bigint")
    for field in df.schema:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = F.octet_length(c)
        elif isinstance(field.dataType, T.ArrayType):
            size = F.size(c) * 8
        else:
            size = F.lit(8)
        total = total + F.coalesce(size.cast("bigint"), F.lit(0)) + 8
    return total


def fits(df: DataFrame, max_rows: int = MAX_QUERIES, max_bytes: int = MAX_BYTES) -> bool:
    """Measure rows and bytes; true if both are within bounds."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return row["n"] <= max_rows and row["bytes"] <= max_bytes


@dataclass
class Batch:
    queries: DataFrame
    fits: bool


def query_batches(queries: DataFrame, max_rows: int = MAX_QUERIES, max_bytes: int = MAX_BYTES) -> list[Batch]:
    """The queries as they are if they fit, else as disjoint parts that each do.

    Rows that share a `query_id` (or have none) are one query, in every set: parts are cut by a
    hash of the id, and twice as many are made until each is measured to fit or holds one query. A
    single query beyond the bounds is marked as not fitting and searched without a broadcast.
    """
    if fits(queries, max_rows, max_bytes):
        return [Batch(queries, True)]
    n = 2
    while True:
        part = F.pmod(F.xxhash64("query_id"), F.lit(n))
        sizes = queries.groupBy(part.alias("part"), "query_id").agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(queries)).alias("bytes"))
        sizes = sizes.groupBy("part").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("ids"))
        # One small row per part.
        measured = [(r["part"], r["n"] <= max_rows and r["bytes"] <= max_bytes, r["ids"]) for r in sizes.collect()]
        if all(ok or ids == 1 for _, ok, ids in measured):
            return [Batch(queries.where(part == p), ok) for p, ok, _ in measured]
        n *= 2


def row_parts(queries: DataFrame, max_rows: int = MAX_QUERIES) -> list[DataFrame]:
    """The rows of one large query in parts of about `max_rows`, equal rows told apart by their number."""
    n = max(1, -(-queries.count() // max_rows))
    columns = queries.columns
    row = F.xxhash64(F.xxhash64(*columns), F.row_number().over(Window.partitionBy(F.xxhash64(*columns)).orderBy(F.lit(0))))
    numbered = queries.withColumn("__part", F.pmod(row, F.lit(n)))
    return [numbered.where(F.col("__part") == i).select(*columns) for i in range(n)]


def per_batch(queries: DataFrame, search: Callable[[Batch], DataFrame], max_rows: int = MAX_QUERIES) -> DataFrame:
    """Run `search` on every batch and put the results together."""
    return reduce(DataFrame.unionByName, [search(b) for b in query_batches(queries, max_rows)])


def lookup_join(big: DataFrame, small: DataFrame, key: str, spread: str, small_fits: bool, salts: int = 32) -> DataFrame:
    """Inner join of a big table with a lookup table.

    A lookup table measured to fit is broadcast. Otherwise both are shuffled, and as
    one key may hold a third of the big table, its rows are dealt out by `spread`
    over `salts` sub-keys while the lookup rows are repeated for each.
    """
    if small_fits:
        return big.join(F.broadcast(small), key)
    salted = big.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    repeated = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [key, "__salt"]).drop("__salt")
