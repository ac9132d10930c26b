"""Contiguous shards of near equal bytes, cut from a global prefix sum.

The rows are put in ranges of (digest of the text, id), so equal texts lie side by side.
Each range has a running sum; the ranges' totals, one row each, are summed in turn, and
the two together give every row's place in the whole. A group of equal texts stays on one shard
whenever it fits one. Heavy groups, over 1/HEAVY_PARTS of a shard, are fewer than shards times
HEAVY_PARTS: they come first in the order, each, the largest first, on the shard with the
least bytes so far. All that follows is cut where the sum reaches what each shard lacks to its equal
share, by the middle of each group; only a group larger than a shard is divided.

Only ids, sizes and digests are shuffled. Defined results: null text has no bytes (its
size is 1); repeated rows take one slot each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesearch.llm.common import ranged, whole_text, within_part
from lakesearch.session import written

#: A group over this part of a shard is heavy.
HEAVY_PARTS = 100


def place(rows: DataFrame, order: list[str], size: str = "size") -> DataFrame:
    """Every row with `position` (bytes before it) and `number` (rows before it), both global."""
    parts = ranged(rows, order)
    totals = parts.groupBy("part").agg(F.sum(size).alias("bytes"), F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("part_position"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_number"),
    )
    inside = within_part(order)
    running = parts.withColumns(
        {
            "position": F.sum(size).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(size),
            "number": F.row_number().over(inside) - 1,
        }
    )
    return written(
        running.join(starts, "part").select(
            *rows.columns,
            (F.col("position") + F.col("part_position")).alias("position"),
            (F.col("number") + F.col("part_number")).alias("number"),
        )
    )


def packed(heavy: list[tuple[str, int]], shards: int) -> tuple[dict[str, int], list[int]]:
    """The shard of each heavy group (group, bytes), and the bytes of each shard."""
    loads, of = [0] * shards, {}
    for group, n in sorted(heavy, key=lambda g: (-g[1], g[0])):
        of[group] = s = loads.index(min(loads))
        loads[s] += n
    return of, loads


def cuts(loads: list[int], total: int) -> list[int]:
    """Twice the place, among the bytes not packed, at which each shard but the first begins."""
    shards, rest = len(loads), total - sum(loads)
    lacks = [max(0, total - shards * load) for load in loads]
    return [-(-2 * rest * sum(lacks[:s]) // max(1, sum(lacks))) for s in range(1, shards)]


def byte_shards(rows: DataFrame, shards: int, group: str = "digest", key: str = "doc_id", size: str = "size") -> DataFrame:
    """The rows with `shard` (int) and `slot` (long, gapless from 0 in each shard)."""
    rows = written(rows)
    groups = written(rows.groupBy(group).agg(F.sum(size).alias("n")))
    total = groups.agg(F.sum("n")).first()[0] or 0
    heavy = groups.where((F.col("n") * (shards * HEAVY_PARTS) > total) & (F.col("n") * shards <= total)).collect()  # fewer than shards * HEAVY_PARTS
    of, loads = packed([tuple(r) for r in heavy], shards)
    # Heavy groups come by shard, then the rest.
    if of:
        values = ", ".join(f"('{g}', {s})" for g, s in of.items())
        names = rows.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t(`{group}`, `block`)")
        rows = rows.join(F.broadcast(names), group, "left").withColumn("block", F.coalesce("block", F.lit(shards)))
    else:
        rows = rows.withColumn("block", F.lit(shards))
    placed = place(rows, ["block", group, key], size)
    before, places = sum(loads), cuts(loads, total)

    def shard_of(first: Column, length: Column) -> Column:
        middle = (first - before) * 2 + length
        return sum([F.when(middle >= F.lit(c), 1).otherwise(0) for c in places], F.lit(0)).cast("int")

    packed_row = F.col("block") < shards
    placed = placed.withColumn("shard", F.when(packed_row, F.col("block")).otherwise(shard_of(F.col("position"), F.col(size))))
    # One row a shard: the group at its start, which the cut may have divided.
    at_cuts = [r["g"] for r in placed.where(~packed_row).groupBy("shard").agg(F.min(F.struct("position", F.col(group).alias("g")))["g"].alias("g")).collect()]
    cut = placed.where(F.col(group).isin(at_cuts)).groupBy(group).agg(F.min("position").alias("a"), F.sum(size).alias("n"))
    shard = F.col("shard")
    for r in cut.where(F.col("n") * shards <= total).select(group, shard_of(F.col("a"), F.col("n")).alias("s")).collect():
        shard = F.when(F.col(group) == r[0], F.lit(r["s"])).otherwise(shard)
    placed = placed.withColumn("shard", shard)
    # Two rows a shard: where its packed rows and the others begin.
    first = F.lit(0).cast("long")
    blocks = {(r["shard"], r["p"]): (r["first"], r["rows"]) for r in placed.groupBy("shard", packed_row.alias("p")).agg(F.min("number").alias("first"), F.count("*").alias("rows")).collect()}
    for (s, p), (start, _) in blocks.items():
        start -= 0 if p else blocks.get((s, True), (0, 0))[1]
        first = F.when((F.col("shard") == s) & (packed_row if p else ~packed_row), F.lit(start).cast("long")).otherwise(first)
    return placed.withColumn("slot", (F.col("number") - first).cast("long")).drop("position", "number", "block")


def sized(docs: DataFrame) -> DataFrame:
    """Ids, sizes and digests of the texts."""
    text = whole_text()
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest"),
    )
