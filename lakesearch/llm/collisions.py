"""Nearest neighbours by collision-counting hashing.

Each of PROJECTIONS directions gives one sorted array of projections. A query starts with
a narrow window around its own projection in every array; the windows are widened in small
steps (virtual rehashing), and vectors that have fallen into THRESHOLD of all windows are verified
by their inner product in double precision on the original values.

Inner products become distances by one more coordinate, sqrt(M^2 - |x|^2), with M the largest
norm of a shell: rows of norms within SHELL_RATIO of each other, so that one long vector
does not blur the rest. The query is scaled to M, which changes no order, and has 0 there.
Directions are Gaussian, so a vector at distance r misses a window of half width h with a known
probability. Windows stop once h is REACH times the distance of the k-th best score found: a
vector as near as that is then left out with a probability of at most MISS, whatever the data, so
the expected recall is at least 1 - MISS. Shells whose norm cannot reach that score are skipped.

All rows are indexed: the table is dealt into blocks of BLOCK_ROWS vectors and BLOCK_QUERIES queries,
a task searches a pair of blocks, and the best of all blocks are merged. A task's memory is
bounded by the blocks.

Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, neither do null ids; equal scores are ordered by id; of
repeated ids each row is a candidate of its own; fewer candidates than k give all; an empty
table gives no rows.
"""

from __future__ import annotations

from math import ceil, comb, erf, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakesearch.session import written

PROJECTIONS = 48
#: Share of the windows that a candidate must have fallen into.
THRESHOLD = 0.7
#: Probability that a vector as near as the k-th best found is left out.
MISS = 0.01
#: Factor by which windows are widened at a time.
GROWTH = 1.1
#: Smallest norm of a shell as a share of its largest; a shell of few rows is verified whole.
SHELL_RATIO = 0.8
WHOLE_SHELL = 64
BLOCK_ROWS = 1 << 16
BLOCK_QUERIES = 2048
SEED = 7


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    rows = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0))


def directions(length: int) -> np.ndarray:
    """PROJECTIONS Gaussian columns, one coordinate longer than the vectors."""
    return np.random.default_rng(SEED).standard_normal((length + 1, PROJECTIONS))


def reach(m: int, need: int, miss: float) -> float:
    """The half width, as a multiple of the distance, that fewer than `need` of m windows catch with probability `miss`."""

    def missed(z: float) -> float:
        p = erf(z / sqrt(2))
        return sum(comb(m, i) * p**i * (1 - p) ** (m - i) for i in range(need))

    low, high = 0.0, 16.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if missed(mid) > miss else (low, mid)
    return high


NEED = ceil(THRESHOLD * PROJECTIONS)
REACH = reach(PROJECTIONS, NEED, MISS)


def _exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    # Summed row by row in one order, so that equal vectors get equal scores.
    return (x * q).sum(axis=1)


def shells(norms: np.ndarray) -> list[np.ndarray]:
    """Row numbers by shells of similar norms, the largest norms first."""
    order = np.argsort(-norms, kind="stable")
    found, at = [], 0
    while at < len(order):
        end = int(np.searchsorted(-norms[order], -SHELL_RATIO * norms[order[at]], "right"))
        end = max(end, min(at + WHOLE_SHELL, len(order)))
        found.append(order[at:end])
        at = end
    return found


class Shell:
    """Projections of the rows of one shell, sorted by each direction."""

    def __init__(self, rows: np.ndarray, x: np.ndarray, norms: np.ndarray, a: np.ndarray):
        self.rows, self.largest = rows, float(norms[rows].max())
        if len(rows) > WHOLE_SHELL:
            px = x[rows] @ a[:-1] + np.sqrt(np.maximum(0.0, self.largest**2 - norms[rows] ** 2))[:, None] * a[-1]
            self.order = np.argsort(px, axis=0).astype(np.int32).T.copy()
            self.sorted = np.sort(px, axis=0).T.copy()
            self.width = np.median(np.std(px, axis=0)) * 0.25 or 1e-9 * self.largest


class Windows:
    """The windows of one query in a shell, and how many of them each row has fallen into."""

    def __init__(self, shell: Shell, pq: np.ndarray):
        self.shell, self.pq = shell, pq.tolist()
        n, m = len(shell.rows), len(pq)
        self.counts, self.seen = np.zeros(n, np.uint8 if m < 256 else np.int32), np.zeros(n, bool)
        self.lo = [int(row.searchsorted(v)) for row, v in zip(shell.sorted, self.pq)]
        self.hi = self.lo.copy()

    def widen(self, half: float) -> np.ndarray:
        """The rows that have newly fallen into NEED windows."""
        for j, (row, order, v) in enumerate(zip(self.shell.sorted, self.shell.order, self.pq)):
            left, right = int(row.searchsorted(v - half, "left")), int(row.searchsorted(v + half, "right"))
            if left < self.lo[j]:
                self.counts[order[left : self.lo[j]]] += 1
                self.lo[j] = left
            if right > self.hi[j]:
                self.counts[order[self.hi[j] : right]] += 1
                self.hi[j] = right
        new = np.flatnonzero((self.counts >= NEED) & ~self.seen)
        self.seen[new] = True
        return self.shell.rows[new]

    def whole(self) -> bool:
        return max(self.lo) == 0 and min(self.hi) == len(self.shell.rows)


def search_block(ids: np.ndarray, x: np.ndarray, qids: np.ndarray, q: np.ndarray, a: np.ndarray, k: int) -> tuple[list[tuple[int, int, float]], int]:
    """(query, id, score) of the best k of the block for each query, and how many pairs were verified."""
    norms = np.sqrt((x * x).sum(axis=1))
    parts = [Shell(rows, x, norms, a) for rows in shells(norms)]
    top = float(norms.max())
    x32 = (x / top).astype(np.float32)
    # Rough scores, as shares of the largest, choose what is verified; they are off by less than the slack.
    slack = 1.2e-7 * (x.shape[1] + 4)
    found, verified = [], 0
    for i in range(len(qids)):
        size = float(np.sqrt((q[i] * q[i]).sum()))
        q32 = (q[i] / size).astype(np.float32)
        near, rough, bar = np.empty(0, np.int64), np.empty(0, np.float32), -np.inf

        def take(rows: np.ndarray) -> None:
            nonlocal near, rough, bar
            rows = rows[ids[rows] != qids[i]]
            near, rough = np.append(near, rows), np.append(rough, x32[rows] @ q32)
            if len(near) >= k:
                bar = float(np.partition(rough, len(rough) - k)[len(rough) - k]) - slack

        for shell in parts:
            if shell.largest < bar * top:
                break
            if len(shell.rows) <= WHOLE_SHELL:
                take(shell.rows)
                continue

            def far() -> float:
                # Scaled to the shell, a score s is at distance sqrt(2 M^2 - 2 M s / |q|).
                return REACH * sqrt(max(0.0, 2 * shell.largest * (shell.largest - bar * top))) if bar > -np.inf else np.inf

            # With a score of earlier shells, the first windows are a few steps short of what it asks for.
            half = max(shell.width, far() / GROWTH**4) if bar > -np.inf else shell.width
            windows = Windows(shell, q[i] @ a[:-1] * (shell.largest / size))
            while True:
                take(windows.widen(half))
                if half >= far() or windows.whole():
                    break
                half = min(half * GROWTH, far())
        verified += len(near)
        if len(near) > k:
            near = near[rough >= bar - slack]
        score = _exact(x[near], q[i])
        best = np.lexsort((ids[near], -score))[:k]
        found += [(int(qids[i]), int(ids[near[b]]), float(score[b])) for b in best]
    return found, verified


def nearest(rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each query id.

    Equal rows are one row, as candidates and as queries. Rows that share an id but not the vector are
    searched each by itself; an id is answered once, and finds another id once, by its best score.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    spark = rows.sparkSession
    data = written(usable(rows, key, vector).distinct())
    asked = written(usable(queries, key, vector).distinct())
    n, n_q = data.count(), asked.count()
    if not n or not n_q:
        return spark.createDataFrame([], schema)
    a = directions(data.select(F.size("v")).first()[0])
    v_blocks = -(-n // BLOCK_ROWS)
    q_blocks = max(-(-n_q // BLOCK_QUERIES), min(n_q, -(-spark.sparkContext.defaultParallelism // v_blocks)))

    def block(name: str, count: int, salt: int):
        return F.pmod(F.xxhash64("id", "v", F.lit(salt)), F.lit(count)).cast("int").alias(name)

    def every(name: str, count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

    sides = data.select("id", "v", block("vb", v_blocks, 1), every("qb", q_blocks)), asked.select("id", "v", block("qb", q_blocks, 2), every("vb", v_blocks))

    def search(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})
        if not len(data) or not len(asked):
            return empty
        x = np.array(data["v"].tolist())
        found, _ = search_block(data["id"].to_numpy(), x, asked["id"].to_numpy(), np.array(asked["v"].tolist()), a, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]) if found else empty

    grids = [s.repartition(v_blocks * q_blocks, "vb", "qb").groupBy("vb", "qb") for s in sides]
    best = grids[0].cogroup(grids[1]).applyInPandas(search, "query_id long, vec_id long, score double")
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
