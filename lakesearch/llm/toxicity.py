"""Toxicity by a convolutional text classifier, trained here in numpy.

A word's embedding is the sum of three hashed rows: of the word and of its first four and
six bytes. Filters of widths 1, 2 and 3 run over the words, each is pooled by its maximum
over the whole text, and a logistic layer gives the score. Thresholds are calibrated for
each language, told from the text's own accented letters; scores are shifted so that the
threshold of every language lies at THRESHOLD.

The model is fitted on every labelled row that is not held out, whole texts: seven tenths train it, three
tenths calibrate it. Training rows are dealt by a hash over shards, once; a task trains one shard for
an epoch, and what the shards changed is averaged, number by number over those that changed it. Thresholds
are found by a distributed sort. Every text is scored as a whole. Scoring looks at the text alone.

Defined results: null and empty texts are learned and scored as texts without words; rows alike in
id and text are learned once; without labels of both kinds every score is 0; repeated rows give
repeated rows; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakesearch.llm.bpe import BATCH_CHARS, in_slices
from lakesearch.llm.common import BROADCAST_ROWS, ranged, whole_text
from lakesearch.llm.words import word_hashes
from lakesearch.session import written

THRESHOLD = 0.3
#: Tenths of the labelled rows that are kept for calibration.
CALIBRATION_TENTHS = 3
#: Training rows and characters of one shard, on average: a task holds the word numbers of one.
SHARD_ROWS, SHARD_CHARS = 4000, 20_000_000
#: Numbers of the model, and shards, that are summed at once.
CHUNK, FAN = 8192, 64
EPOCHS, BATCH = 6, 32
ROWS, DIM, FILTERS, WIDTHS = 1 << 15, 12, 16, (1, 2, 3)
PREFIXES = (4, 6)
#: Positions that are convolved at once.
STEP = 1 << 15
LANGUAGE_POSITIVES = 10

# ---- fixed values: second UTF-8 bytes, after 0xC3, of letters that tell a language ----
MARKS = {"de": "äöüß", "es": "ñíóáú", "fr": "éèêçà"}
# ---------------------------------------------------------------------------------------
LANGUAGES = ["en", *MARKS]
_MARK = {name: np.array([c.encode()[1] for c in letters]) for name, letters in MARKS.items()}


def language(text: str) -> int:
    """Number of the language that the accented letters point to; the first if there are few."""
    b = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    second = np.bincount(b[1:][b[:-1] == 0xC3], minlength=256) if len(b) > 1 else np.zeros(256, int)
    counts = [second[m].sum() for m in _MARK.values()]
    return int(np.argmax(counts)) + 1 if max(counts) * 200 > len(b) else 0


def layout(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows (3, positions), first position and words of each text.

    Every text is followed by two blank positions; a text without words has one more.
    """
    hashes, counts = word_hashes(texts, PREFIXES)
    room = np.maximum(counts, 1) + 2
    first = np.cumsum(room) - room
    rows = np.full((3, int(room.sum())), ROWS, np.int32)
    at = np.arange(len(hashes[0])) + np.repeat(first - (np.cumsum(counts) - counts), counts)
    for i, h in enumerate(hashes):
        rows[i, at] = ((h + np.uint64(i)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(49)).astype(np.int32)
    return rows, first, counts


class Net:
    """Parameters; `e` has one more row of zeros for blank positions."""

    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.e = (rng.standard_normal((ROWS + 1, DIM)) * 0.1).astype(np.float32)
        self.e[ROWS] = 0
        self.w = [(rng.standard_normal((k, DIM, FILTERS)) * np.sqrt(2 / (k * DIM))).astype(np.float32) for k in WIDTHS]
        self.b = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.u = (rng.standard_normal(FILTERS * len(WIDTHS)) * 0.3).astype(np.float32)
        self.c = np.zeros(1, np.float32)
        self.shift = np.zeros(len(LANGUAGES))

    def tables(self) -> np.ndarray:
        """What each embedding row adds to each filter at each offset."""
        return np.concatenate([np.concatenate([self.e @ w[o] for o in range(len(w))], axis=1) for w in self.w], axis=1)

    def pooled(self, table: np.ndarray, rows: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The largest value of each filter in each text."""
        total = rows.shape[1]
        out = np.full((len(first), len(self.b)), -np.inf, np.float32)
        last = first + np.maximum(counts, 1)
        for s in range(0, total, STEP):
            n = min(STEP, total - s)
            seg = rows[:, s : s + n + 2]
            seg = np.pad(seg, ((0, 0), (0, n + 2 - seg.shape[1])), constant_values=ROWS)
            each = table[seg[0]] + table[seg[1]] + table[seg[2]]
            z, column = [], 0
            for k in WIDTHS:
                z.append(sum(each[o : o + n, column + o * FILTERS : column + (o + 1) * FILTERS] for o in range(k)))
                column += k * FILTERS
            z = np.concatenate(z, axis=1)
            owner = np.searchsorted(first, np.arange(s, s + n), "right") - 1
            z[np.arange(s, s + n) >= last[owner]] = -np.inf
            here, at = np.unique(owner, return_index=True)
            out[here] = np.maximum(out[here], np.maximum.reduceat(z, at, axis=0))
        return out

    def logits(self, texts: list[str], table: np.ndarray | None = None) -> np.ndarray:
        if not texts:
            return np.empty(0)
        rows, first, counts = layout(texts)
        z = self.pooled(self.tables() if table is None else table, rows, first, counts)
        return np.maximum(z + self.b, 0).astype(np.float64) @ self.u + float(self.c[0])

    def scores(self, texts: list[str], table: np.ndarray | None = None) -> np.ndarray:
        shift = self.shift[[language(t) for t in texts]] if texts else 0.0
        return 1 / (1 + np.exp(-np.clip(self.logits(texts, table) + shift, -30, 30)))


class _Adam:
    def __init__(self, p: np.ndarray, rate: float):
        self.p, self.rate, self.t, self.m, self.v = p, rate, 0, np.zeros_like(p), np.zeros_like(p)

    def step(self, g: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (g - self.m)
        self.v += 0.001 * (g * g - self.v)
        self.p -= self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def _winners(net: Net, rows: np.ndarray, first: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest value of each filter in each text and its position, in slices of STEP positions."""
    last = first + np.maximum(counts, 1)
    top = np.full((len(first), len(net.b)), -np.inf, np.float32)
    won = np.zeros(top.shape, np.int64)
    for s in range(0, rows.shape[1], STEP):
        n = min(STEP, rows.shape[1] - s)
        x = sum(net.e[r[s : s + n + 2]] for r in rows)
        x = np.concatenate([x, np.zeros((n + 2 - len(x), DIM), np.float32)])
        z = np.concatenate([sum(x[o : o + n] @ w[o] for o in range(len(w))) for w in net.w], axis=1)
        for i in range(np.searchsorted(last, s, "right"), np.searchsorted(first, s + n, "left")):
            from_, to = max(first[i] - s, 0), min(last[i] - s, n)
            if from_ < to:
                at = z[from_:to].argmax(axis=0)
                value = np.take_along_axis(z[from_:to], at[None], axis=0)[0]
                better = value > top[i]
                top[i][better], won[i][better] = value[better], (s + from_ + at)[better]
    return top, won


class _Trainer:
    """A net with the state of its optimizers."""

    def __init__(self, seed: int = 1):
        self.net = Net(seed)
        self.opts = [_Adam(p, 0.004) for p in (*self.net.w, self.net.b, self.net.u, self.net.c)]
        self.spread = np.full((ROWS + 1, 1), 1e-3, np.float32)

    def _numbers(self) -> list[np.ndarray]:
        return [self.net.e, self.spread, *[x for o in self.opts for x in (o.p, o.m, o.v)]]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self._numbers()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for x in self._numbers():
            x[...] = flat[at : at + x.size].reshape(x.shape)
            at += x.size

    def epoch(self, laid: np.ndarray, all_counts: np.ndarray, labels: np.ndarray, seed: int = 1) -> None:
        """Mini-batches of a `layout`; the gradient reaches only the positions that won the pooling."""
        net, all_room = self.net, np.maximum(all_counts, 1) + 2
        end = np.cumsum(all_room)
        order = np.random.default_rng(seed).permutation(len(end))
        for s in range(0, len(order), BATCH):
            batch = order[s : s + BATCH]
            rows = np.concatenate([laid[:, end[i] - all_room[i] : end[i]] for i in batch], axis=1)
            counts, room = all_counts[batch], all_room[batch]
            top, won = _winners(net, rows, np.cumsum(room) - room, counts)
            n, top = rows.shape[1], top + net.b
            a = np.maximum(top, 0)
            p = 1 / (1 + np.exp(-np.clip(a @ net.u + net.c[0], -30, 30)))
            d = ((p - labels[batch]) / len(batch)).astype(np.float32)
            g = d[:, None] * net.u * (top > 0)
            grads, at, val = [], [], []
            for k, w in enumerate(net.w):
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                pos, gk = won[:, cols], g[:, cols]
                gw = np.zeros_like(w)
                for o in range(len(w)):
                    here = np.minimum(pos + o, n - 1)
                    gw[o] = np.einsum("bf,bfd->df", gk, sum(net.e[r[here]] for r in rows))
                    at.append(here.ravel())
                    val.append((gk[:, :, None] * w[o].T[None]).reshape(-1, DIM))
                grads.append(gw)
            for opt, grad in zip(self.opts, (*grads, g.sum(axis=0), a.T @ d, np.array([d.sum()], np.float32))):
                opt.step(grad)
            at, val = np.concatenate(at), np.concatenate(val)
            ids, back = np.unique(rows[:, at].ravel(), return_inverse=True)
            ge = np.zeros((len(ids), DIM), np.float32)
            np.add.at(ge, back, np.tile(val, (3, 1)))
            self.spread[ids] += (ge * ge).mean(axis=1, keepdims=True)
            net.e[ids] -= 0.05 * ge / np.sqrt(self.spread[ids])
            net.e[ROWS] = 0


def train(texts: list[str], labels: np.ndarray) -> Net:
    """A net from one shard's texts."""
    trainer, (laid, _, counts) = _Trainer(), layout(texts)
    for epoch in range(EPOCHS):
        trainer.epoch(laid, counts, labels, epoch + 1)
    return trainer.net


def _packed(own: pd.DataFrame) -> pd.DataFrame:
    """A shard as one row: the embedding rows of its texts, the words of each, the labels."""
    own = own.sort_values(["doc_id", "text"])
    laid, _, counts = layout(own["text"].tolist())
    return pd.DataFrame({"shard": own["shard"][:1], "laid": [laid.astype(np.uint16).tobytes()], "counts": [counts.astype(np.int64).tobytes()], "toxic": [own["toxic"].to_numpy(np.float64).tobytes()]})


def _summed(parts: pd.DataFrame) -> pd.DataFrame:
    """Sums of a chunk of the model over some shards, in the order of the shards."""
    total = np.zeros(1, np.float32)
    for x in parts.sort_values("shard")["sums"]:
        total = total + np.frombuffer(x, np.float32)
    return pd.DataFrame({"chunk": parts["chunk"][:1], "shard": [parts["into"].iloc[0]], "steps": [parts["steps"].max()], "sums": [total.tobytes()]})


def _epoch(packed: DataFrame, shards: int, flat: np.ndarray, steps: int, epoch: int) -> tuple[np.ndarray, int]:
    """Each shard trains the model for an epoch; the mean of what they changed, and the largest number of steps."""
    shared = packed.sparkSession.sparkContext.broadcast((flat, steps))  # of fixed size: the numbers of one model

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, done = shared.value
        for batch in batches:
            for shard, laid, counts, toxic in zip(*batch.columns):
                mine = _Trainer()
                mine.load(before)
                for o in mine.opts:
                    o.t = done
                mine.epoch(np.frombuffer(laid.as_buffer(), np.uint16).reshape(3, -1), np.frombuffer(counts.as_buffer(), np.int64), np.frombuffer(toxic.as_buffer(), np.float64), epoch + 1)
                delta = mine.flat() - before
                # Beside each change whether there is one: the mean is over the shards that have met a word.
                sums = [np.stack([d, d != 0]).tobytes() for d in np.split(delta, range(CHUNK, len(delta), CHUNK))]
                n = len(sums)
                columns = [pa.array(range(n), pa.int32()), pa.array([shard.as_py()] * n, pa.int32()), pa.array([mine.opts[0].t] * n, pa.int64()), pa.array(sums, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "shard", "steps", "sums"])

    kind = "chunk int, shard int, steps long, sums binary"
    found = packed.mapInArrow(changed, kind)
    while True:
        found = found.withColumn("into", (F.col("shard") / FAN).cast("int")).groupBy("chunk", "into").applyInPandas(_summed, kind)
        shards = -(-shards // FAN)
        if shards == 1:
            break
    # One model's numbers come to the driver, whatever the number of shards.
    rows = found.toPandas().sort_values("chunk")
    shared.unpersist()
    total, hits = np.concatenate([np.frombuffer(x, np.float32).reshape(2, -1) for x in rows["sums"]], axis=1)
    return total / np.maximum(hits, 1), int(rows["steps"].max())


def train_shards(rows: DataFrame, shards: int) -> Net:
    """A net from (doc_id, text, toxic) rows, dealt over `shards`."""
    dealt = rows.select("doc_id", "text", "toxic", F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"))
    # One shuffle serves the distinct rows and the shards.
    dealt = dealt.repartition("shard").distinct()
    # Words are numbered once; each epoch reads the numbers.
    packed = written(dealt.groupBy("shard").applyInPandas(_packed, "shard int, laid binary, counts binary, toxic binary"))
    trainer, steps = _Trainer(), 0
    for epoch in range(EPOCHS):
        change, steps = _epoch(packed, shards, trainer.flat(), steps, epoch)
        trainer.load(trainer.flat() + change)
    return trainer.net


def _best_cuts(scored: DataFrame, groups: list[str]) -> dict:
    """For each group the threshold with the best F1, in the middle of the gap it lies in, and its positives.

    Equal scores are one place. Places are sorted in ranges; running sums over a range start from
    the sums of the ranges before it, one row each.
    """
    places = scored.groupBy(*groups, "logit").agg(F.sum("toxic").alias("hits"), F.count("*").alias("n")).withColumn("down", -F.col("logit"))
    rows = ranged(places, [*groups, "down"])
    starts = rows.groupBy(*groups, "part").agg(F.sum("hits").alias("part_hits"), F.sum("n").alias("part_n"), F.max("logit").alias("next_part"))
    ahead = Window.partitionBy(*groups).orderBy("part")
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select(
        *groups, "part", F.coalesce(F.sum("part_hits").over(before), F.lit(0)).alias("hits_before"), F.coalesce(F.sum("part_n").over(before), F.lit(0)).alias("n_before"),
        F.sum("part_hits").over(Window.partitionBy(*groups)).alias("positives"), F.lead("next_part").over(ahead).alias("next_part"),
    )
    own = Window.partitionBy(*groups, "part").orderBy("down")
    rows = rows.join(F.broadcast(starts), [*groups, "part"])
    hits, n = F.col("hits_before") + F.sum("hits").over(own), F.col("n_before") + F.sum("n").over(own)
    below = F.coalesce(F.lead("logit").over(own), "next_part", F.col("logit") - 1)
    f1 = 2 * hits / (n + F.col("positives"))
    rows = rows.select(*groups, "positives", "logit", f1.alias("f1"), ((F.col("logit") + below) / 2).alias("cut"))
    best = rows.groupBy(*groups).agg(F.max(F.struct("f1", "logit", "cut")).alias("best"), F.max("positives").alias("positives"))
    # One row a language.
    return {tuple(r[g] for g in groups): (r["best"]["cut"], r["positives"]) for r in best.collect()}


def calibrate(net: Net, rows: DataFrame) -> None:
    """Put every language's best threshold at THRESHOLD, from (doc_id, text, toxic) rows."""
    goal = np.log(THRESHOLD / (1 - THRESHOLD))
    shared = rows.sparkSession.sparkContext.broadcast(net)  # of fixed size: ROWS x DIM numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.tables()
        for whole in batches:
            for batch in in_slices(whole, 1):
                texts = batch.column(1).to_pylist()
                names = pa.array([language(t) for t in texts], pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), names, pa.array(shared.value.logits(texts, table)), batch.column(2)], names=["row", "language", "logit", "toxic"])

    logits = rows.select(F.xxhash64("doc_id", "text"), "text", F.col("toxic").cast("long")).mapInArrow(run, "row long, language int, logit double, toxic long")
    scored = written(logits.groupBy("row").agg(F.min("language").alias("language"), F.min("logit").alias("logit"), F.max("toxic").alias("toxic")))
    net.shift[:] = goal - _best_cuts(scored, [])[()][0]
    for (k,), (cut, positives) in _best_cuts(scored, ["language"]).items():
        if positives >= LANGUAGE_POSITIVES:
            net.shift[k] = goal - cut


def held_out(key: Column) -> Column:
    """Rows whose labels are never looked at."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> Net | None:
    """A classifier from the labelled rows that are not held out; None without both labels."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Rows are dealt to training and calibration by a hash: none is in both.
    known = written(known.withColumn("part", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(10)) < CALIBRATION_TENTHS).cast("int")))
    docs = docs.select("doc_id", whole_text().alias("text"))
    # A short list of labels (a long and two ints a row) goes to the texts; a longer one meets them by a shuffle, once.
    few = known.count() <= BROADCAST_ROWS
    rows = docs.join(F.broadcast(known), "doc_id") if few else written(docs.join(known, "doc_id"))
    sizes = {r["part"]: r for r in rows.groupBy("part").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.min("toxic").alias("low"), F.max("toxic").alias("high")).collect()}
    if not sizes or min(r["low"] for r in sizes.values()) == max(r["high"] for r in sizes.values()):
        return None
    shards = max(1, -(-sizes[0]["n"] // SHARD_ROWS), -(-sizes[0]["chars"] // SHARD_CHARS)) if 0 in sizes else 0
    net = train_shards(rows.where("part = 0"), shards) if shards else Net()
    # A table too small for a calibration part of both labels is calibrated on all its rows.
    both = 1 in sizes and sizes[1]["low"] < sizes[1]["high"]
    calibrate(net, rows.where("part = 1") if both else rows)
    return net


def score_of(spark: SparkSession, net: Net | None):
    """The score as a function of a text column."""
    if net is None:
        return lambda text: F.lit(0.0)
    shared = spark.sparkContext.broadcast(net)  # of fixed size: ROWS x DIM numbers

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = shared.value.tables()
        for texts in batches:
            # As `in_slices` does: about BATCH_CHARS of text at a time, whatever the batch.
            group = (texts.str.len().cumsum() // BATCH_CHARS).to_numpy()
            parts = [shared.value.scores(own.tolist(), table) for _, own in texts.groupby(group, sort=False)]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return scores


def score(docs: DataFrame, net: Net | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) of every row."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if net is None:
        return rows.select(F.col("key").alias(key), F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(net)  # of fixed size: ROWS x DIM numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value.tables()
        for whole in batches:
            for batch in in_slices(whole, 1):
                found = shared.value.scores(batch.column(1).to_pylist(), table)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["key", "score"])

    scored = rows.mapInArrow(run, f"key {kind}, score double")
    return scored.select(F.col("key").alias(key), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
