"""A sparse document-term matrix in shards, and the interaction audit of five filters read from it.

A shard is a run of rows that one task reads, up to SHARD_BYTES of text (one row at least). A
task codes its shard's words by a dictionary of the shard. The words of all shards, one
row per shard and word, are then dealt by word and sorted by a hash of it, and each task
numbers its own words as they go by (words that share a hash are told apart); the tasks'
counts, one row each, are summed in front, which makes the numbers global and gapless. Neither texts nor matrix entries are dealt by word. Last, each
shard's entries are renumbered beside its own list of numbers. A matrix row is a list of columns and
one of counts; the list column of a shard is, in Arrow as on disk, its row starts and its flat columns: CSR.

Row sums are the words of a text, nonzero counts its distinct words.

Defined results: a null text is empty (no words); null part names count as the empty string, a
part being a value of `lang`; a null id has no labels, is no smaller id and has none; repeated
rows count each; several labels of an id: one suffices; an empty table gives no rows.
Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesearch.llm.bpe import in_slices
from lakesearch.llm.common import whole_text
from lakesearch.session import written

#: Text of one shard. Larger shards repeat fewer words; a task holds about ten times this.
SHARD_BYTES = 12 << 20
#: Words in one row of a shard's dictionary.
WORDS_A_ROW = 1024
#: Bits of a word's number within its task.
PART_BITS = 40

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def local_csr(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Row starts, column codes and counts of the texts' words, and the words by code.

    Words are split at blanks, tabs, line ends, vertical tabs and form feeds.
    """
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    cells = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)  # a copy, changed in place
    del lists, coded
    # Blanks at either end of a text give empty words; they are taken out of codes and dictionary.
    empty = pc.index(words, pa.scalar("", words.type)).as_py()
    if empty >= 0:
        real = codes != empty
        cells, codes = cells[real], codes[real]
        codes -= codes > empty
        words = pa.concat_arrays([words.slice(0, empty), words.slice(empty + 1)])
    width = max(1, len(words))
    cells *= width
    cells += codes
    del codes
    cells.sort()
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(cells)), bool), cells[1:] != cells[:-1]]))
    counts = np.diff(np.append(first, len(cells))).astype(np.int32)
    cells = cells[first]
    starts = np.searchsorted(cells, np.arange(len(texts) + 1, dtype=np.int64) * width)
    return starts, (cells % width).astype(np.int32), counts, words


def byte_sums(texts: pa.Array, wanted: np.ndarray) -> np.ndarray:
    """How many bytes of each text are `wanted` (a table of 256 booleans)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return np.diff(np.searchsorted(np.flatnonzero(wanted[data]), offsets - offsets[0]))


def local_shards(rows: DataFrame, text: str = "text", flags: dict[str, Callable[[pa.Array], np.ndarray]] | None = None) -> DataFrame:
    """Each shard coded by its own dictionary; a written table.

    A matrix row has `shard`, the columns of `rows` but for the text, `flags` (booleans taken of the
    texts), `codes` and `counts`; a dictionary row has `shard`, `words` and the code of the first of them.
    """
    flags = flags or {}
    keys = [c for c in rows.columns if c != text]
    rows = rows.select(whole_text(text).alias("text"), *keys)
    names = ["shard", *keys, *flags, "codes", "counts", "first_code", "words"]
    lists = "".join(f"{c} {rows.schema[c].dataType.simpleString()}, " for c in keys) + "".join(f"{c} boolean, " for c in flags)

    def shard(slices: list[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(slices).combine_chunks()
        texts, *own = (c.chunk(0) for c in whole.columns)
        starts, codes, counts, words = local_csr(texts)
        starts = pa.array(starts, pa.int32())
        lists = [pa.ListArray.from_arrays(starts, pa.array(x)) for x in (codes, counts)]
        number_of = lambda n: pa.array(np.full(n, number, np.int64))
        n, m = len(texts), len(words)
        matrix = [number_of(n), *own, *(pa.array(f(texts)) for f in flags.values()), *lists, pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.string()))]
        yield (first := pa.RecordBatch.from_arrays(matrix, names=names))
        cuts = np.append(np.arange(0, m, WORDS_A_ROW, dtype=np.int32), np.int32(m))
        k = len(cuts) - 1
        nothing = [pa.nulls(k, t) for t in first.schema.types[1:-2]]
        yield pa.RecordBatch.from_arrays([number_of(k), *nothing, pa.array(cuts[:-1]), pa.ListArray.from_arrays(pa.array(cuts), words)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, slices, size = TaskContext.get().partitionId() << 33, [], 0
        for whole in batches:
            for batch in in_slices(whole, 0):
                slices.append(batch)
                size += batch.column(0).nbytes
                if size >= SHARD_BYTES:
                    yield from shard(slices, number)
                    number, slices, size = number + 1, [], 0
                    pa.default_memory_pool().release_unused()  # the worker lives on; what a shard took goes back
        if slices:
            yield from shard(slices, number)

    return written(rows.mapInArrow(run, f"shard long, {lists}codes array<int>, counts array<int>, first_code int, words array<string>"))


def numbered_words(shards: DataFrame, with_words: bool = True) -> DataFrame:
    """(shard, code, place[, word]): every word of every shard with its number within its task; a written table.

    The upper bits of `place` are the task's number. `word` is given on the first row of each word only.
    """
    own = shards.where("words IS NOT NULL").select("shard", "first_code", F.posexplode("words").alias("at", "word"))
    own = own.select("shard", (F.col("first_code") + F.col("at")).alias("code"), "word", F.xxhash64("word").alias("hash"))
    dealt = own.repartition("hash").sortWithinPartitions("hash")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, last, known = TaskContext.get().partitionId() << PART_BITS, None, {}  # known: places of the words of the last hash
        for batch in batches:
            if not batch.num_rows:
                continue
            words, hashes = batch.column(2), batch.column(3).to_numpy()
            starts = np.concatenate([[hashes[0] != last], hashes[1:] != hashes[:-1]])
            changes = pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False)
            if len(known) > 1 or (changes & ~starts[1:]).any() or not starts[0] and words[0].as_py() not in known:
                new, places = np.zeros(len(words), bool), np.empty(len(words), np.int64)
                for i, (start, word) in enumerate(zip(starts.tolist(), words.to_pylist())):
                    known = {} if start else known
                    if word not in known:
                        known[word], new[i], n = n, True, n + 1
                    places[i] = known[word]
            else:
                new, places = starts, n - 1 + np.cumsum(starts)
                n = int(places[-1]) + 1
                known = {words[-1].as_py(): n - 1}
            last = hashes[-1]
            columns = [*batch.columns[:2], pa.array(places)]
            if with_words:
                columns.append(pc.if_else(pa.array(new), words, pa.scalar(None, words.type)))
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "code", "place", "word"][: len(columns)])

    return written(dealt.mapInArrow(run, "shard long, code int, place long" + ", word string" * with_words))


def _global(numbered: DataFrame) -> DataFrame:
    """`numbered_words` with `id`: the place in its task, behind all words of earlier tasks."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a task
    rows = numbered.withColumns({"part": F.shiftright("place", PART_BITS), "place": F.col("place").bitwiseAND((1 << PART_BITS) - 1)})
    firsts = rows.groupBy("part").agg((F.max("place") + 1).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return rows.join(F.broadcast(firsts), "part").withColumn("id", F.col("first") + F.col("place"))


def dictionary(numbered: DataFrame) -> DataFrame:
    """(word, id): every distinct word with its number, from 0 without gaps."""
    return _global(numbered).where("word IS NOT NULL").select("word", "id")


def csr_shards(shards: DataFrame, numbered: DataFrame) -> DataFrame:
    """The matrix rows of `local_shards` with the numbers of `dictionary` as `columns`, ascending in each row."""
    own = _global(numbered).select(F.col("shard").alias("of"), F.col("code").alias("own_code"), "id")
    matrix = shards.where("words IS NULL").drop("first_code", "words")

    def renumber(rows: pa.Table, numbers: pa.Table) -> pa.Table:
        """One shard, and one row for each of its words: both of bounded size."""
        ids = np.empty(numbers.num_rows, np.int64)
        ids[numbers["own_code"].to_numpy()] = numbers["id"].to_numpy()
        codes, counts = (rows[c].combine_chunks() for c in ("codes", "counts"))
        starts = codes.offsets.to_numpy() - codes.offsets[0].as_py()
        columns, flat = ids[codes.flatten().to_numpy()], counts.flatten().to_numpy()
        order = np.lexsort((columns, np.repeat(np.arange(len(codes)), np.diff(starts))))
        lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(x[order])) for x in (columns, flat)]
        return pa.table([*(rows[c] for c in names[:-2]), *lists], names=names)

    names = [*(c for c in matrix.columns if c not in ("codes", "counts")), "columns", "counts"]
    types = {f.name: f.dataType.simpleString() for f in matrix.schema} | {"columns": "array<bigint>"}
    return matrix.groupBy("shard").cogroup(own.groupBy("of")).applyInArrow(renumber, ", ".join(f"{c} {types[c]}" for c in names))


def row_totals(csr: DataFrame) -> DataFrame:
    """The matrix rows with `n_words` (row sum) and `n_distinct` (nonzero count) in place of their entries."""
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)
    return csr.withColumns({"n_words": total, "n_distinct": F.size("columns").cast("long")}).drop("columns", "counts")


#: A key on more than one row in this many is hot: there are fewer hot keys than this.
HOT_SHARE = 1000


def with_least(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """The rows with the least `value` of their key. Null values are passed over.

    Keys that hold a thousandth of the rows or more are at most HOT_SHARE, so theirs are
    broadcast; all others are joined by a shuffle, in which no key is large.
    """
    total = rows.count()
    per_key = written(rows.groupBy(key).agg(F.min(value).alias(name), F.count("*").alias("n")))
    hot = F.col("n") * HOT_SHARE > total
    many = F.broadcast(per_key.where(hot).select(key, F.col(name).alias("hot_least"), F.lit(True).alias("is_hot")))
    marked = rows.join(many, key, "left")
    rest = marked.where(F.col("is_hot").isNull()).drop("is_hot", "hot_least").join(per_key.where(~hot).select(key, name), key)
    return marked.where("is_hot").withColumn(name, F.col("hot_least")).drop("is_hot", "hot_least").unionByName(rest)


_CAPITALS, _MARKS = (np.isin(np.arange(256), list(b)) for b in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"))


def shouts(texts: pa.Array) -> np.ndarray:
    """More than a tenth of the code points are A to Z."""
    return 100 * byte_sums(texts, _CAPITALS) > 10 * pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)


def has_marks(texts: pa.Array) -> np.ndarray:
    return byte_sums(texts, _MARKS) > 0


def failures(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, part and `mask`, bit i set if it fails FILTERS[i]."""
    text = whole_text()
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    shards = local_shards(rows, flags={"c": shouts, "d": has_marks})
    totals = written(row_totals(csr_shards(shards, numbered_words(shards, with_words=False))))
    flags = with_least(totals, "digest", "doc_id", "least_id")
    fails = [
        F.col("n_words") < 100,
        100 * F.col("n_distinct") < 80 * F.col("n_words"),
        F.col("c"),
        F.col("d"),
        F.coalesce(F.col("least_id") < F.col("doc_id"), F.lit(False)),
    ]
    mask = sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))
    return flags.select("doc_id", "part", mask.alias("mask"))


def histogram(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part by the filters they fail."""
    per_id = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic")
    )
    # Rows alike are counted first: an id on many rows comes to the join once a part and mask.
    alike = failed.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    named = alike.where(F.col("doc_id").isNotNull()).join(per_id, "doc_id", "left")
    rest = alike.where(F.col("doc_id").isNull()).withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    n = lambda flag: F.sum(F.col("n") * F.coalesce(flag, F.lit(0)))
    return named.unionByName(rest).groupBy("part", "mask").agg(F.sum("n").alias("n"), n(F.col("good")).alias("good"), n(F.col("toxic")).alias("toxic"))


def audit(counts: DataFrame) -> DataFrame:
    """Every order of the filters, step by step, for every part; from `histogram`.

    A part has at most 32 masks, so it comes to one small row: arrays by mask.
    """
    masks = range(1 << len(FILTERS))
    per_mask = lambda c: F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0)).cast("long") for m in masks])
    parts = counts.groupBy("part").agg(per_mask("n").alias("n"), per_mask("good").alias("good"), per_mask("toxic").alias("toxic"))
    orders = F.split(F.lit(",".join(ORDERS)), ",")
    rows = parts.withColumn("filter_order", F.explode(orders))
    rows = rows.select("*", F.posexplode(F.split("filter_order", "")).alias("place", "own")).withColumn("step", F.col("place") + 1)
    bit = lambda letter: F.expr(f"shiftleft(1, ascii({letter}) - {ord(FILTERS[0])})")
    before = F.expr(f"aggregate(split(substring(filter_order, 1, place), ''), 0, (a, x) -> a | if(x = '', 0, shiftleft(1, ascii(x) - {ord(FILTERS[0])})))")
    rows = rows.withColumns({"own": bit("own"), "before": before})
    index = F.sequence(F.lit(0), F.lit(len(masks) - 1))

    def total(values: str, weight) -> Column:
        terms = F.transform(index, lambda m: F.element_at(values, m + 1) * weight(m).cast("long"))
        return F.aggregate(terms, F.lit(0).cast("long"), lambda a, x: a + x)

    own, before = F.col("own"), F.col("before")
    fails = lambda m: m.bitwiseAND(own) != 0
    earlier = lambda m: m.bitwiseAND(before) != 0
    # Of all orders, a filter comes first among the k that a document fails in one of k.
    share = lambda m: F.when(fails(m), F.lit(len(ORDERS)) / F.bit_count(m)).otherwise(F.lit(0))
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: ~fails(m) & ~earlier(m)).alias("kept"),
        total("n", lambda m: fails(m) & ~earlier(m)).alias("removed"),
        total("n", lambda m: fails(m) & earlier(m)).alias("redundant"),
        total("n", lambda m: m == own).alias("unique_fails"),
        total("good", lambda m: fails(m) & ~earlier(m)).alias("good_lost"),
        total("toxic", lambda m: fails(m) & ~earlier(m)).alias("toxic_lost"),
        total("n", share).alias("shapley"),
    )
