"""A stored keyword index: postings in blocks of one term, ordered by impact, and mergeable statistics.

A block holds up to BLOCK postings of one term with the highest share of a score (`top`) that
any of them can give. Blocks are sorted by term and impact, so a query reads the blocks of its
terms only (pushed filters on `term` and `top`, met by file and page statistics), and of
those only the ones that can still matter: the best block of each term gives every query a
bound on its k-th score; a block whose `top`, together with the best that all other terms
could add, stays below that bound holds no document of the result, whatever else is in it.

The index is a list of segments, one for each change of the corpus. A segment adds the blocks of
new documents, the numbers of removed ones, and signed counts: how many documents of each term,
how many in all and how many words came or went. Counts of segments simply add up, so a
new document is tokenised once and nothing else is. Segments of like size are merged, so their
number grows with the logarithm of the corpus.

`top` is taken with the mean length at writing time. With another mean m it is at most
top * max(1, m / m at writing), since a share grows at most as fast as the mean.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakesearch.operators import bm25
from lakesearch.operators.batches import Batch
from lakesearch.operators.scoring import BEST, best_of_postings
from lakesearch.session import scratch, written
from lakesearch.sources.files import Files, write_parquet
from lakesearch.sources.tables import Versions

BLOCK = 256
#: Up to so many terms are named in a filter that Spark hands to the file reader.
PUSHED_TERMS = 1000
#: Segments of one size class that are merged into one.
FANOUT = 8
#: Two sums of the same shares differ by less than this.
SLACK = 1e-7

_BLOCKS = "term string, top double, mean double, size int, docs array<long>, tfs array<int>, dls array<int>"


def share(tf: Column, dl: Column, mean: Column) -> Column:
    """What a posting adds to a score for a term of weight 1."""
    return tf * (bm25.K1 + 1) / (tf + bm25.K1 * (1 - bm25.B + bm25.B * dl / mean))


def _cutter(size: int):
    """Arrow-batch function: rows (term, doc, dl, tf, share, mean) sorted by term and falling share in, blocks out."""
    names = ["term", "top", "mean", "size", "docs", "tfs", "dls"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            terms = batch.column(0)
            new = np.concatenate([[True], pc.not_equal(terms.slice(1), terms.slice(0, n - 1)).to_numpy(zero_copy_only=False)])
            run = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
            starts = np.flatnonzero(run % size == 0)  # a batch's end also ends a block
            ends = np.append(starts, n).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), batch.column(c)) for c in (1, 3, 2)]
            first = [batch.column(c).take(pa.array(starts)) for c in (0, 4, 5)]
            yield pa.RecordBatch.from_arrays([*first, pa.array(np.diff(ends)), *lists], names=names)

    return cut


def blocks_of(postings: DataFrame, mean: Column) -> DataFrame:
    """Blocks of (term, doc, dl, tf) rows. A frequent term lies on several ranges: no task holds it whole."""
    rows = postings.select("term", "doc", F.col("dl").cast("int").alias("dl"), F.col("tf").cast("int").alias("tf"))
    top = share(F.col("tf"), F.col("dl"), mean.cast("double"))
    # Bounds of the ranges are sampled to the driver: only the first characters of a long term take part.
    rows = rows.repartitionByRange(F.substring("term", 1, 64), top.desc(), "doc")
    # What follows from the others is added behind the shuffle.
    rows = rows.select("term", "doc", "dl", "tf", top.alias("share"), mean.cast("double").alias("mean"))
    return rows.sortWithinPartitions("term", F.col("share").desc(), "doc").mapInArrow(_cutter(BLOCK), _BLOCKS)


def postings_in(blocks: DataFrame) -> DataFrame:
    """(term, doc, tf, dl) rows of blocks."""
    rows = blocks.select("term", F.explode(F.arrays_zip("docs", "tfs", "dls")).alias("p"))
    return rows.select("term", F.col("p.docs").alias("doc"), F.col("p.tfs").alias("tf"), F.col("p.dls").alias("dl"))


@dataclass
class Reader:
    """The index as it was when it was opened."""

    spark: SparkSession
    folders: list[str]
    n_docs: int
    total_len: int
    floor_: float | None
    docs: DataFrame  # doc, text: the corpus, for documents that match nothing

    @property
    def floor(self) -> Column:
        return F.lit(self.floor_).cast("double")

    @property
    def mean(self) -> float:
        return self.total_len / self.n_docs if self.n_docs else 0.0

    def _part(self, name: str, schema: str) -> DataFrame:
        if not self.folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{f}/{name}" for f in self.folders])

    @property
    def blocks(self) -> DataFrame:
        return self._part("blocks", _BLOCKS)

    @property
    def removed(self) -> DataFrame:
        return self._part("removed", "doc long")

    @property
    def terms(self) -> DataFrame:
        """(term, df): segments' signed counts, summed."""
        return self._part("terms", "term string, df long")

    def _named(self, rows: DataFrame, terms: list[str] | None) -> DataFrame:
        return rows if terms is None else rows.where(F.col("term").isin(terms))

    def idf(self, terms: list[str] | None = None) -> DataFrame:
        """(term, df, idf) of the terms that some document has."""
        counts = self._named(self.terms, terms).groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
        raw = bm25.raw_idf(F.lit(self.n_docs), F.col("df"))
        return counts.select("term", "df", F.when(raw < 0, self.floor).otherwise(raw).alias("idf"))

    def _postings(self, needs: DataFrame, terms: list[str] | None, least: list[tuple[str, float]] | None) -> DataFrame:
        """(doc, share, ...) of the postings in blocks whose `top` reaches `need`, with the other columns of `needs`."""
        grown = F.greatest(F.lit(1.0), F.lit(self.mean) / F.col("mean"))
        blocks = self._named(self.blocks, terms)
        if least is not None and least:
            # Per term, the least that any query needs; as literals they reach the file reader. The
            # factor for a grown mean differs by segment, so it stays out of the pushed bound.
            most = max(1.0, self.blocks_growth())
            pushed = F.lit(False)
            for term, need in least:
                pushed = pushed | ((F.col("term") == term) & (F.col("top") >= need / most))
            blocks = blocks.where(pushed)
        others = [c for c in needs.columns if c not in ("term", "need")]
        hits = blocks.join(F.broadcast(needs), "term").where(F.col("top") * grown >= F.col("need"))
        hits = hits.select(*others, F.explode(F.arrays_zip("docs", "tfs", "dls")).alias("p"))
        hits = hits.select(F.col("p.docs").alias("doc"), *others, share(F.col("p.tfs"), F.col("p.dls"), F.lit(self.mean)).alias("share"))
        return hits.join(self.removed, "doc", "left_anti") if self.has_removed() else hits

    def _hits(self, needs: DataFrame, terms: list[str] | None) -> DataFrame:
        """(n, doc, part) of the postings in blocks whose `top` reaches `need` for the query."""
        return self._postings(needs, terms, None).select("n", "doc", (F.col("w") * F.col("share")).alias("part"))

    def blocks_growth(self) -> float:
        least = self.blocks.agg(F.min("mean")).first()[0]
        return self.mean / least if least else 1.0

    def has_removed(self) -> bool:
        return not self.removed.isEmpty()

    def _needs(self, batch: Batch, k: int) -> tuple[DataFrame, DataFrame, list[str] | None]:
        """(numbered queries, needs, terms): for each query and term its weight, and the `top` a block must reach.

        `batch` is measured, so the distinct terms of its queries are a bounded list.
        """
        numbered = written(batch.queries.select("query_id", "query_text").withColumn("n", F.dense_rank().over(Window.orderBy("query_id"))))
        asked = written(bm25.query_terms(numbered, "n"))
        named = [r["term"] for r in asked.select("term").distinct().limit(PUSHED_TERMS + 1).collect()]
        terms = named if len(named) <= PUSHED_TERMS else None
        weights = asked.join(F.broadcast(self.idf(terms)) if terms is not None else self.idf(), "term")
        weights = written(weights.groupBy("n", "term").agg((F.sum("qtf") * F.max("idf")).alias("w")))
        grown = F.col("top") * F.greatest(F.lit(1.0), F.lit(self.mean) / F.col("mean"))
        own = self._named(self.blocks, terms).select("term", grown.alias("top")).join(F.broadcast(weights.select("term").distinct()), "term")
        # As many blocks of each term as surely hold k of its documents, unless documents have gone.
        best = own.withColumn("at", F.row_number().over(Window.partitionBy("term").orderBy(F.col("top").desc()))).where(F.col("at") <= 1 + k // BLOCK)
        heads = written(weights.join(F.broadcast(best.groupBy("term").agg(F.max("top").alias("head"), F.min("top").alias("enough"))), "term"))
        first = self._hits(heads.select("n", "term", "w", F.col("enough").alias("need")), terms)
        per_doc = first.groupBy("n", "doc").agg(F.sum("part").alias("score"))
        order = Window.partitionBy("n").orderBy(F.col("score").desc())
        kth = per_doc.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).groupBy("n").agg(F.min("score").alias("kth"), F.count("*").alias("found"))
        bound = F.when(F.col("found") >= k, F.col("kth"))
        all_terms = Window.partitionBy("n")
        rows = heads.join(F.broadcast(kth), "n", "left").withColumns({"most": F.sum(F.col("w") * F.col("head")).over(all_terms), "least_w": F.min("w").over(all_terms)})
        # Below a negative or zero weight nothing can be bounded: then all blocks are read.
        need = F.when((F.col("least_w") > 0) & bound.isNotNull(), (bound - SLACK - F.col("most")) / F.col("w") + F.col("head")).otherwise(F.lit(-1.0))
        return numbered, written(rows.select("n", "term", "w", need.alias("need"))), terms

    def _least(self, needs: DataFrame, terms: list[str] | None) -> list[tuple[str, float]] | None:
        if terms is None:
            return None
        return [(r["term"], r["need"]) for r in needs.groupBy("term").agg(F.min("need").alias("need")).collect()]

    def scores(self, batch: Batch, k: int) -> DataFrame:
        """(query_id, doc, score) with at least each query's k best documents among those that match."""
        numbered, needs, terms = self._needs(batch, k)
        # Of a term the blocks are read that any query needs, each once; postings meet by document,
        # one row each however many queries ask for the term.
        weights = bm25.weights_of(needs.select("n", "term", "w"))
        numbers = self.spark.createDataFrame(list(enumerate(weights.terms)), "t int, term string")
        wanted = needs.groupBy("term").agg(F.min("need").alias("need")).join(F.broadcast(numbers), "term")
        hits = self._postings(written(wanted), terms, self._least(needs, terms))
        shared = self.spark.sparkContext.broadcast(weights)
        best = hits.repartition("doc").sortWithinPartitions("doc").mapInArrow(best_of_postings(shared, k), BEST)
        return best.join(F.broadcast(numbered.select("n", "query_id").distinct()), "n").select("query_id", "doc", "score")

    def topk(self, batch: Batch, k: int, pad_zero: bool = True) -> DataFrame:
        """(query_id, doc, score, rank) for one measured batch, the same rows as `bm25.batch_topk`."""
        if not batch.fits:
            # A single query beyond the bound: its terms are joined by a shuffle, all blocks are read.
            plain = bm25.Bm25Index(self.docs, self.postings(), self.idf(), F.lit(self.n_docs), F.lit(self.mean), self.floor, by_doc=False)
            return bm25.batch_topk(batch, plain, k, pad_zero)
        scored = self.scores(batch, k)
        if pad_zero:
            scored = scored.unionByName(bm25._unmatched(batch.queries, self, k))
        return bm25._best(scored, k)

    def postings(self) -> DataFrame:
        rows = postings_in(self.blocks).select("doc", "term", "tf", "dl")
        return rows.join(self.removed, "doc", "left_anti")

    def blocks_read(self, batch: Batch, k: int) -> DataFrame:
        """One row: blocks of the queries' terms, blocks read for their k best, blocks of the index."""
        _, needs, terms = self._needs(batch, k)
        own = self._named(self.blocks, terms).select("term", "top", "mean")
        least = needs.groupBy("term").agg(F.min("need").alias("need"))
        grown = F.col("top") * F.greatest(F.lit(1.0), F.lit(self.mean) / F.col("mean"))
        counted = own.join(F.broadcast(least), "term").agg(F.count("*").alias("of_terms"), F.count_if(grown >= F.col("need")).alias("read"))
        return counted.select("of_terms", "read", self.blocks.agg(F.count("*")).scalar().alias("all"))


class SegmentIndex:
    """The written index below one root: segments named by one small version file."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)
        self.versions = Versions(spark, self.root)

    def state(self) -> dict:
        return self.versions.read({"silver_version": 0, "floor": None, "segments": []})

    def silver_version(self) -> int:
        return self.state()["silver_version"]

    def _write_segment(self, added: DataFrame, removed: DataFrame, before: list[dict]) -> dict | None:
        """Write the change from (doc, text) rows that came and went; `before`: the segments in force."""
        with scratch(self.spark):
            return self._written_segment(added, removed, before)

    def _written_segment(self, added: DataFrame, removed: DataFrame, before: list[dict]) -> dict | None:
        name = f"segment-{uuid.uuid4().hex}"
        folder = f"{self.root}/{name}"
        both = added.select(F.lit(1).alias("sign"), "doc", "text").unionByName(removed.select(F.lit(-1).alias("sign"), "doc", "text"))
        docs = written(_signed_lengths(both))
        totals = docs.agg(F.coalesce(F.sum("sign"), F.lit(0)), F.coalesce(F.sum(F.col("sign") * F.col("dl")), F.lit(0)), F.count("*")).first()
        if not totals[2]:
            return None
        n_docs, total_len = sum(s["n_docs"] for s in before) + totals[0], sum(s["total_len"] for s in before) + totals[1]
        mean = F.lit(total_len / n_docs if n_docs and total_len else 1.0)
        came, went = bm25.postings_of(added), bm25.postings_of(removed)
        write_parquet(blocks_of(came, mean), f"{folder}/blocks")
        # Postings that came are counted by their blocks; they are no table of their own.
        counts = self.spark.read.schema(_BLOCKS).parquet(f"{folder}/blocks").select("term", F.col("size").cast("long").alias("df"))
        minus = written(went.groupBy("term").agg(F.count("*").alias("df")))
        rows = counts.unionByName(minus).agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]
        counts = counts.unionByName(minus.withColumn("df", -F.col("df"))).groupBy("term").agg(F.sum("df").alias("df"))
        write_parquet(_by_term(counts), f"{folder}/terms")
        write_parquet(removed.select(F.col("doc").cast("long").alias("doc")), f"{folder}/removed")
        return {"name": name, "n_docs": totals[0], "total_len": totals[1], "rows": rows}

    def apply(self, added: DataFrame, removed: DataFrame, silver_version: int) -> None:
        """Take a change of the corpus in: (doc, text) rows that came and went. Nothing else is read but term counts."""
        state = self.state()
        segment = self._write_segment(added, removed, state["segments"])
        self._commit([*state["segments"], *([segment] if segment else [])], silver_version)
        self._merge_like_sizes()

    def build(self, docs: DataFrame, silver_version: int) -> None:
        """The index of (doc, text) rows, anew."""
        segment = self._write_segment(docs, docs.where("false"), [])
        self._commit([segment] if segment else [], silver_version)

    def _commit(self, segments: list[dict], silver_version: int) -> None:
        reader = self._reader(segments, None, self.spark.createDataFrame([], "doc long, text string"))
        counts = reader.terms.groupBy("term").agg(F.sum("df").alias("df")).where("df > 0")
        floor = counts.agg(bm25.EPSILON * F.avg(bm25.raw_idf(F.lit(reader.n_docs), F.col("df")))).first()[0]
        self.versions.write({"silver_version": silver_version, "floor": floor, "segments": segments})

    def _merge_like_sizes(self) -> None:
        """Merge FANOUT segments of one size class into one, until no class is full.

        Removed documents' postings go with the merge, and so do their numbers once the oldest
        segment takes part; before, documents of earlier segments may still need them.
        """
        with scratch(self.spark):
            self._merge_full_classes()

    def _merge_full_classes(self) -> None:
        while True:
            state = self.state()
            classes: dict[int, list[int]] = {}
            for i, s in enumerate(state["segments"]):
                classes.setdefault(int(np.log(max(1, s["rows"])) / np.log(FANOUT)), []).append(i)
            full = next((c for _, c in sorted(classes.items()) if len(c) >= FANOUT), None)
            if full is None:
                return
            chosen = [state["segments"][i] for i in full]
            rest = [s for i, s in enumerate(state["segments"]) if i not in full]
            everything = self._reader(state["segments"], state["floor"], self.spark.createDataFrame([], "doc long, text string"))
            own = self._reader(chosen, state["floor"], everything.docs)
            name = f"segment-{uuid.uuid4().hex}"
            folder = f"{self.root}/{name}"
            live = written(postings_in(own.blocks).join(everything.removed, "doc", "left_anti"))
            mean = everything.mean or 1.0
            write_parquet(blocks_of(live, F.lit(mean)), f"{folder}/blocks")
            write_parquet(_by_term(own.terms.groupBy("term").agg(F.sum("df").cast("long").alias("df"))), f"{folder}/terms")
            # Numbers of removed documents are needed while any segment outside the merge holds them.
            others = self._reader(rest, state["floor"], everything.docs)
            held = others.blocks.select(F.explode("docs").alias("doc")).join(own.removed, "doc", "left_semi").distinct() if rest else own.removed.where("false")
            write_parquet(held, f"{folder}/removed")
            merged = {"name": name, "n_docs": sum(s["n_docs"] for s in chosen), "total_len": sum(s["total_len"] for s in chosen), "rows": live.count()}
            self.versions.write({**state, "segments": [*rest, merged]})

    def _reader(self, segments: list[dict], floor: float | None, docs: DataFrame) -> Reader:
        folders = [f"{self.root}/{s['name']}" for s in segments]
        return Reader(self.spark, folders, sum(s["n_docs"] for s in segments), sum(s["total_len"] for s in segments), floor, docs)

    def open(self, docs: DataFrame) -> Reader:
        """The segments in force. `docs` (doc, text) is the corpus they stand for."""
        state = self.state()
        return self._reader(state["segments"], state["floor"], docs)

    def expire(self) -> int:
        """Delete segments and versions no longer in force. Only for times without readers."""
        live = {s["name"] for s in self.state()["segments"]}
        old = [n for n in self.files.list(self.root) if n.startswith("segment-") and n not in live]
        for n in old:
            self.files.delete(f"{self.root}/{n}")
        self.versions.expire()
        return len(old)


def _by_term(counts: DataFrame) -> DataFrame:
    return counts.where("df <> 0").repartitionByRange(F.substring("term", 1, 64)).sortWithinPartitions("term")


def _signed_lengths(both: DataFrame) -> DataFrame:
    """(sign, doc, dl) of (sign, doc, text) rows: a document may come and go in one change."""
    parts = [bm25.doc_lengths(both.where(F.col("sign") == s)).withColumn("sign", F.lit(s)) for s in (1, -1)]
    return parts[0].unionByName(parts[1])
