"""The two composite jobs: refresh (Silver, then vectors) and on-demand ingestion."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesearch.functions.embed import EMBEDDING_DIM, Embedder, hashed_embedder
from lakesearch.functions.text import iso_utc, partition_date, partition_hour
from lakesearch.operators import bm25, fusion
from lakesearch.operators.postings import SegmentIndex
from lakesearch.operators.silver import BUCKET_BITS, BUCKETS, bucket_of, build_silver, dedup_text, long_enough, text_changes, with_doc_order, with_snippets
from lakesearch.operators.validate import validate_light
from lakesearch.operators.vectors import VectorStore, payload_of
from lakesearch.schemas import SILVER, SILVER_COLUMNS
from lakesearch.session import discard, scratch, written
from lakesearch.sources.bronze import append_bronze, bronze_files, read_bronze, read_files
from lakesearch.sources.buckets import BucketTable
from lakesearch.sources.tables import Table


#: Bronze files that are in Silver.
SOURCE = T.StructType([T.StructField("path", T.StringType()), T.StructField("changed", T.TimestampType())])
#: What happened with each version of Silver: rows that went (sign -1), and a row (sign 1) with the lowest number
#: of those that came. Numbers only rise, so the rows themselves are those of Silver from that number on.
CHANGES = T.StructType([T.StructField("silver_version", T.LongType()), T.StructField("sign", T.IntegerType()), *SILVER])


class IngestCounts(NamedTuple):
    valid: int
    dlq: int


class Lake:
    """All tables below one root.

    What a change replaces stays for readers that started before, until `expire`. With `keep_replaced`
    off nobody else reads: it goes with the change.
    """

    def __init__(self, spark: SparkSession, root: str, dim: int = EMBEDDING_DIM, embedder: Embedder | None = None, keep_replaced: bool = True):
        self.spark, self.root, self.keep_replaced = spark, root.rstrip("/"), keep_replaced
        self.embedder = embedder
        self.bronze_root = f"{self.root}/bronze"
        self.silver = BucketTable(spark, f"{self.root}/silver", SILVER, "doc_part", BUCKETS)
        self.source = Table(spark, f"{self.root}/silver_source", SOURCE)
        self.changes = Table(spark, f"{self.root}/silver_changes", CHANGES)
        self.store = VectorStore(spark, f"{self.root}/vector", dim)
        self.index = SegmentIndex(spark, f"{self.root}/keyword")

    def write_silver(self, silver: DataFrame, built: bool = False) -> None:
        """All of Silver anew; `built`: from Bronze alone. Whoever follows the changes starts anew as well."""
        with scratch(self.spark):
            numbered = with_doc_order(silver.select(*SILVER_COLUMNS))
            self.changes.clear()
            self.silver.replace(numbered, whole=self.silver.version() + 1, built=built, next=numbered.count())
        self._drop_replaced(self.silver, self.changes)

    def _drop_replaced(self, *tables: BucketTable | Table | SegmentIndex) -> None:
        if not self.keep_replaced:
            for table in tables:
                table.expire()

    def expire(self) -> None:
        """Delete what is no longer in force. Only for times without readers."""
        for table in (self.silver, self.source, self.changes, self.store.vectors, self.store.ledger, self.store.synced, self.index):
            table.expire()

    def _change_silver(self, came: DataFrame, gone: DataFrame, made_of: tuple[DataFrame, ...] = (), **noted) -> bool:
        """Let rows come and numbered rows go. Only the buckets of their texts are written anew.

        The change is noted first, under the version it makes: if that version never comes about, the
        note is overwritten by the next change of the same number. `made_of`: scratch tables that
        only `came` is made of, which go once its rows are numbered.
        """
        version, first = self.silver.version() + 1, self.silver.state().get("next", 0)
        came = with_doc_order(came.select(*SILVER_COLUMNS), first).select(*SILVER.fieldNames())
        for table in made_of:
            discard(table)
        touched = [r["doc_part"] for r in came.select("doc_part").union(gone.select("doc_part")).distinct().collect()]
        if not touched:
            return False
        gone = gone.select(*SILVER.fieldNames())
        sign = lambda df, n: df.select(F.lit(version).cast("bigint").alias("silver_version"), F.lit(n).alias("sign"), *SILVER.fieldNames())
        noted_before = self.changes.read().where(F.col("silver_version") < version)
        lowest = [F.lit(first << BUCKET_BITS if f.name == "doc_order" else None).cast(f.dataType).alias(f.name) for f in SILVER]
        both = sign(self.spark.range(1).select(*lowest), 1).unionByName(sign(gone, -1))
        if self.changes.read().where(F.col("silver_version") >= version).isEmpty():
            self.changes.append(both)
        else:
            self.changes.replace(noted_before.unionByName(both))
        # Of the numbers that went a pass of the write has those of its buckets.
        went = self.changes.read().where((F.col("silver_version") == version) & (F.col("sign") == -1)).select("doc_part", "doc_order")
        stays = self.silver.read(touched).join(F.broadcast(went), ["doc_part", "doc_order"], "left_anti")
        self.silver.write(stays.select(*SILVER.fieldNames()).unionByName(came), touched, next=first + came.count(), **noted)
        self._drop_replaced(self.silver)
        return True

    def build_silver(self) -> bool:
        """Bring Silver up to Bronze; returns whether anything changed.

        Files that are known are not read again. Rows of new files meet the rows of the buckets they
        fall into, and only buckets in which a text came or was taken over are written. The list of
        files is noted last: a crash in between repeats a step that then changes nothing. Silver
        that somebody else has written since is built anew from all of Bronze.
        """
        with scratch(self.spark):
            return self._build_silver()

    def _build_silver(self) -> bool:
        bronze = read_bronze(self.spark, self.bronze_root)
        if bronze.isEmpty():
            return False
        files = bronze_files(bronze)
        if not self.silver.state().get("built"):
            files = written(files)
            self.write_silver(build_silver(bronze), built=True)
            self.source.replace(files)
            return True
        new = written(files.join(self.source.read().select("path", "changed"), ["path", "changed"], "left_anti"))
        # The files of one change: their names are what the reader is given.
        paths = [r["path"] for r in new.select("path").collect()]
        if not paths:
            return False
        rows = written(long_enough(dedup_text(with_snippets(read_files(self.spark, self.bronze_root, paths)))).select(*SILVER_COLUMNS))
        met = [r["b"] for r in rows.select(bucket_of("text").alias("b")).distinct().collect()]
        came, gone = text_changes(self.silver.read(met), rows)
        changed = self._change_silver(came, gone, (rows,))
        self.source.append(new)
        self.source.compact()
        return changed

    def refresh(self, vectors: bool = True, index: bool = True) -> int:
        """Silver, then sync, then the keyword index. Safe to run again; returns new vectors.

        An idle run (Bronze unchanged) writes no version of Silver and leaves the index. What is not to
        follow now finds the changes noted when it does.
        """
        self.build_silver()
        if not self.silver.exists():
            return 0
        if index:  # its scratch tables are the largest, so the vectors come after it
            self._follow_with_index()
        added = self._follow_with_vectors() if vectors else 0
        if self.changes.parts() and self.store.synced_version() == self.index.silver_version() == self.silver.version():
            self.changes.clear()  # everybody has seen them
        if not self.keep_replaced:
            self.expire()
        return added

    def _since(self, version: int) -> tuple[DataFrame, DataFrame, DataFrame] | None:
        """After a version of Silver: rows that came and stay, that went, and that came and went since. None if not all is noted."""
        state, now = self.silver.state(), self.silver.version()
        if version < state.get("whole", 0):
            return None
        noted = self.changes.read().where(F.col("silver_version").between(version + 1, now))
        first = noted.where("sign = 1").agg(F.min("doc_order")).first()[0]
        new = F.lit(False) if first is None else F.col("doc_order") >= first
        went = noted.where("sign = -1").select(*SILVER.fieldNames())
        return self.silver.read().where(new), went.where(~new), went.where(new)

    def _follow_with_vectors(self) -> int:
        """Embed what came to Silver since the last time; returns new vectors."""
        now, known = self.silver.version(), self.store.synced_version()
        if now == known:
            return 0
        since = self._since(known)
        came = self.silver.read() if since is None else since[0].unionByName(since[2])
        added = self.store.sync(came, self.embedder)
        self.store.note_synced(now)
        return added

    def _follow_with_index(self) -> None:
        """Bring the keyword index up to Silver: a segment for what changed."""
        now, known = self.silver.version(), self.index.silver_version()
        if now == known:
            return
        since = self._since(known)
        if since is None:
            self.index.build(bm25.corpus(self.silver.read()), now)
            return
        # A document that came and went in between is in neither list.
        self.index.apply(bm25.corpus(since[0]), bm25.corpus(since[1]), now)

    def ingest_batch(self, items: DataFrame, batch: str, now: Column | int | None = None) -> IngestCounts:
        """On-demand run: light validation, Bronze, Silver merged by id, vectors by item.

        Here a point's id is the item's id and its vector that of the title.
        """
        now = F.unix_timestamp() if now is None else now
        judged = validate_light(items, now)
        counts = judged.agg(
            F.count_if(F.col("reason").isNull()).alias("valid"), F.count_if(F.col("reason").isNotNull()).alias("dlq")
        ).first()
        if counts["valid"]:
            arrival = F.current_timestamp()
            valid = judged.where(F.col("reason").isNull()).drop("reason")
            valid = valid.withColumn("_ingested_at", iso_utc(arrival))
            valid = valid.withColumn("date", partition_date(arrival)).withColumn("hour", partition_hour(arrival))
            append_bronze(valid, self.bronze_root, batch)
            # From here on read what was written, so that the arrival time stays one value.
            landed = read_bronze(self.spark, self.bronze_root).where(F.col("batch") == batch)
            landed = landed.select(*SILVER_COLUMNS)
            # An id that is there stays as it is; of new ones the first row counts.
            first = Window.partitionBy("id").orderBy("_ingested_at")
            new = landed.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")
            known = self.silver.read().select("id")
            with scratch(self.spark):
                came = written(new.join(known, "id", "left_anti"))
                self._change_silver(came, self.silver.read([]), (came,), built=False)
            self.store.sync(landed, self.embedder, embed_col="title", id_mode="item")
        return IngestCounts(counts["valid"], counts["dlq"])

    def search(self, queries: DataFrame, **options) -> DataFrame:
        """Hybrid search with verdicts; the keyword index follows Silver by itself."""
        silver, points = self.silver.read(), self.store.points()
        if self.silver.exists():
            self._follow_with_index()
        ref = F.col("point_id").alias("ref")
        return fusion.hybrid_search(
            queries,
            # The first 60 bits of the id settle equal similarities; the id itself goes along as `ref`.
            points.select(F.conv(F.substring(F.translate("point_id", "-", ""), 1, 15), 16, 10).cast("bigint").alias("doc"), "vector", ref),
            self.index.open(bm25.corpus(silver)),
            silver.select(F.col("doc_order").alias("doc"), "doc_part", "text", payload_of(silver).alias("payload")),
            embedder=self.embedder or hashed_embedder(self.store.dim),
            vector_payloads=points.select(ref, F.col("payload.text").alias("text"), "payload"),
            **options,
        )
