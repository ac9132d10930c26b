"""Incremental sync of Silver into the vector table.

A ledger of content hashes says what is embedded already. New rows are found by an
anti join, embedded, and merged into the vector table under ids made from content,
so that a repeated run can never add a second copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesearch.functions.embed import Embedder, hashed_embedder
from lakesearch.functions.hashing import content_hash, point_id
from lakesearch.schemas import LEDGER, PAYLOAD, VECTORS
from lakesearch.session import scratch, written
from lakesearch.sources.tables import MergedTable, Table

# Fixed value: what the ledger's hash was taken of.
OF_SNIPPET, OF_TITLE = "text", "title"


def with_hash(silver: DataFrame, hash_of: str = OF_SNIPPET) -> DataFrame:
    return silver.withColumn("content_hash", content_hash(hash_of))


def sync_new_rows(silver: DataFrame, ledger: DataFrame, hash_of: str = OF_SNIPPET) -> DataFrame:
    """Silver rows whose hash the ledger does not hold.

    Left unhinted: AQE broadcasts a ledger that proves small and shuffles otherwise.
    """
    return with_hash(silver, hash_of).join(ledger.select("content_hash"), "content_hash", "left_anti")


def payload_columns(df: DataFrame) -> dict[str, Column]:
    """The seven payload fields; what the rows do not have is null."""
    have = set(df.columns)
    return {f.name: (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType) for f in PAYLOAD}


def payload_of(df: DataFrame) -> Column:
    return F.struct(*[c.alias(name) for name, c in payload_columns(df).items()])


def vector_points(
    new_rows: DataFrame,
    embedder: Embedder | None = None,
    embed_col: str = "text",
    id_mode: str = "content",
) -> DataFrame:
    """Points (id, hash, vector, payload) for rows that carry `content_hash`.

    `id_mode` "content" derives the id from the hash; "item" takes the item's own id.
    """
    embedder = embedder or hashed_embedder()
    if id_mode not in ("content", "item"):
        raise ValueError(f"unknown id_mode {id_mode!r}")
    pid = point_id("content_hash") if id_mode == "content" else F.col("id").cast("string")
    # The payload stays flat until the vector is there: structs are built last.
    flat = [f"__p_{name}" for name in PAYLOAD.fieldNames()]
    kept = new_rows.select(
        pid.alias("point_id"),
        "content_hash",
        F.col(embed_col).alias("__embed"),
        *[c.alias(f"__p_{name}") for name, c in payload_columns(new_rows).items()],
    )
    payload = F.struct(*[F.col(c).alias(c.removeprefix("__p_")) for c in flat])
    return embedder(kept, "__embed", "vector").select("point_id", "content_hash", "vector", payload.alias("payload"))


def last_per_point(points: DataFrame) -> DataFrame:
    """One row per point id: the latest payload by time, id and title."""
    order = {"__t": "payload.time", "__i": "payload.id", "__n": "payload.title"}
    df = points.withColumns({name: F.col(path) for name, path in order.items()})
    w = Window.partitionBy("point_id").orderBy(*[F.col(name).desc_nulls_last() for name in order])
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", *order)


def latest_per_hash(rows: DataFrame) -> DataFrame:
    """One row per content hash, that which `last_per_point` would keep; taken before embedding."""
    fields = payload_columns(rows)
    w = Window.partitionBy("content_hash").orderBy(*[fields[c].desc_nulls_last() for c in ("time", "id", "title")])
    return rows.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def upsert(existing: DataFrame, new: DataFrame, new_is_unique: bool = False) -> DataFrame:
    """Keyed merge as a query: new points replace old ones of the same id."""
    new = new if new_is_unique else last_per_point(new)
    return existing.join(new.select("point_id"), "point_id", "left_anti").select(*existing.columns).unionByName(new)


def ledger_union(ledger: DataFrame, new: DataFrame) -> DataFrame:
    return ledger.select("content_hash").union(new.select("content_hash")).distinct()


def sync_gap(silver: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows really missing from the vector table, unlike the difference of two counts."""
    return sync_new_rows(silver, ledger).agg(F.count(F.lit(1)).alias("missing"))


def check_dim(vectors: DataFrame, dim: int) -> DataFrame:
    """Raise in the job if a vector has another length."""
    ok = F.coalesce(F.size("vector") == dim, F.lit(False))
    message = F.concat(F.lit(f"vector of length other than {dim}: point "), "point_id")
    return vectors.withColumn("vector", F.when(ok, F.col("vector")).otherwise(F.raise_error(message)))


#: Version of Silver that the vectors were last brought up to.
SYNCED = T.StructType([T.StructField("silver_version", T.LongType())])


class VectorStore:
    """The vector table and its ledger below one root."""

    def __init__(self, spark: SparkSession, root: str, dim: int = 384):
        self.spark, self.dim = spark, dim
        self.vectors = MergedTable(spark, f"{root}/vectors", VECTORS, "point_id")
        self.ledger = Table(spark, f"{root}/ledger", LEDGER)
        self.synced = Table(spark, f"{root}/synced", SYNCED)

    def points(self) -> DataFrame:
        return self.vectors.read()

    def synced_version(self) -> int:
        row = self.synced.read().first()
        return row[0] if row else 0

    def note_synced(self, silver_version: int) -> None:
        self.synced.replace(self.spark.range(1).select(F.lit(silver_version).cast("bigint").alias("silver_version")))

    def ensure(self) -> None:
        """Create the empty collection if there is none."""
        if not self.vectors.exists():
            self.vectors.clear()

    def reset(self) -> None:
        """Forget vectors and ledger, so that everything is embedded anew."""
        self.vectors.clear()
        self.ledger.clear()
        self.synced.clear()

    def upsert(self, points: DataFrame) -> None:
        """Merge points into the table.

        One part is added. Ids that are there already (a run repeated after a crash, an item
        changed) are noted as replaced and looked over when the table is read, so no vector is
        rewritten for them; to find them nothing but the id column is read.
        """
        with scratch(self.spark):
            self._merge(self.vectors.stage(last_per_point(check_dim(points, self.dim))))

    def _merge(self, part: str) -> None:
        """Put a staged part, one row a point, in force: embedded and written once, it is its own scratch table."""
        points = self.vectors.staged(part).select("point_id")
        clash = written(self.points().select("point_id").join(points, "point_id", "left_semi"))
        self.vectors.merge_staged(part, None if clash.isEmpty() else clash)
        self.vectors.compact()

    def sync(
        self,
        silver: DataFrame,
        embedder: Embedder | None = None,
        embed_col: str = "text",
        id_mode: str = "content",
    ) -> int:
        """Embed and merge what is new; returns the number of new rows.

        Vectors are written before the ledger: a crash in between only repeats work
        that changes nothing.
        """
        self.ensure()
        hash_of = OF_TITLE if embed_col == "title" else OF_SNIPPET
        new_rows = sync_new_rows(silver, self.ledger.read(), hash_of)
        points = lambda rows: check_dim(vector_points(rows, embedder or hashed_embedder(self.dim), embed_col, id_mode), self.dim)
        with scratch(self.spark):
            if id_mode == "item":  # points are named by item, so equal texts must be met here: the first item stays
                first = Window.partitionBy("content_hash").orderBy(F.col("time").asc_nulls_last(), "id")
                new_rows = new_rows.withColumn("__rn", F.row_number().over(first)).where("__rn = 1").drop("__rn")
                found = new_rows = written(new_rows)  # an item may have several titles: all are synced, the last is its point
                part = self.vectors.stage(last_per_point(points(new_rows)))
            else:  # a text is a point
                part = self.vectors.stage(points(latest_per_hash(new_rows)))
                found = self.vectors.staged(part)
            hashes = found.select("content_hash").distinct().withColumn("hash_of", F.lit(hash_of))
            added = hashes.count()
            if added:
                self._merge(part)
                self.ledger.append(hashes)
                self.ledger.compact()
            else:
                self.vectors.drop_staged(part)
        return added

    def prune(self, silver: DataFrame) -> None:
        """Drop vectors and ledger entries whose text is no longer in Silver.

        Vectors of snippets and of titles lie in one table, so a row is live if either hash
        of some Silver row is its own.
        """
        live = with_hash(silver, OF_SNIPPET).select("content_hash").union(with_hash(silver, OF_TITLE).select("content_hash")).distinct()
        self.vectors.replace(self.vectors.read().join(live, "content_hash", "left_semi"))
        self.ledger.replace(self.ledger.read().join(live, "content_hash", "left_semi"))
