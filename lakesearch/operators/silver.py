"""Silver: one cleaned, de-duplicated snippet per story."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesearch.functions.once import once
from lakesearch.functions.text import MIN_SNIPPET_LENGTH, clean_html, domain_of, snippet_from
from lakesearch.schemas import SILVER, SILVER_COLUMNS
from lakesearch.session import written

# Order of arrival; the id settles equal times.
ARRIVAL = ("_ingested_at", "id")


def with_snippets(bronze: DataFrame) -> DataFrame:
    """Replace `text` by the snippet; missing wanted columns are added as nulls."""
    for field in SILVER:
        if field.name not in bronze.columns:
            bronze = bronze.withColumn(field.name, F.lit(None).cast(field.dataType))
    # The cleaned text is used twice, so it gets a column of its own.
    df = once(bronze, __cleaned=clean_html("text"))
    snippet = snippet_from(F.col("title"), F.col("__cleaned"), domain_of("url"))
    return df.withColumn("text", snippet).select(*SILVER_COLUMNS)


def dedup_text(df: DataFrame, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """Keep the last row per text.

    The rank filter lets Spark cut each map task down to one row per text before
    the shuffle (WindowGroupLimit), so a text that makes up a third of the table
    sends one row per task. The 8-byte hash in front keeps the sort from comparing
    long texts; the text itself decides.
    """
    latest = Window.partitionBy(F.xxhash64("text"), "text").orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("__rn", F.row_number().over(latest)).where("__rn = 1").drop("__rn")


def long_enough(df: DataFrame) -> DataFrame:
    return df.where(F.length("text") >= MIN_SNIPPET_LENGTH)


def build_silver(bronze: DataFrame) -> DataFrame:
    return long_enough(dedup_text(with_snippets(bronze))).select(*SILVER_COLUMNS)


def dedup_report(bronze: DataFrame) -> DataFrame:
    """Rows before, rows after and rows removed; only a hash of each snippet is shuffled."""
    texts = with_snippets(bronze).select(F.sha2("text", 256).alias("hash"), (F.length("text") >= MIN_SNIPPET_LENGTH).alias("long"))
    per_text = texts.groupBy("hash", "long").agg(F.count(F.lit(1)).alias("n"))
    kept = F.count_if("long")
    before = F.coalesce(F.sum("n"), F.lit(0))
    return per_text.agg(
        before.alias("rows_before"),
        kept.alias("rows_after"),
        (before - kept).alias("rows_removed"),
    )


def merge_by_id(existing: DataFrame, new: DataFrame, order_col: str = "_ingested_at", existing_is_unique: bool = False) -> DataFrame:
    """Union in which each id is kept once: existing rows win, then the first new row.

    When the existing side is known to hold each id once, it is only probed by id
    and its rows are not shuffled.
    """
    first = Window.partitionBy("id")
    if existing_is_unique:
        new = new.withColumn("__rn", F.row_number().over(first.orderBy(order_col))).where("__rn = 1").drop("__rn")
        return existing.unionByName(new.join(existing.select("id"), "id", "left_anti"), allowMissingColumns=True)
    both = existing.withColumn("__side", F.lit(0)).unionByName(new.withColumn("__side", F.lit(1)), allowMissingColumns=True)
    ranked = both.withColumn("__rn", F.row_number().over(first.orderBy("__side", order_col)))
    return ranked.where("__rn = 1").drop("__rn", "__side")


#: Silver's hash buckets: the lower bits of a document's number.
BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS


def bucket_of(text: Column | str) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(BUCKETS))


def with_doc_order(silver: DataFrame, first: int = 0) -> DataFrame:
    """Add `doc_order`, a unique BIGINT that rises with arrival, and its bucket `doc_part`.

    The upper bits count the rows by arrival from `first`, without gaps: range partitioning puts
    arrivals in partition order, and the partitions' counts, one row each, are summed in front. The
    lower bits are the bucket of the text, so that a document's number names the bucket it lies in.
    The rows are a written table, since the numbers are only stable once written.
    """
    # Range bounds are sampled to the driver, so a hash stands in for the text itself.
    order = [*[F.col(c).asc_nulls_first() for c in ARRIVAL], F.xxhash64("text").asc()]
    ordered = silver.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = written(ordered.withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    seq = F.lit(first) + F.col("__start") + F.col("__row")
    numbered = ordered.join(F.broadcast(starts), "__part").withColumn("doc_part", bucket_of("text"))
    numbered = numbered.withColumn("doc_order", F.shiftleft(seq.cast("bigint"), BUCKET_BITS).bitwiseOR(F.col("doc_part")))
    return numbered.drop("__part", "__row", "__start")


def doc_part(doc: str) -> Column:
    """Bucket of a `doc_order` (its lower bits)."""
    return F.col(doc).bitwiseAND(F.lit(BUCKETS - 1).cast("bigint"))


def arrival() -> Column:
    """Place in the order of arrival, as a value that can be compared; what is missing comes first."""
    return F.struct(*[F.coalesce(F.col(c), F.lit(low)).alias(c) for c, low in zip(ARRIVAL, ("", -(1 << 63)))])


#: Up to so many texts that are there already go to all tasks.
MET_BROADCAST = 1 << 18


def text_changes(current: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that come, numbered rows that go) when `new`, one row a text, meets numbered `current` rows.

    A text that is there already is taken over by a later arrival only.
    """
    digest = F.unhex(F.sha2("text", 256)).alias("__digest")
    known = current.select(digest, "doc_order", arrival().alias("__known"))
    # Texts on both sides, as digests: no text is shuffled to find them.
    met = new.select(digest, arrival().alias("__new")).join(known, "__digest")
    met = written(met.select("__digest", "doc_order", (F.col("__new") > F.col("__known")).alias("later")))
    beside = F.broadcast if met.count() <= MET_BROADCAST else lambda keys: keys
    came = new.withColumn("__digest", digest).join(beside(met.where(~F.col("later")).select("__digest")), "__digest", "left_anti")
    return came.select(*new.columns), current.join(beside(met.where("later").select("doc_order")), "doc_order", "left_semi")
