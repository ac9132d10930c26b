"""A training corpus from `documents`, in five stages, each written as Parquet and reread.

1. toxicity: documents that the classifier marks go;
2. language ID: documents without letters, and those no language fits, go, but none of a declared
   language that has no model; where the language found is another than the declared one, it takes
   its place in `lang`;
3. near-dedup: of each class of near-duplicates the document with the smallest id stays;
4. mixing: documents are repeated so that all sources weigh the same;
5. BPE: every document is encoded, and decoded again.

A stage takes whatever its predecessor kept, with the columns of `documents`, and decides
for each row by its id and text. Rows with null text pass as empty texts (and go at stage
2); a null id comes after all others at stage 3, where one of the rows alike in id and text stays; an empty table passes all stages; further columns are dropped at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesearch.llm import bpe, dartminhash, langid, poisson, toxicity
from lakesearch.llm.common import BROADCAST_ROWS, table, without
from lakesearch.llm.queries import MIX_SEED, PATTERN, RANKS
from lakesearch.llm.simhash import NO_ID
from lakesearch.session import written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score_of(spark, net)(F.coalesce("text", F.lit(""))) < toxicity.THRESHOLD)


def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    code = langid.language_code(F.col("lang"))
    # The declared code is hashed as well: rows alike in id and text may declare different languages.
    keyed = docs.withColumns({"row_id": F.coalesce("doc_id", F.lit(NO_ID)), "row_hash": F.xxhash64(text, code), "code": code})
    model = langid.fit(docs)
    found = langid.identify(keyed, ["row_id", "row_hash", "code"], text, F.col("lang"), F.col("source"), model)
    modelled = F.col("code").isin("", *model.classes)
    rejected = found.where((F.col("n_grams") == 0) | (F.col("lang") == langid.UND) & modelled).select("row_id", "row_hash").distinct()
    kept = without(keyed, rejected, ["row_id", "row_hash"])
    keys = ["row_id", "row_hash", "code"]
    other = found.where((F.col("lang") != langid.UND) & (F.col("lang") != F.col("code"))).groupBy(*keys).agg(F.min("lang").alias("found_lang"))
    other = written(other)
    few = other.count() <= BROADCAST_ROWS  # three short columns a row
    kept = kept.join(F.broadcast(other) if few else other, keys, "left")
    return kept.withColumn("lang", F.coalesce("found_lang", "lang")).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = docs.withColumns({"row_id": F.coalesce("doc_id", F.lit(NO_ID)), "row_hash": F.xxhash64(F.coalesce("text", F.lit("")))})
    # Classes are those of texts, so that rows that share an id, or have none, are told apart.
    found = dartminhash.near_classes(keyed, "row_hash").distinct()
    rows = written(keyed.groupBy("row_id", "row_hash").agg(F.count("*").alias("n")))
    first = F.struct(F.col("row_id") == NO_ID, "row_id", "row_hash")
    firsts = rows.groupBy("row_hash").agg(F.min(first).alias("first"))
    kept = written(firsts.join(found, "row_hash").groupBy("class_id").agg(F.min("first").alias("first")).select("first.row_id", "first.row_hash"))
    once = without(keyed, rows.select("row_id", "row_hash").join(kept, ["row_id", "row_hash"], "left_anti"), ["row_id", "row_hash"])
    if not rows.where("n > 1").isEmpty():
        once = once.dropDuplicates(["row_id", "row_hash"])
    return once.select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return poisson.replicate(docs, "source", poisson.rates(docs, "source"), MIX_SEED).drop("copy", "n_copies")


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode(docs, "doc_id", RANKS, PATTERN, decoded=True), keep_ids=True)


STAGES = [
    ("toxicity", toxicity_filter),
    ("language_id", language_filter),
    ("near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("bpe", bpe_tokens),
]

#: A trained classifier, MinHash components and BPE have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
