"""The registered queries of this subpackage: thin uses of its operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesearch.llm import bpe, collisions, dartminhash, langid, licenses, poisson, repair, separators, shards, simhash, templates, toxicity, wordmatrix
from lakesearch.llm.common import table
from lakesearch.session import scratch_dir

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Free in that vocabulary.
END_OF_DOCUMENT = 50256
N_SHARDS = 8
MIX_SEED = 20240


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document of the flat token files that all documents encode to."""
    folder = f"{scratch_dir(spark)}/tokens-{uuid.uuid4().hex}"
    separators.write_token_files(table(spark, sf_dir, "documents"), folder, RANKS, PATTERN, END_OF_DOCUMENT)
    return separators.count_tokens(spark, folder, END_OF_DOCUMENT).withColumn("file", F.element_at(F.split("file", "/"), -1))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every page from its text, markup, address and host; models from `documents`."""
    model = langid.fit(table(spark, sf_dir, "documents"))
    pages = table(spark, sf_dir, "pages")
    html, url = F.col("html"), F.col("url")
    return langid.identify(pages, ["page_id", "url"], langid.visible_text(html), langid.declared_in(html), langid.host_of(url), model)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the bytes they decode to."""
    docs = table(spark, sf_dir, "documents")
    return bpe.digests(bpe.encode(docs, "doc_id", RANKS, PATTERN, decoded=True))


def op4_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight contiguous shards of near equal bytes."""
    placed = shards.byte_shards(shards.sized(table(spark, sf_dir, "documents")), N_SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return dartminhash.near_classes(table(spark, sf_dir, "documents"))


def op6_template_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page, by the template of its host."""
    pages = table(spark, sf_dir, "pages")
    return templates.extract(pages, "page_id, url", langid.host_of(F.col("url"))).withColumn("n_chars", F.length("text").cast("long"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of held-out rows are not used."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text."""
    return simhash.edit_study(table(spark, sf_dir, "documents"))


def op9_collision_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    rows = table(spark, sf_dir, "embeddings")
    return collisions.nearest(rows, rows.where(F.col("vec_id") % 20 == 0), 20)


def op10_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many documents as there are, every source weighing the same."""
    docs = table(spark, sf_dir, "documents")
    return poisson.replicate(docs, "source", poisson.rates(docs, "source"), MIX_SEED)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each filter removes at each step of each order, in each language."""
    failed = wordmatrix.failures(table(spark, sf_dir, "documents"))
    return wordmatrix.audit(wordmatrix.histogram(failed, table(spark, sf_dir, "labels")))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and the licenses that every document names."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired rows of every damaged conversation."""
    return repair.repaired(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_separator_scan": op1_separator_scan,
    "op2_language_id": op2_language_id,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_byte_shards": op4_byte_shards,
    "op5_dart_minhash": op5_dart_minhash,
    "op6_template_text": op6_template_text,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_collision_knn": op9_collision_knn,
    "op10_poisson_mix": op10_poisson_mix,
    "op11_filter_audit": op11_filter_audit,
    "op12_license_scan": op12_license_scan,
    "op13_conversation_repair": op13_conversation_repair,
}
