"""Token counts from flat token files: a scan for end-of-document ids, block by block.

A flat token file holds nothing but ids, two bytes each, big-endian, every document
followed by the separator id; there is no index. The scan cuts files into blocks of fixed
size, finds all separators of a block at once in numpy, and stitches documents that
run over block borders with a prefix scan: each block needs only the position of the last
separator before it. Documents never run over file borders.

Defined results: an empty document is two separators in a row and counts 0 tokens;
null text counts as empty; ids after a file's last separator are one more document;
an empty folder or an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakesearch.llm import bpe
from lakesearch.session import written

TOKEN_BYTES = 2
#: Bytes of one block: what a task holds at a time.
BLOCK_BYTES = 4 << 20
#: Bytes that one task scans.
TASK_BYTES = 16 << 20


def write_token_files(docs: DataFrame, folder: str, ranks_path: str, pattern: str, separator: int) -> None:
    """Encode every text and append it to the flat file of its partition, in scan order.

    Spark's text writer commits the files, so lost tasks leave none behind. It ends each
    row with a given character; that character is the separator's last byte, so the
    files hold the ids and nothing else.
    """
    last = separator & 0xFF
    if separator >> 16 or last >= 0x80:
        raise ValueError("a separator of two bytes is needed, the second of them ASCII")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.encoding(ranks_path, pattern)
        if enc.max_token_value > 0xFFFF or separator <= enc.max_token_value:
            raise ValueError("ids must fit two bytes and differ from the separator")
        end = np.array([separator], np.uint32)
        for whole in batches:
            for batch in bpe.in_slices(whole, 0):
                rows = [np.append(bpe.encode_text(enc, t), end).astype(">u2").tobytes()[:-1] for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = texts.mapInArrow(run, "ids binary").select(F.col("ids").cast("string").alias("value"))
    rows.write.option("lineSep", chr(last)).text(folder)


def _read(path: str, offset: int, length: int) -> bytes:
    from pyarrow import fs

    uri = path if "://" in path else "file://" + path.removeprefix("file:")
    store, name = fs.FileSystem.from_uri(uri)
    with store.open_input_file(name) as f:
        return f.read_at(length, offset)


def scan_blocks(spark: SparkSession, folder: str, separator: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, block, first long, n_ids long, ends array<long>): separators' positions, by block."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length").where("length > 0")
    total = files.agg(F.sum("length")).first()[0] or 0
    blocks = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(block_bytes).cast("long"))).alias("offset"))
    blocks = blocks.repartition(max(1, -(-total // TASK_BYTES)), "path", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(_read(row["path"], row["offset"], min(block_bytes, row["length"] - row["offset"])), ">u2")
                first = row["offset"] // TOKEN_BYTES
                ends = np.flatnonzero(ids == separator) + first
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["path"]]), pa.array([row["offset"] // block_bytes], pa.int64()), pa.array([first], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([ends], pa.list_(pa.int64()))],
                    names=["file", "block", "first", "n_ids", "ends"],
                )

    return blocks.mapInArrow(run, "file string, block long, first long, n_ids long, ends array<long>")


def count_tokens(spark: SparkSession, folder: str, separator: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, doc, start, n_tokens) of every document: `doc` counts from 0 in its file."""
    if block_bytes % TOKEN_BYTES:
        raise ValueError("blocks must hold whole ids")
    blocks = written(scan_blocks(spark, folder, separator, block_bytes))
    # The prefix scan sees one short row a block, never the positions themselves.
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    heads = blocks.select(
        "file",
        "block",
        F.size("ends").alias("n_ends"),
        F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1).alias("last_end"),
    ).select(
        "file",
        "block",
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("docs_before"),
        F.coalesce(F.last("last_end", ignorenulls=True).over(before), F.lit(-1).cast("long")).alias("end_before"),
    )
    stitched = blocks.where(F.size("ends") > 0).join(heads, ["file", "block"])
    starts = F.concat(F.array(F.col("end_before") + 1), F.transform(F.slice("ends", 1, F.size("ends") - 1), lambda e: e + 1))
    closed = stitched.select("file", "docs_before", F.posexplode(F.arrays_zip(starts.alias("start"), F.col("ends").alias("end"))).alias("i", "doc"))
    closed = closed.select("file", (F.col("docs_before") + F.col("i")).alias("doc"), F.col("doc.start").alias("start"), (F.col("doc.end") - F.col("doc.start")).alias("n_tokens"))
    # What follows a file's last separator.
    sizes = blocks.groupBy("file").agg(
        F.sum(F.size("ends")).alias("doc"),
        (F.coalesce(F.max(F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1)), F.lit(-1).cast("long")) + 1).alias("start"),
        F.max(F.col("first") + F.col("n_ids")).alias("size"),
    )
    open_end = sizes.where("size > start").select("file", F.col("doc").cast("long").alias("doc"), "start", (F.col("size") - F.col("start")).alias("n_tokens"))
    return closed.unionByName(open_end)
