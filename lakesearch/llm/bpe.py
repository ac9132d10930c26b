"""Byte-level BPE encoding and decoding with the tiktoken library.

Ranks come from a local file in tiktoken's text format (its path is a parameter); no
special tokens exist. Long texts are cut before the regex runs, only where a match of
the pattern must end: at a single blank between two letters or digits. No alternative
of the pattern passes from a letter or digit into a blank, so both halves encode to the
same ids as the whole.

Defined results: null text counts as empty; an empty text has no ids and decodes to no
bytes; repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Texts above this many characters are encoded piece by piece.
PIECE_CHARS = 1 << 16
SAFE_CUT = re.compile(r"(?<=[^\W_]) (?=[^\W_])")

_encodings: dict = {}


def encoding(ranks_path: str, pattern: str):
    """The encoding, built once in each worker process."""
    key = (ranks_path, pattern)
    if key not in _encodings:
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}
        _encodings[key] = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """The text in pieces of about `limit` characters, cut at safe boundaries only."""
    start = 0
    while len(text) - start > limit:
        cut = SAFE_CUT.search(text, start + limit)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(enc, text: str) -> np.ndarray:
    """Ids of the whole text, as unsigned 32-bit integers."""
    if len(text) <= PIECE_CHARS:
        return enc.encode_to_numpy(text, disallowed_special=())
    return np.concatenate([enc.encode_to_numpy(x, disallowed_special=()) for x in pieces(text)])


def _lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(x) for x in ids], out=offsets[1:])
    flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


#: Characters of text that one Arrow batch sent back may come from.
BATCH_CHARS = 4 << 20


def in_slices(batch: pa.RecordBatch, text_column: int) -> Iterator[pa.RecordBatch]:
    """The batch cut into runs of rows with about BATCH_CHARS of text, one row at least."""
    lengths = pc.binary_length(batch.column(text_column)).to_numpy(zero_copy_only=False)
    start, chars = 0, 0
    for i, n in enumerate(lengths):
        chars += int(n)
        if chars >= BATCH_CHARS:
            yield batch.slice(start, i + 1 - start)
            start, chars = i + 1, 0
    if start < len(lengths):
        yield batch.slice(start)


def encode(df: DataFrame, key: str, ranks_path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """(key, ids array<int>) of every row; with `decoded` also the bytes the ids stand for."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for whole in batches:
            for batch in in_slices(whole, 1):
                ids = [encode_text(enc, t) for t in batch.column(1).to_pylist()]
                columns = [batch.column(0), _lists(ids)]
                if decoded:
                    columns.append(pa.array([enc.decode_bytes(x.tolist()) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=["key", "ids", "decoded"][: len(columns)])

    schema = f"key {kind}, ids array<int>" + ", decoded binary" * decoded
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def decode(df: DataFrame, key: str, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """(key, decoded binary): the raw bytes, which need not be valid UTF-8. Null ids give null."""
    rows = df.select(F.col(key).alias("key"), F.col(ids).cast("array<int>").alias("ids"))
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(ranks_path, pattern)
        for batch in batches:
            found = [None if x is None else enc.decode_bytes(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["key", "decoded"])

    return rows.mapInArrow(run, f"key {kind}, decoded binary").withColumnRenamed("key", key)


def digests(encoded: DataFrame, keep_ids: bool = False) -> DataFrame:
    """Token count and the hashes of ids and decoded bytes, from `encode(..., decoded=True)`."""
    return encoded.select(
        *[c for c in encoded.columns if c != "decoded" and (keep_ids or c != "ids")],
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
