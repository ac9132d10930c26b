"""Text to vector. Any model can be plugged in; the built-in one needs no download."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha1

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesearch.functions.once import once
from lakesearch.functions.text import tokenize

# Vector width, and texts per call of a model.
EMBEDDING_DIM = 384
MODEL_BATCH = 64
# Numbers of the vectors that a task makes at once.
CELLS = 500_000

Embedder = Callable[[DataFrame, str, str], DataFrame]


def _unit_histogram(dim: int):
    """Tokens to the unit-length histogram of their hashes: a token is hashed once a slice, and a slice holds CELLS numbers."""

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def histogram(tokens: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        step, out = max(1, CELLS // dim), [pa.array([], pa.float32())]
        for first in range(0, len(tokens), step):
            coded = tokens.slice(first, step).flatten().dictionary_encode()
            bucket = np.array([int(sha1(t.encode("utf-8")).hexdigest()[:4], 16) % dim for t in coded.dictionary.to_pylist()], np.int64)
            rows = len(lengths[first : first + step])
            cells = np.repeat(np.arange(rows) * dim, lengths[first : first + step])
            cells = cells + bucket[coded.indices.to_numpy(zero_copy_only=False)] if len(cells) else cells
            counts = np.bincount(cells, minlength=rows * dim).reshape(rows, dim).astype(np.float64)
            norm = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
            out.append(pa.array((counts / np.where(norm > 0, norm, 1.0)).astype(np.float32).ravel()))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(tokens) + 1) * dim, pa.int32()), pa.concat_arrays(out))

    return histogram


def hashed_embedder(dim: int = EMBEDDING_DIM) -> Embedder:
    """Hashed bag of words, unit length: a repeatable stand-in for a sentence model.

    Texts are split in the JVM; Python hashes the distinct tokens of a slice of rows. A text
    without tokens becomes the zero vector.
    """

    def embed(df: DataFrame, text_col: str, out: str = "vector") -> DataFrame:
        tokens = tokenize(F.coalesce(F.col(text_col), F.lit("")))
        return once(df, **{out: _unit_histogram(dim)(tokens)})

    return embed


def model_embedder(load_model: Callable[[], Callable[[list[str]], np.ndarray]], batch_size: int = MODEL_BATCH) -> Embedder:
    """Embed with a model that `load_model()` opens once per Python worker.

    A partition without rows loads nothing.
    """

    def embed(df: DataFrame, text_col: str, out: str = "vector") -> DataFrame:
        schema = T.StructType(list(df.schema.fields) + [T.StructField(out, T.ArrayType(T.FloatType()))])

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            model = None
            for frame in frames:
                if frame.empty:
                    continue
                if model is None:
                    model = load_model()
                texts = frame[text_col].fillna("").tolist()
                vectors: list = []
                for at in range(0, len(texts), batch_size):
                    vectors.extend(np.asarray(model(texts[at : at + batch_size]), dtype="float32"))
                frame[out] = vectors
                yield frame

        return df.mapInPandas(run, schema)

    return embed
