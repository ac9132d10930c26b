"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and expressions use by value.

    Spark merges neighbouring projections and pushes filters below them, copying the
    expressions as it goes; an expensive one is then computed several times per row,
    or inside a lambda for every element. A generator over a one-element array stops
    both and stays inside code generation.
    """
    row = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select(*[c for c in df.columns if c not in columns], F.inline(F.array(row)))
