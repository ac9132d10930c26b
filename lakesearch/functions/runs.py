"""Run lengths of a sorted array: counting inside a row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesearch.functions.once import once


def with_run_lengths(df: DataFrame, values: Column, value_name: str, count_name: str, out: str) -> DataFrame:
    """Add `out`: array<struct<value_name, count_name>>, one entry per distinct value, ascending.

    The array is sorted once per row; after that the lambdas only index into it.
    """
    sorted_, starts = "__sorted", "__starts"
    at = lambda i: F.get(F.col(sorted_), i)
    df = once(df, **{sorted_: F.sort_array(values)})
    first_of_run = F.when(
        F.size(sorted_) > 0,
        F.filter(F.sequence(F.lit(0), F.size(sorted_) - 1), lambda i: (i == 0) | (at(i) != at(i - 1))),
    ).otherwise(F.array().cast("array<int>"))
    df = once(df, **{starts: first_of_run})
    run = F.transform(
        F.col(starts),
        lambda p, j: F.struct(
            at(p).alias(value_name),
            (F.coalesce(F.get(F.col(starts), j + 1), F.size(sorted_)) - p).cast("bigint").alias(count_name),
        ),
    )
    return once(df, **{out: run}).drop(sorted_, starts)
