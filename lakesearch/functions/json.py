"""JSON text to VARIANT, strictly, and tests on the values inside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesearch.functions.once import once


def parse_strict(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Add `out`: the one JSON value that the text holds, as VARIANT; NULL if not exactly one.

    Spark's parser stops after the first value and takes no notice of what follows.
    So the text is put in an array before a mark it cannot contain: the text's own
    hash. Only if the mark is found in second place was the text a single value.
    """
    text = F.col(text_col)
    pair = F.try_parse_json(F.concat(F.lit("["), text, F.lit(',"'), F.md5(text), F.lit('"]')))
    df = once(df, __pair=pair)
    single = F.try_variant_get("__pair", "$[1]", "string") == F.md5(text)
    value = F.when(single, F.try_variant_get("__pair", "$[0]", "variant"))
    return once(df, **{out: value}).drop("__pair")


def member(value: Column, name: str) -> Column:
    """Member of a JSON object: NULL when missing, a VOID variant when it is null."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    """Type of a variant: VOID, STRING, BOOLEAN, BIGINT, DECIMAL, DOUBLE, ARRAY or OBJECT."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def is_object(value: Column) -> Column:
    return F.coalesce(kind(value) == "OBJECT", F.lit(False))


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def truthy(value: Column) -> Column:
    """Python's idea of true: not missing, null, false, zero or empty."""
    k = kind(value)
    return F.coalesce(
        F.when(k == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(k.isin("BIGINT", "DECIMAL", "DOUBLE"), F.try_variant_get(value, "$", "double") != 0)
        .when(k == "STRING", as_text(value) != "")
        .when(k.isin("ARRAY", "OBJECT"), ~F.to_json(value).isin("[]", "{}")),
        F.lit(False),
    )
