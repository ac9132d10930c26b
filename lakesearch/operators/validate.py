"""Validation of raw events and the split into validated rows and dead letters.

Everything is column expressions over VARIANT, so that the same function serves a
batch DataFrame and a stream. A row passes when `reason` is null.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakesearch.functions.json import kind, parse_strict
from lakesearch.functions.once import once
from lakesearch.operators.filters import event_key
from lakesearch.schemas import STORY_EVENT, STORY_FIELDS

# ---- fixed values: messages and the integer text pattern ----
MISSING = "Field required"
BAD_INT = "Input should be a valid integer"
BAD_INT_TEXT = "Input should be a valid integer, unable to parse string as an integer"
FRACTION = "Input should be a valid integer, got a number with a fractional part"
NOT_FINITE = "Input should be a finite number"
OUT_OF_RANGE = "integer out of range"
BAD_STRING = "Input should be a valid string"
TOO_SHORT = "String should have at least 1 character"
NO_CONTENT = "Value error, story has neither text body nor url"
INVALID_JSON = "invalid JSON text"
NOT_AN_OBJECT = "not a JSON object"
MALFORMED = "malformed_json"
INVALID = "validation_failed"
LIGHT_REASON = "Invalid payload format or missing title"
INT_TEXT = r"^(?U)\s*([+-]?[0-9]+(?:_[0-9]+)*)(?:\.0+)?\s*$"
NON_EMPTY_FIELDS = ("title", "by")
# -------------------------------------------------------------


def _none() -> Column:
    return F.lit(None).cast("string")


class Member:
    """One field of a parsed event, as plain columns: its JSON type and its readings."""

    def __init__(self, name: str, is_int: bool):
        self.name, self.is_int = name, is_int
        self.type, self.text = F.col(f"__type_{name}"), F.col(f"__text_{name}")
        self.big, self.real = F.col(f"__big_{name}"), F.col(f"__real_{name}")

    def readings(self) -> dict[str, Column]:
        get = lambda t: F.try_variant_get("parsed", f"$.{self.name}", t)
        columns = {
            f"__type_{self.name}": F.schema_of_variant(get("variant")),
            f"__text_{self.name}": get("string"),
        }
        if self.is_int:
            columns |= {f"__big_{self.name}": get("bigint"), f"__real_{self.name}": get("double")}
        return columns

    def number(self) -> Column:
        return (self.type == "DOUBLE") | F.startswith(self.type, F.lit("DECIMAL"))

    def fractional(self) -> Column:
        # A decimal keeps its scale in the name of its type; a double is tested by value.
        whole_decimal = F.endswith(self.type, F.lit(",0)"))
        return F.when(self.type == "DOUBLE", self.real % 1 != 0).otherwise(~whole_decimal)

    def int_text(self) -> Column:
        digits = F.regexp_replace(F.regexp_extract(self.text, INT_TEXT, 1), "[_+]", "")
        return digits.try_cast("bigint")

    def value(self) -> Column:
        """Text as it is, or an integer read laxly: whole numbers, booleans, integer text."""
        if not self.is_int:
            return F.when(self.type == "STRING", self.text)
        return (
            F.when(self.type.isin("BIGINT", "BOOLEAN"), self.big)
            .when(self.type == "STRING", self.int_text())
            .when(self.number() & ~self.fractional(), self.big)
        )

    def error(self, required: bool, non_empty: bool) -> Column:
        """The field's error, or null. A missing type is a missing field."""
        absent = F.when(self.type.isNull(), F.lit(MISSING) if required else _none())
        if not self.is_int:
            return (
                absent.when(self.type == "STRING", F.when(self.text == "", F.lit(TOO_SHORT)) if non_empty else _none())
                .when(self.type == "VOID", F.lit(BAD_STRING) if required else _none())
                .otherwise(F.lit(BAD_STRING))
            )
        return (
            absent.when(self.type.isin("BIGINT", "BOOLEAN"), _none())
            .when(self.type == "VOID", F.lit(BAD_INT) if required else _none())
            .when(
                self.type == "STRING",
                F.when(~F.rlike(self.text, F.lit(INT_TEXT)), F.lit(BAD_INT_TEXT))
                .when(self.int_text().isNull(), F.lit(OUT_OF_RANGE)),
            )
            .when(
                self.number(),
                F.when(F.abs(self.real) == float("inf"), F.lit(NOT_FINITE))
                .when(self.fractional(), F.lit(FRACTION))
                .when(self.big.isNull(), F.lit(OUT_OF_RANGE)),
            )
            .otherwise(F.lit(BAD_INT))
        )


class Split(NamedTuple):
    valid: DataFrame
    dead: DataFrame


def validate(raw: DataFrame, key_col: str = "key", value_col: str = "value") -> DataFrame:
    """Judge every raw message.

    Result: `key`, `original_event` (the text as it came), `parsed` (VARIANT), the
    nine story fields, `reason_class` and `reason` (null for a valid row; otherwise
    the first error in declaration order).
    """
    # A binary message is looked at as text; undecodable bytes make it malformed.
    text = F.col(value_col).cast("string")
    df = raw.select(
        event_key(F.col(key_col).cast("string")).alias("key"),
        F.make_valid_utf8(text).alias("original_event"),
        F.when(F.is_valid_utf8(text), text).alias("__text"),
    )
    df = parse_strict(df, "__text", "parsed")
    members = [Member(f.name, isinstance(f.dataType, T.LongType)) for f in STORY_EVENT]
    readings = {k: v for m in members for k, v in m.readings().items()}
    df = once(df, __kind=kind(F.col("parsed")), **readings)

    malformed = F.when(F.col("parsed").isNull() & F.col("original_event").isNotNull(), F.lit(INVALID_JSON)).when(
        F.coalesce(F.col("__kind"), F.lit("")) != "OBJECT", F.lit(NOT_AN_OBJECT)
    )
    errors = [m.error(not f.nullable, f.name in NON_EMPTY_FIELDS) for m, f in zip(members, STORY_EVENT, strict=True)]
    fields = {m.name: m.value() for m in members}
    df = once(df, **fields, __malformed=malformed, __error=F.coalesce(*errors))
    # The rule across fields is looked at only when every field has passed.
    no_content = (F.coalesce("text", F.lit("")) == "") & (F.coalesce("url", F.lit("")) == "")
    error = F.coalesce("__error", F.when(no_content, F.lit(NO_CONTENT)))
    df = once(
        df,
        reason_class=F.when(F.col("__malformed").isNotNull(), F.lit(MALFORMED)).when(error.isNotNull(), F.lit(INVALID)),
        reason=F.coalesce(
            F.concat(F.lit(f"{MALFORMED}: "), "__malformed"),
            F.concat(F.lit(f"{INVALID}: "), error),
        ),
    )
    return df.select("key", "original_event", "parsed", *STORY_FIELDS, "reason_class", "reason")


def valid_rows(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNull()).select("key", *STORY_FIELDS)


def dead_letters(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reason").isNotNull()).select("key", "reason", "reason_class", "original_event")


def split(judged: DataFrame) -> Split:
    """Every judged row goes to exactly one side."""
    return Split(valid_rows(judged), dead_letters(judged))


def dead_letter_messages(judged: DataFrame) -> DataFrame:
    """Dead letters as keyed JSON: the original is text if malformed, else an object."""
    original = F.when(F.col("reason_class") == MALFORMED, F.col("original_event").cast("variant")).otherwise(F.col("parsed"))
    return judged.where(F.col("reason").isNotNull()).select(
        "key",
        F.to_json(F.struct("reason", original.alias("original_event")), {"ignoreNullFields": "false"}).alias("value"),
    )


def split_counts(judged: DataFrame) -> DataFrame:
    return judged.agg(
        F.count_if(F.col("reason").isNull()).alias("valid"),
        F.count_if(F.col("reason").isNotNull()).alias("dlq"),
        F.count(F.lit(1)).alias("total"),
    )


def validate_light(items: DataFrame, now: Column | int) -> DataFrame:
    """The on-demand path's rule over parsed items (columns as in a story event).

    A story with a title passes; author, score and time are filled in when the item
    lacks them, and an empty text becomes the title. `now` is the time to fill in.
    """
    now = F.lit(now) if isinstance(now, int) else now
    ok = F.coalesce((F.col("type") == "story") & (F.coalesce("title", F.lit("")) != ""), F.lit(False))
    keep = lambda c: F.when(ok, c)
    return items.select(
        "id",
        keep(F.col("title")).alias("title"),
        keep(F.coalesce(F.nullif("text", F.lit("")), "title")).alias("text"),
        keep(F.coalesce("by", F.lit("anonymous"))).alias("by"),
        keep(F.coalesce("score", F.lit(0)).cast("bigint")).alias("score"),
        keep(F.coalesce("time", now).cast("bigint")).alias("time"),
        keep(F.col("id").cast("string")).alias("_kafka_key"),
        F.when(~ok, F.lit(LIGHT_REASON)).alias("reason"),
    )
