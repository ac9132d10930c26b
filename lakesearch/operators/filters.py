"""Filters and keys on the way in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesearch.functions.once import once
from lakesearch.functions.json import as_text, is_object, member, parse_strict, truthy

# Fixed values.
UNKNOWN_KEY = "unknown"
STORY = "story"
CHANGE_TYPES = ("edit", "new")
BACKFILL_COUNT = 1500


def event_key(key: Column | str) -> Column:
    """Message key; absent or empty becomes `unknown`."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.nullif(key, F.lit("")), F.lit(UNKNOWN_KEY))


def parse_items(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Add `item` (VARIANT): the JSON object in `value_col`, or null."""
    df = parse_strict(df, value_col, "item")
    return once(df, item=F.when(is_object(F.col("item")), F.col("item")))


def member_key(item: Column, name: str) -> Column:
    """Key taken from a member of the item (`by`, `wiki`); absent becomes `unknown`."""
    return F.coalesce(as_text(member(item, name)), F.lit(UNKNOWN_KEY))


def is_story(item: Column) -> Column:
    return F.coalesce(as_text(member(item, "type")) == STORY, F.lit(False))


def is_backfill_story(item: Column) -> Column:
    return is_story(item) & ~truthy(member(item, "deleted")) & ~truthy(member(item, "dead"))


def is_change(item: Column) -> Column:
    return F.coalesce(as_text(member(item, "type")).isin(*CHANGE_TYPES), F.lit(False))


def filter_story_live(items: DataFrame) -> DataFrame:
    """Stories only. Deleted and dead ones pass here, unlike in the backfill."""
    return items.where(is_story(F.col("item")))


def filter_story_backfill(items: DataFrame) -> DataFrame:
    return items.where(is_backfill_story(F.col("item")))


def feed_messages(feed: DataFrame) -> DataFrame:
    """Feed rows (`event`, `data`) that carry data, parsed."""
    carrying = (F.col("event") == "message") & (F.coalesce("data", F.lit("")) != "")
    return parse_items(feed.where(carrying), "data")


def filter_change_feed(feed: DataFrame) -> DataFrame:
    """Edits and new pages of the change feed, keyed by wiki."""
    kept = feed_messages(feed).where(is_change(F.col("item")))
    return kept.withColumn("key", member_key(F.col("item"), "wiki"))


def tally(items: DataFrame, keep: Column) -> DataFrame:
    return items.agg(
        F.count_if(keep).alias("sent"),
        F.count_if(~keep).alias("skipped"),
    )


def unseen_ids(current: DataFrame, primed: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose id is neither in the primed list nor a repeat."""
    return current.join(primed.select(id_col), id_col, "left_anti").dropDuplicates([id_col])


def backfill_range(items: DataFrame, n: int = BACKFILL_COUNT, id_col: str = "id") -> DataFrame:
    """The n ids before the highest one, which itself is left out.

    The highest id is a scalar subquery: Parquet answers it from a pruned scan, and
    the range is then a pushed-down filter.
    """
    top = items.agg(F.max(id_col)).scalar()
    return items.where((F.col(id_col) >= top - n) & (F.col(id_col) < top))


def first_n(items: DataFrame, n: int, order_col: str) -> DataFrame:
    """First n rows in the source's own order."""
    return items.orderBy(order_col).limit(n)
