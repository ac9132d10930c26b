"""Text functions over columns: cleaning, snippets, tokens and display strings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ---------------------------------------------------------
# Patterns. Whitespace is what Python takes for whitespace, named one by one: Java's
# own \s is ASCII, and its Unicode mode is several times slower.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
HTML_TAG = r"<[^>]+>"
NETLOC = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"
BRACKET_NOTE = r"\[[^\]]{0,60}\](?U)[\s\x1c-\x1f]*"
HASHTAG_CALL = r"(?U)#\w+[\s\x1c-\x1f]*\([^)]*\)"
HOTCAT = r"(?iU)\busing HotCat\b"
# Characters that Python's str.strip() removes.
STRIP_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
URL_LEADING_CHARS = "".join(map(chr, range(0x21)))
DETAIL_STRIP_CHARS = " -;:"
MIN_SNIPPET_LENGTH = 5
NO_DETAILS = "(no edit summary provided)"
NO_TITLE = "(untitled)"
NO_SCORE = "—"
ITEM_URL = "https://news.ycombinator.com/item?id="
# ---------------------------------------------------------------------------


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_empty(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(STRIP_CHARS))


def collapse_whitespace(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_col(c), WHITESPACE, " "))


def _entity_decoder():
    @F.pandas_udf("string")
    def decode(s: pd.Series) -> pd.Series:
        from html import unescape

        return s.map(unescape, na_action="ignore")

    return decode


def unescape_html(c: Column | str) -> Column:
    """Decode HTML entities in one pass.

    The entity table is not among Spark's functions, so the standard library does
    it; texts without `&` are sent to Python as nulls and keep their own value.
    """
    c = _col(c)
    decoded = _entity_decoder()(F.when(F.contains(c, F.lit("&")), c))
    return F.coalesce(decoded, c)


def clean_html(c: Column | str) -> Column:
    """Tags to blanks, then entities, then whitespace: the order is part of the result."""
    untagged = F.regexp_replace(blank_to_empty(c), HTML_TAG, " ")
    return collapse_whitespace(unescape_html(untagged))


def domain_of(url: Column | str) -> Column:
    """Network location of a URL with every `www.` removed; empty when there is none."""
    u = F.regexp_replace(blank_to_empty(url), "[\t\r\n]", "")
    u = F.ltrim(u, F.lit(URL_LEADING_CHARS))
    netloc = F.regexp_extract(u, NETLOC, 1)
    unbalanced = F.contains(netloc, F.lit("[")) != F.contains(netloc, F.lit("]"))
    return F.when(unbalanced, F.lit("")).otherwise(F.replace(netloc, F.lit("www."), F.lit("")))


def snippet_from(title: Column, cleaned: Column, domain: Column) -> Column:
    title = blank_to_empty(title)
    return (
        F.when(cleaned != "", F.concat(title, F.lit(": "), cleaned))
        .when(domain != "", F.concat(title, F.lit(" (link: "), domain, F.lit(")")))
        .otherwise(title)
    )


def build_snippet(title: Column | str, text: Column | str, url: Column | str) -> Column:
    """`title: text`, or `title (link: domain)`, or the title. The title is kept raw."""
    return snippet_from(_col(title), clean_html(text), domain_of(url))


def tokenize(c: Column | str) -> Column:
    """Lower-case, split on whitespace. No stop words; punctuation stays."""
    return F.array_remove(F.split(F.lower(_col(c)), WHITESPACE), "")


def split_title(title: Column | str, text: Column | str) -> Column:
    """Struct(title, details) taken apart from a payload's title and text."""
    title, text = strip(blank_to_empty(title)), strip(blank_to_empty(text))
    prefixed = (title != "") & F.startswith(text, F.concat(title, F.lit(":")))
    at = F.instr(text, ": ")
    head = F.when(title != "", title).otherwise(strip(F.substring(text, F.lit(1), at - 1)))
    return (
        F.when(
            prefixed,
            F.struct(title.alias("title"), strip(F.substring(text, F.length(title) + 2, F.length(text))).alias("details")),
        )
        .when(
            at > 0,
            F.struct(head.alias("title"), strip(F.substring(text, at + 2, F.length(text))).alias("details")),
        )
        .otherwise(
            F.struct(title.alias("title"), F.when(title != "", F.lit("")).otherwise(text).alias("details"))
        )
    )


def clean_event_details(details: Column | str) -> Column:
    d = blank_to_empty(details)
    for pattern in (BRACKET_NOTE, HASHTAG_CALL, HOTCAT):
        d = F.regexp_replace(d, pattern, "")
    d = F.btrim(F.regexp_replace(d, WHITESPACE, " "), F.lit(DETAIL_STRIP_CHARS))
    return F.when(d == "", F.lit(NO_DETAILS)).otherwise(d)


def item_link(item_id: Column | str, base: str = ITEM_URL) -> Column:
    i = F.coalesce(_col(item_id), F.lit(0)).cast("bigint")
    return F.when(i != 0, F.concat(F.lit(base), i.cast("string"))).otherwise(F.lit(""))


def fixed_decimal(c: Column | str, places: int) -> Column:
    c = _col(c)
    return F.when(c.isNull(), F.lit(NO_SCORE)).otherwise(F.format_string(f"%.{places}f", c))


def _utc_format(ts: Column | str, pattern: str) -> Column:
    return F.date_format(F.to_utc_timestamp(_col(ts), F.current_timezone()), pattern)


def partition_date(ts: Column | str) -> Column:
    return _utc_format(ts, "yyyy-MM-dd")


def partition_hour(ts: Column | str) -> Column:
    return _utc_format(ts, "HH")


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text with microseconds and the UTC offset, whatever the session's zone."""
    return _utc_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def event_json(columns: list[str]) -> Column:
    """One JSON object per row; absent values are written as null, not left out."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
