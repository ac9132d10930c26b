"""Validation rules, routing and filters on hand-made messages."""

import json

import pytest
from pyspark.sql import functions as F

from lakesearch.operators import filters, validate

GOOD = {"id": 71, "title": "A map of tides", "by": "mara", "time": 1700000071, "type": "story", "url": "https://tides.test/map"}


def judge(spark, values, key="k"):
    df = spark.createDataFrame([(i, key, v) for i, v in enumerate(values)], "i int, key string, value string")
    judged = validate.validate(df.select("key", "value"))
    by_text = {r["original_event"]: r for r in judged.collect()}
    return [by_text[v] for v in values]


def story(drop=(), **changes):
    return json.dumps({k: v for k, v in (GOOD | changes).items() if k not in drop})


@pytest.fixture(scope="module")
def fields():
    return {
        "url only": (story(), None),
        "text only": (story(drop=("url",), text="<div>Drawn by hand.</div>"), None),
        "title missing": (story(drop=("title",)), "validation_failed: Field required"),
        "title empty": (story(title=""), "validation_failed: String should have at least 1 character"),
        "author missing": (story(drop=("by",)), "validation_failed: Field required"),
        "no content": (story(drop=("url",)), "validation_failed: Value error, story has neither text body nor url"),
        "bad time": (
            story(time="not-a-number"),
            "validation_failed: Input should be a valid integer, unable to parse string as an integer",
        ),
        "blank title passes": (story(title=" "), None),
        "null url and empty text": (story(url=None, text=""), "validation_failed: Value error, story has neither text body nor url"),
        "first error wins": (story(drop=("id",), title=""), "validation_failed: Field required"),
        "null title": (story(title=None), "validation_failed: Input should be a valid string"),
        "bool title": (story(title=True), "validation_failed: Input should be a valid string"),
        "list text": (story(text=[1]), "validation_failed: Input should be a valid string"),
        "null type": (story(type=None), "validation_failed: Input should be a valid string"),
        "empty type passes": (story(type=""), None),
        "extra fields": (story(kids=[1, 2], deleted=True), None),
        "dup key, last wins": ('{"id": 1, "id": 2, "title": "t", "by": "b", "time": 1, "type": "s", "url": "u"}', None),
        "trailing text": (story() + " x", "malformed_json: invalid JSON text"),
        "two values": (story() + "," + story(), "malformed_json: invalid JSON text"),
        "closing trick": (story() + "],[1", "malformed_json: invalid JSON text"),
        "array": ("[1]", "malformed_json: not a JSON object"),
        "null": ("null", "malformed_json: not a JSON object"),
        "empty": ("", "malformed_json: invalid JSON text"),
        "number": ("5", "malformed_json: not a JSON object"),
        "line end": (story(id=77) + "\n", None),
    }


def test_reasons(spark, fields):
    rows = judge(spark, [v for v, _ in fields.values()])
    assert {n: r["reason"] for n, r in zip(fields, rows)} == {n: want for n, (_, want) in fields.items()}


def test_every_row_goes_to_one_side(spark, fields):
    values = [v for v, _ in fields.values()]
    df = spark.createDataFrame([("k", v) for v in values], "key string, value string")
    judged = validate.validate(df)
    valid, dead = validate.split(judged)
    assert valid.count() + dead.count() == len(values)
    counts = validate.split_counts(judged).first()
    assert (counts["valid"], counts["dlq"], counts["total"]) == (valid.count(), dead.count(), len(values))
    assert dead.where("reason_class = 'malformed_json'").count() == 7


@pytest.mark.parametrize(
    "text,value,error",
    [
        ('"12"', 12, None),
        ('" 12 "', 12, None),
        ('"+5"', 5, None),
        ('"-5"', -5, None),
        ('"007"', 7, None),
        ('"1_000"', 1000, None),
        ('"1.0"', 1, None),
        ("1.0", 1, None),
        ("1e3", 1000, None),
        ("true", 1, None),
        ("false", 0, None),
        ("-0.0", 0, None),
        ("9223372036854775807", 9223372036854775807, None),
        ('"1__0"', None, validate.BAD_INT_TEXT),
        ('"1.5"', None, validate.BAD_INT_TEXT),
        ('"12abc"', None, validate.BAD_INT_TEXT),
        ('""', None, validate.BAD_INT_TEXT),
        ('"1e3"', None, validate.BAD_INT_TEXT),
        ('"0x10"', None, validate.BAD_INT_TEXT),
        ("1.5", None, validate.FRACTION),
        ("1e-3", None, validate.FRACTION),
        ("1e400", None, validate.NOT_FINITE),
        ("null", None, validate.BAD_INT),
        ("[1]", None, validate.BAD_INT),
        ('{"a": 1}', None, validate.BAD_INT),
        ("9223372036854775808", None, validate.OUT_OF_RANGE),
        ("1e30", None, validate.OUT_OF_RANGE),
        ('"9223372036854775808"', None, validate.OUT_OF_RANGE),
    ],
)
def test_integers(spark, text, value, error):
    message = f'{{"id": {text}, "title": "t", "by": "b", "time": 1, "type": "s", "url": "u"}}'
    row = judge(spark, [message])[0]
    assert row["id"] == value
    assert row["reason"] == (None if error is None else f"validation_failed: {error}")


def test_optional_integers_may_be_null(spark):
    row = judge(spark, [story(score=None, descendants="3")])[0]
    assert (row["reason"], row["score"], row["descendants"]) == (None, None, 3)


def test_null_value_and_bad_bytes(spark):
    df = spark.createDataFrame([("", None), (None, bytearray(b'{"id": "\xff"}'))], "key string, value binary")
    rows = {r["reason"]: r for r in validate.validate(df).collect()}
    assert set(rows) == {"malformed_json: not a JSON object", "malformed_json: invalid JSON text"}
    assert {r["key"] for r in rows.values()} == {"unknown"}
    assert rows["malformed_json: invalid JSON text"]["original_event"] == '{"id": "�"}'


def test_dead_letter_messages(spark):
    bad = story(title="")
    df = spark.createDataFrame([("k", bad), ("k", "{oops")], "key string, value string")
    out = [json.loads(r["value"]) for r in validate.dead_letter_messages(validate.validate(df)).collect()]
    assert {"reason": "validation_failed: String should have at least 1 character", "original_event": json.loads(bad)} in out
    assert {"reason": "malformed_json: invalid JSON text", "original_event": "{oops"} in out


def test_light_rule(spark):
    rows = [
        (1, "story", "T", "", None, None, None),
        (2, "story", "T", "body", "bob", 5, 9),
        (3, "story", "", "x", "bob", 5, 9),
        (4, "job", "T", "x", "bob", 5, 9),
        (5, None, "T", "x", "bob", 5, 9),
    ]
    df = spark.createDataFrame(rows, "id long, type string, title string, text string, by string, score long, time long")
    got = {r["id"]: r for r in validate.validate_light(df, 77).collect()}
    assert (got[1]["text"], got[1]["by"], got[1]["score"], got[1]["time"]) == ("T", "anonymous", 0, 77)
    assert (got[2]["text"], got[2]["by"], got[2]["score"], got[2]["time"], got[2]["reason"]) == ("body", "bob", 5, 9, None)
    assert [got[i]["reason"] for i in (3, 4, 5)] == [validate.LIGHT_REASON] * 3


def test_story_filters(spark):
    items = [
        '{"type": "story", "by": "a"}',
        '{"type": "story", "deleted": true}',
        '{"type": "story", "dead": "yes"}',
        '{"type": "story", "dead": 0, "deleted": null}',
        '{"type": "job"}',
        "null",
        "{}",
        "[]",
    ]
    df = filters.parse_items(spark.createDataFrame([(v,) for v in items], "value string"))
    assert filters.filter_story_live(df).count() == 4
    kept = {r["value"] for r in filters.filter_story_backfill(df).select("value").collect()}
    assert kept == {items[0], items[3]}
    tally = filters.tally(df, filters.is_backfill_story(F.col("item"))).first()
    assert (tally["sent"], tally["skipped"]) == (2, 6)
    assert filters.filter_story_live(df).select(filters.member_key(F.col("item"), "by").alias("k")).distinct().count() == 2


def test_change_feed(spark):
    rows = [
        ("message", '{"type": "edit", "wiki": "enwiki"}'),
        ("message", '{"type": "new"}'),
        ("message", '{"type": "log", "wiki": "x"}'),
        ("message", "{broken"),
        ("message", ""),
        ("error", '{"type": "edit"}'),
    ]
    feed = spark.createDataFrame(rows, "event string, data string")
    assert sorted(r["key"] for r in filters.filter_change_feed(feed).collect()) == ["enwiki", "unknown"]
    tally = filters.tally(filters.feed_messages(feed), filters.is_change(F.col("item"))).first()
    assert (tally["sent"], tally["skipped"]) == (2, 2)


def test_ids(spark):
    ids = spark.createDataFrame([(i,) for i in (5, 6, 6, 7, 9)], "id long")
    primed = spark.createDataFrame([(5,), (8,)], "id long")
    assert sorted(r["id"] for r in filters.unseen_ids(ids, primed).collect()) == [6, 7, 9]
    assert sorted(r["id"] for r in filters.backfill_range(spark.range(100), 3).collect()) == [96, 97, 98]
    assert [r["id"] for r in filters.first_n(ids, 2, "id").collect()] == [5, 6]
