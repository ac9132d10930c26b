"""Input views over the test tables.

The SQL here only shapes inputs; the same text runs in Spark and in the SQL check, so
both sides start from identical rows. `{name}` stands for a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesearch.operators import bm25
from lakesearch.operators.silver import build_silver
from lakesearch.session import written
from lakesearch.sources.files import spread

# Raw messages: one JSON text per event, with a fault or an oddity for most values of
# m = event_id % 20. Nothing is left out: every event becomes a message.
RAW_EVENTS = """
SELECT event_id, m, user_id, event_type,
  CASE WHEN m = 19 THEN '' ELSE concat('user', user_id) END AS key,
  CASE
    WHEN m = 5 THEN concat('{{"id": ', event_id, ', "title": ')
    WHEN m = 6 THEN concat('[', event_id, ']')
    ELSE concat(
      '{{',
      CASE m WHEN 7 THEN concat('"id": "', event_id, '"')
             WHEN 8 THEN concat('"id": ', event_id, '.0')
             WHEN 18 THEN concat('"id": 99999999999999999999', event_id)
             ELSE concat('"id": ', event_id) END,
      CASE m WHEN 1 THEN '' WHEN 2 THEN ', "title": ""' WHEN 12 THEN ', "title": 5'
             ELSE concat(', "title": "', event_type, ' number ', event_id, '"') END,
      CASE m WHEN 10 THEN '' ELSE concat(', "by": "user', user_id, '"') END,
      CASE m WHEN 3 THEN ', "time": "not-a-number"' WHEN 11 THEN ', "time": 1.5'
             ELSE concat(', "time": ', 1704067200 + event_id * 60) END,
      CASE m WHEN 16 THEN ', "type": "comment"' ELSE ', "type": "story"' END,
      CASE m WHEN 15 THEN ', "text": 7' WHEN 19 THEN concat(', "text": "<p>Hi ', user_id, ' &amp; bye</p>"') ELSE '' END,
      CASE WHEN m IN (4, 19) THEN '' ELSE concat(', "url": "https://www.site', user_id, '.org/', event_type, '"') END,
      CASE m WHEN 14 THEN ', "score": null, "descendants": true' WHEN 17 THEN ', "score": "1e3"'
             ELSE concat(', "score": ', user_id, ', "descendants": ', event_id % 100) END,
      CASE m WHEN 9 THEN ', "deleted": true' WHEN 8 THEN ', "dead": 1' WHEN 0 THEN ', "deleted": false, "kids": [1, 2]' ELSE '' END,
      '}}',
      CASE m WHEN 13 THEN ' trailing' ELSE '' END)
  END AS value
FROM (SELECT *, event_id % 20 AS m FROM {events}) e
"""

# Integer spellings: which of them a lax reader takes for a number.
COERCION_EVENTS = """
SELECT event_id, m, concat('user', user_id) AS key,
  concat('{{"id": ',
    CASE m WHEN 0 THEN concat('"', event_id, '"') WHEN 1 THEN concat('" ', event_id, ' "')
           WHEN 2 THEN concat('"+', event_id, '"') WHEN 3 THEN concat('"00', event_id, '"')
           WHEN 4 THEN concat('"', event_id, '_000"') WHEN 5 THEN concat('"', event_id, '.0"')
           WHEN 6 THEN concat(event_id, '.0') WHEN 7 THEN 'true'
           WHEN 8 THEN concat('"', event_id, '.5"') WHEN 9 THEN concat('"', event_id, 'abc"')
           WHEN 10 THEN '""' WHEN 11 THEN concat('"', event_id, 'e3"') WHEN 12 THEN '"0x10"'
           WHEN 13 THEN concat(event_id, '.5') WHEN 14 THEN 'null' WHEN 15 THEN '[1]'
           WHEN 16 THEN '{{"a": 1}}' WHEN 17 THEN concat('-', event_id) WHEN 18 THEN concat(event_id, 'e2')
           WHEN 19 THEN '"99999999999999999999"' WHEN 20 THEN '1e400'
           ELSE concat('', event_id) END,
    ', "title": "t", "by": "b", "time": 1, "type": "story", "url": "u"}}') AS value
FROM (SELECT *, event_id % 22 AS m FROM {events}) e
"""

# A change feed: event name and data.
FEED = """
SELECT event_id,
  CASE event_type WHEN 'error' THEN 'error' ELSE 'message' END AS event,
  CASE WHEN event_id % 13 = 0 THEN ''
       WHEN event_id % 11 = 0 THEN '{{"type": "edit", '
       ELSE concat('{{"type": "',
         CASE event_type WHEN 'view' THEN 'log' WHEN 'click' THEN 'edit' WHEN 'purchase' THEN 'new' ELSE 'categorize' END,
         '"', CASE WHEN event_id % 7 = 0 THEN '' ELSE concat(', "wiki": "w', user_id, '"') END, '}}') END AS data
FROM {events}
"""

# Items for the on-demand path: some without type, title, text, author, score or time.
LIGHT_ITEMS = """
SELECT event_id AS id,
  CASE WHEN event_type = 'error' THEN 'comment' ELSE 'story' END AS type,
  CASE WHEN event_id % 9 = 0 THEN NULL WHEN event_id % 9 = 1 THEN '' ELSE concat(event_type, ' ', user_id) END AS title,
  CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 4 = 1 THEN '' ELSE concat('body of ', event_id) END AS text,
  CASE WHEN event_id % 5 = 0 THEN NULL ELSE concat('user', user_id) END AS by,
  CASE WHEN event_id % 6 = 0 THEN NULL ELSE user_id END AS score,
  CASE WHEN event_id % 8 = 0 THEN NULL ELSE 1704067200 + event_id END AS time
FROM {events}
"""

# Topic offsets: three topics, eight partitions each.
OFFSETS = """
SELECT CASE event_type WHEN 'view' THEN 'raw-events-topic' WHEN 'click' THEN 'validated-events-topic'
            WHEN 'error' THEN 'dlq-topic' ELSE 'other-topic' END AS topic,
       CAST(user_id % 8 AS INT) AS partition, event_id AS "offset"
FROM {events}
"""

# Titles and texts to take apart again.
DETAILS = """
SELECT conv_id, turn,
  CASE WHEN turn % 3 = 0 THEN concat(' ', role, ' ') WHEN turn % 3 = 1 THEN NULL ELSE 'Note' END AS title,
  CASE WHEN conv_id % 3 = 0 THEN concat(role, ': ', text) WHEN conv_id % 3 = 1 THEN text ELSE concat('A: b: ', text) END AS text,
  concat('[', role, '] ', text, ' #note (', role, ') using hotcat - ') AS details
FROM {conversations}
"""


# Tables whose rows are worth dealing out, by key.
SPREAD_BY = {"events": "event_id", "documents": "doc_id", "pages": "page_id", "embeddings": "vec_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, SPREAD_BY[name]) if name in SPREAD_BY else df


def view(spark: SparkSession, sf_dir: str, sql: str, **tables: DataFrame) -> DataFrame:
    return spark.sql(sql.replace('"offset"', "offset"), **tables)


def events_view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return view(spark, sf_dir, sql, events=table(spark, sf_dir, "events"))


def stories_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as stories: the page's title, its HTML as text."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"),
        F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("url", "//([^/?#]*)", 1).alias("by"),
        (F.lit(1704067200) + F.col("page_id") * 60).alias("time"),
        F.lit("story").alias("type"),
        F.col("html").alias("text"),
        F.col("url"),
    )


def stories_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Bronze rows. One title for all, so that equal texts are duplicates."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        F.lit("document").alias("title"),
        F.col("source").alias("by"),
        (F.lit(1704067200) + F.col("doc_id")).alias("time"),
        F.lit("story").alias("type"),
        "text",
        F.lit(None).cast("string").alias("url"),
        F.col("n_chars").alias("score"),
        F.date_format(
            F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
        ).alias("_ingested_at"),
    )


def silver_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_silver(stories_docs(spark, sf_dir))


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole benchmark texts, and nation names: those match little or nothing."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))
    names = table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey").cast("bigint") + 1000000).alias("query_id"), F.col("n_name").alias("query_text")
    )
    return items.unionByName(names)


def written_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`silver_docs` as a table, the way retrieval finds Silver in the pipeline."""
    return written(silver_docs(spark, sf_dir))


def corpus(silver: DataFrame) -> DataFrame:
    """The retrieval corpus: Silver's snippets under their ids.

    Here the ids are unique and follow arrival, so they serve as `doc`.
    """
    return bm25.corpus(silver, "id")


def label_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query vector per label: the mean of its embeddings."""
    parts = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "x")))
    return means.groupBy("label").agg(F.transform(ordered, lambda s: s.x).alias("query_vector")).select(
        F.col("label").cast("bigint").alias("query_id"), "query_vector"
    )
