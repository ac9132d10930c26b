"""The registered queries as SQL for DuckDB, to check results against.

Written from the definitions, not from the Spark code: expected outcomes of the
validation queries follow from which fault an event was given, not from parsing it.
"""

from __future__ import annotations

from lakesearch.plans import views

_TABLES = {"events": "events", "conversations": "conversations"}


def _view(sql: str) -> str:
    return sql.format(**_TABLES)


# Whitespace as Python knows it; RE2's \s is ASCII.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

RAW = f"raw AS ({_view(views.RAW_EVENTS)})"

# Expected fields of a valid event, by the oddity it carries.
EXPECTED = f"""{RAW},
good AS (
  SELECT CASE WHEN m = 19 THEN 'unknown' ELSE key END AS key,
    CAST(event_id AS BIGINT) AS id,
    concat(event_type, ' number ', event_id) AS title,
    concat('user', user_id) AS "by",
    CAST(1704067200 + event_id * 60 AS BIGINT) AS time,
    CASE WHEN m = 16 THEN 'comment' ELSE 'story' END AS type,
    CASE WHEN m = 19 THEN concat('<p>Hi ', user_id, ' &amp; bye</p>') END AS text,
    CASE WHEN m <> 19 THEN concat('https://www.site', user_id, '.org/', event_type) END AS url,
    CASE WHEN m <> 14 THEN CAST(user_id AS BIGINT) END AS score,
    CASE WHEN m = 14 THEN 1 ELSE CAST(event_id % 100 AS BIGINT) END AS descendants
  FROM raw WHERE m IN (0, 7, 8, 9, 14, 16, 19)),
bad AS (
  SELECT key,
    CASE WHEN m IN (5, 13) THEN 'malformed_json: invalid JSON text'
         WHEN m = 6 THEN 'malformed_json: not a JSON object'
         ELSE concat('validation_failed: ', CASE m
           WHEN 1 THEN 'Field required' WHEN 10 THEN 'Field required'
           WHEN 2 THEN 'String should have at least 1 character'
           WHEN 3 THEN 'Input should be a valid integer, unable to parse string as an integer'
           WHEN 17 THEN 'Input should be a valid integer, unable to parse string as an integer'
           WHEN 4 THEN 'Value error, story has neither text body nor url'
           WHEN 11 THEN 'Input should be a valid integer, got a number with a fractional part'
           WHEN 12 THEN 'Input should be a valid string' WHEN 15 THEN 'Input should be a valid string'
           WHEN 18 THEN 'integer out of range' END) END AS reason,
    CASE WHEN m IN (5, 6, 13) THEN 'malformed_json' ELSE 'validation_failed' END AS reason_class,
    value AS original_event
  FROM raw WHERE m NOT IN (0, 7, 8, 9, 14, 16, 19))"""

FEED = f"feed AS ({_view(views.FEED)})"
CARRYING = "event_type <> 'error' AND event_id % 13 <> 0"
KEPT = "event_id % 11 <> 0 AND event_type IN ('click', 'purchase')"

LIGHT = f"""items AS ({_view(views.LIGHT_ITEMS)}),
judged AS (SELECT *, type = 'story' AND coalesce(title, '') <> '' AS ok FROM items)"""

PAGES = """stories_pages AS (
  SELECT page_id AS id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
    html AS text, url FROM pages)"""


def clean(column: str) -> str:
    """Tags, then the entities that occur here (`&amp;` last), then whitespace."""
    s = f"regexp_replace({column}, '<[^>]+>', ' ', 'g')"
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")):
        s = f"replace({s}, '{entity}', '{char}')"
    return f"trim(regexp_replace({s}, '{WS}+', ' ', 'g'))"


DOMAIN = "replace(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1), 'www.', '')"

BRONZE = f"""bronze AS (
  SELECT CASE WHEN {clean('text')} <> '' THEN concat('document: ', {clean('text')}) ELSE 'document' END AS text,
    'document' AS title, doc_id AS id, source AS "by", CAST(NULL AS VARCHAR) AS url, n_chars AS score,
    1704067200 + doc_id AS time,
    strftime(make_timestamp((1704067200 + doc_id) * 1000000), '%Y-%m-%dT%H:%M:%S.000000+00:00') AS _ingested_at
  FROM documents)"""

SILVER = f"""{BRONZE},
silver AS MATERIALIZED (
  SELECT text, title, id, "by", url, score, time, _ingested_at FROM (
    SELECT *, row_number() OVER (PARTITION BY text ORDER BY _ingested_at DESC, id DESC) AS rn FROM bronze)
  WHERE rn = 1 AND length(text) >= 5)"""


def tokens(column: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({column}), '{WS}+'), lambda t: t <> '')"


def point_id(column: str) -> str:
    g = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({column}))"
    # The variant nibble: its upper two bits become 10.
    nibble = f"substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr({g}, 17, 1)), 1)"
    return (
        f"concat(substr({g}, 1, 8), '-', substr({g}, 9, 4), '-5', substr({g}, 14, 3), '-', "
        f"{nibble}, substr({g}, 18, 3), '-', substr({g}, 21, 12))"
    )


def embedded(name: str, source: str, key: str, column: str) -> str:
    """CTE of (key, bucket, x): the non-zero parts of the hashed unit vector."""
    return f"""{name}_n AS MATERIALIZED (
  SELECT {key}, bucket, count(*) AS n FROM (
    SELECT {key}, ('0x' || substr(sha1(unnest({tokens(column)})), 1, 4))::INT % 384 AS bucket FROM {source})
  GROUP BY ALL),
{name} AS MATERIALIZED (
  SELECT {key}, bucket, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS FLOAT) AS x FROM {name}_n)"""


QUERIES = """q AS (
  SELECT item_id AS query_id, text AS query_text FROM benchmark
  UNION ALL SELECT 1000000 + n_nationkey, n_name FROM nation)"""

INDEX = f"""{SILVER},
tok AS MATERIALIZED (SELECT id AS doc, {tokens('text')} AS t FROM silver),
len AS MATERIALIZED (SELECT doc, CAST(len(t) AS BIGINT) AS dl FROM tok),
post AS MATERIALIZED (SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(t) AS term FROM tok) GROUP BY ALL),
stats AS (SELECT count(*) AS n_docs, CAST(sum(dl) AS BIGINT) AS total_len, avg(dl) AS avgdl FROM len),
dfs AS (SELECT term, count(*) AS df, ln(any_value(n_docs) - count(*) + 0.5) - ln(count(*) + 0.5) AS raw
        FROM post, stats GROUP BY term),
idf AS MATERIALIZED (SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM dfs) ELSE raw END AS idf FROM dfs)"""

SCORES = f"""{INDEX}, {QUERIES},
qt AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest({tokens('query_text')}) AS term FROM q) GROUP BY ALL),
scores AS MATERIALIZED (
  SELECT query_id, doc, sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / avgdl))) AS score
  FROM qt JOIN idf USING (term) JOIN post USING (term) JOIN len USING (doc), stats
  GROUP BY query_id, doc)"""

KEYWORD = f"""{SCORES},
keyword AS MATERIALIZED (
  SELECT query_id, doc, score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc) AS rank FROM (
      SELECT q.query_id, len.doc, coalesce(s.score, 0.0) AS score
      FROM q CROSS JOIN len LEFT JOIN scores s ON s.query_id = q.query_id AND s.doc = len.doc))
  WHERE rank <= 20)"""

DENSE_PARTS = f"""{embedded('dv', '(SELECT id AS doc, text FROM silver)', 'doc', 'text')},
{embedded('qv', 'q', 'query_id', 'query_text')},
dn AS (SELECT doc, sqrt(sum(x::DOUBLE * x::DOUBLE)) AS norm FROM dv GROUP BY doc),
qn AS (SELECT query_id, sqrt(sum(x::DOUBLE * x::DOUBLE)) AS norm FROM qv GROUP BY query_id),
dot AS (SELECT query_id, doc, sum(qv.x::DOUBLE * dv.x::DOUBLE) AS dot FROM qv JOIN dv USING (bucket) GROUP BY ALL),
near AS MATERIALIZED (
  SELECT query_id, doc, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc) AS rank FROM (
    SELECT qn.query_id, dn.doc, round(coalesce(dot, 0.0) / (qn.norm * dn.norm), 9) AS score
    FROM qn CROSS JOIN dn LEFT JOIN dot ON dot.query_id = qn.query_id AND dot.doc = dn.doc))"""

FUSED = f"""{KEYWORD}, {DENSE_PARTS},
dense AS (SELECT * FROM near WHERE rank <= 20),
fused AS MATERIALIZED (
  SELECT query_id, doc, coalesce(1.0::DOUBLE / (60 + d.rank), 0) + coalesce(1.0::DOUBLE / (60 + k.rank), 0) AS fused,
    d.score AS dense_score, k.score AS bm25_score, d.rank AS dense_rank, k.rank AS keyword_rank
  FROM dense d FULL JOIN keyword k USING (query_id, doc)),
pool AS (
  SELECT query_id, count(*) AS pool, CASE WHEN count(*) < 2 THEN 0.0 ELSE avg(fused) + 0.5 * stddev_pop(fused) END AS threshold
  FROM fused GROUP BY query_id)"""

HYBRID = f"""{FUSED},
hybrid AS (
  SELECT query_id, rank, s.text, round(fused, 5) AS fused_score, round(dense_score, 4) AS dense_score,
    round(bm25_score, 4) AS bm25_score,
    fused >= threshold - 1e-12 AND (coalesce(dense_score >= 0.3, false) OR coalesce(bm25_score >= 5.0, false)) AS grounded,
    round(threshold, 5) AS dynamic_threshold, s.id, s."by", s.title
  FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(fused, 12) DESC,
          coalesce(dense_rank, 1000000 + keyword_rank)) AS rank FROM fused)
  JOIN pool USING (query_id) JOIN silver s ON s.id = doc
  WHERE rank <= 5)"""


def strip(column: str) -> str:
    return f"regexp_replace(regexp_replace({column}, '^{WS}+', ''), '{WS}+$', '')"


SPLIT = f"""d AS ({_view(views.DETAILS)}),
s AS (SELECT conv_id, turn, details, {strip("coalesce(title, '')")} AS title, {strip("coalesce(text, '')")} AS text FROM d)"""


def event_details(column: str) -> str:
    s = column
    for pattern, options in (
        (r"\[[^\]]{0,60}\]" + WS + "*", "g"),
        (r"#\w+" + WS + r"*\([^)]*\)", "g"),
        (r"\busing HotCat\b", "gi"),
    ):
        s = f"regexp_replace({s}, '{pattern}', '', '{options}')"
    s = f"trim(regexp_replace({s}, '{WS}+', ' ', 'g'), ' -;:')"
    return f"CASE WHEN {s} = '' THEN '(no edit summary provided)' ELSE {s} END"


LEDGER = "ledger AS (SELECT sha256(text) AS content_hash FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"

STAGES = """stages AS (
  SELECT (SELECT count(*) FROM raw) AS raw, (SELECT count(*) FROM good) AS validated, (SELECT count(*) FROM bad) AS dlq,
    (SELECT count(*) FROM good) AS bronze_rows, (SELECT count(*) FROM silver) AS silver_rows,
    (SELECT count(*) FROM embeddings) AS points, (SELECT count(*) FROM labels) AS synced),
snap AS (
  SELECT *, raw AS shown_raw, validated AS shown_validated,
    CASE WHEN validated + dlq > 0 THEN round(dlq / (validated + dlq) * 100, 6) ELSE 0.0 END AS dlq_rate,
    greatest(silver_rows - synced, 0) AS sync_gap
  FROM stages)"""

POINT_ROWS = 'text, title, id, "by", url, score, time'

ORACLE: dict[str, str] = {
    "filter_story_live": f"""WITH {RAW}
SELECT event_id, CASE WHEN m = 10 THEN 'unknown' ELSE concat('user', user_id) END AS key
FROM raw WHERE m NOT IN (5, 6, 13, 16)""",
    "filter_story_backfill": f"WITH {RAW} SELECT event_id FROM raw WHERE m NOT IN (5, 6, 13, 16, 8, 9)",
    "filter_change_feed": f"""SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'unknown' ELSE concat('w', user_id) END AS key
FROM events WHERE {CARRYING} AND {KEPT}""",
    "filter_tally": f"""SELECT count(*) FILTER (WHERE {KEPT}) AS sent, count(*) FILTER (WHERE NOT ({KEPT})) AS skipped
FROM events WHERE {CARRYING}""",
    "unseen_ids": """SELECT DISTINCT user_id AS id FROM events
WHERE user_id NOT IN (SELECT doc_id FROM labels)""",
    "backfill_range": """SELECT event_id AS id FROM events, (SELECT max(event_id) AS top FROM events)
WHERE event_id >= top - 1500 AND event_id < top""",
    "event_key": f"WITH {RAW} SELECT event_id, CASE WHEN m = 19 THEN 'unknown' ELSE concat('user', user_id) END AS key FROM raw",
    "validate_valid": f"WITH {EXPECTED} SELECT * FROM good",
    "event_json": f"""WITH {EXPECTED}
SELECT id, CAST(json_object('id', id, 'title', title, 'by', "by", 'time', time, 'type', type, 'text', text, 'url', url,
  'score', score, 'descendants', descendants) AS VARCHAR) AS value FROM good""",
    "dlq_records": f"""WITH {EXPECTED}
SELECT CASE WHEN key = '' THEN 'unknown' ELSE key END AS key, reason, reason_class, original_event FROM bad""",
    "validate_dlq_reasons": f"WITH {EXPECTED} SELECT reason, reason_class, count(*) AS n FROM bad GROUP BY ALL",
    "validate_split_counts": f"""WITH {EXPECTED}
SELECT (SELECT count(*) FROM good) AS valid, (SELECT count(*) FROM bad) AS dlq, (SELECT count(*) FROM raw) AS total""",
    "validate_coercion": f"""WITH c AS ({_view(views.COERCION_EVENTS)})
SELECT key, value AS original_event,
  CASE WHEN m IN (0, 1, 2, 3, 5, 6, 21) THEN event_id WHEN m = 4 THEN event_id * 1000 WHEN m = 7 THEN 1
       WHEN m = 17 THEN -event_id WHEN m = 18 THEN event_id * 100 END AS id,
  'validation_failed: ' || CASE
    WHEN m IN (8, 9, 10, 11, 12) THEN 'Input should be a valid integer, unable to parse string as an integer'
    WHEN m = 13 THEN 'Input should be a valid integer, got a number with a fractional part'
    WHEN m IN (14, 15, 16) THEN 'Input should be a valid integer'
    WHEN m = 19 THEN 'integer out of range'
    WHEN m = 20 THEN 'Input should be a finite number' END AS reason
FROM c""",
    "validate_light": f"""WITH {LIGHT}
SELECT id, CASE WHEN ok THEN title END AS title, CASE WHEN ok THEN coalesce(nullif(text, ''), title) END AS text,
  CASE WHEN ok THEN coalesce("by", 'anonymous') END AS "by", CASE WHEN ok THEN coalesce(score, 0) END AS score,
  CASE WHEN ok THEN coalesce(time, 1704067200) END AS time, CASE WHEN ok THEN CAST(id AS VARCHAR) END AS _kafka_key,
  CASE WHEN NOT ok THEN 'Invalid payload format or missing title' END AS reason
FROM judged""",
    "bronze_partition_counts": """SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour, count(*) AS rows
FROM events GROUP BY ALL""",
    "clean_html": f"WITH {PAGES} SELECT id, {clean('text')} AS cleaned FROM stories_pages",
    "domain_of": f"WITH {PAGES} SELECT id, {DOMAIN} AS domain FROM stories_pages",
    "build_snippet": f"WITH {PAGES} SELECT id, concat(title, ': ', {clean('text')}) AS snippet FROM stories_pages",
    "link_snippet": f"""WITH {PAGES}
SELECT id, CASE WHEN {DOMAIN} <> '' THEN concat(title, ' (link: ', {DOMAIN}, ')') ELSE title END AS snippet FROM stories_pages""",
    "tokenize": f"""SELECT doc_id, CAST(len(t) AS BIGINT) AS n_tokens, array_to_string(t, ' ') AS tokens
FROM (SELECT doc_id, {tokens('text')} AS t FROM documents)""",
    "content_hash": "SELECT doc_id, sha256(text) AS content_hash FROM documents",
    "point_id": f"SELECT doc_id, {point_id('sha256(text)')} AS point_id FROM documents",
    "split_title_details": f"""WITH {SPLIT}
SELECT conv_id, turn,
  CASE WHEN title <> '' THEN title WHEN instr(text, ': ') > 0 THEN {strip("substr(text, 1, instr(text, ': ') - 1)")} ELSE '' END AS title,
  CASE WHEN title <> '' AND starts_with(text, title || ':') THEN {strip('substr(text, length(title) + 2)')}
       WHEN instr(text, ': ') > 0 THEN {strip("substr(text, instr(text, ': ') + 2)")}
       WHEN title <> '' THEN '' ELSE text END AS details
FROM s""",
    "clean_event_details": f"WITH {SPLIT} SELECT conv_id, turn, {event_details('details')} AS details FROM s",
    "item_link": """SELECT conv_id, turn,
  CASE WHEN conv_id <> 0 THEN concat('https://news.ycombinator.com/item?id=', conv_id) ELSE '' END AS link FROM conversations""",
    "sample_titles": f"""WITH {PAGES}
SELECT title FROM (SELECT DISTINCT title FROM stories_pages WHERE title IS NOT NULL)
ORDER BY sha1(concat(title, 'lakesearch')), title LIMIT 5""",
    "distinct_titles": f"WITH {PAGES} SELECT DISTINCT title FROM stories_pages WHERE title IS NOT NULL",
    "silver_build": f"WITH {SILVER} SELECT * FROM silver",
    "silver_dedup_report": f"""WITH {SILVER}
SELECT (SELECT count(*) FROM bronze) AS rows_before, (SELECT count(*) FROM silver) AS rows_after,
  (SELECT count(*) FROM bronze) - (SELECT count(*) FROM silver) AS rows_removed""",
    "silver_merge_by_id": """SELECT id, seq, "by", text FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY side, seq) AS rn FROM (
    SELECT conv_id AS id, turn AS seq, role AS "by", text, 0 AS side FROM conversations
    UNION ALL SELECT doc_id, n_chars, source, text, 1 FROM documents))
WHERE rn = 1""",
    "sync_new_rows": f"""WITH {LEDGER}
SELECT doc_id, sha256(text) AS content_hash FROM documents
WHERE sha256(text) NOT IN (SELECT content_hash FROM ledger)""",
    "sync_gap": f"""WITH {LEDGER}
SELECT count(*) AS missing FROM documents WHERE sha256(text) NOT IN (SELECT content_hash FROM ledger)""",
    "ledger_union": f"WITH {LEDGER} SELECT content_hash FROM ledger UNION SELECT sha256(text) FROM documents",
    "embed_hashed": f"""WITH {embedded('v', 'documents', 'doc_id', 'text')}
SELECT doc_id, CAST(bucket AS BIGINT) AS bucket, round(x::DOUBLE, 6) AS weight FROM v""",
    "vector_points": f"""WITH {SILVER}, {embedded('v', 'silver', 'id', 'text')}
SELECT {point_id('sha256(text)')} AS point_id, sha256(text) AS content_hash, {POINT_ROWS},
  (SELECT count(*) FROM v WHERE v.id = silver.id) AS non_zero, 1.0::DOUBLE AS norm
FROM silver""",
    "vector_upsert": f"""WITH docs AS (SELECT text, 'document' AS title, doc_id AS id, source AS "by", n_chars AS time FROM documents),
talk AS (SELECT text, 'conversation' AS title, conv_id AS id, role AS "by", turn AS time FROM conversations),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY side, time DESC, id DESC, title DESC) AS rn
  FROM (SELECT *, 0 AS side FROM docs UNION ALL SELECT *, 1 FROM talk)),
kept AS (SELECT text, title, id, "by", time FROM ranked WHERE rn = 1),
{embedded('v', 'kept', 'text', 'text')}
SELECT {point_id('sha256(text)')} AS point_id, sha256(text) AS content_hash, text, title, id, "by", time,
  (SELECT count(*) FROM v WHERE v.text = kept.text) AS non_zero
FROM kept""",
    "bm25_doc_stats": f"WITH {INDEX} SELECT n_docs, total_len, round(avgdl, 6) AS avgdl FROM stats",
    "bm25_idf": f"WITH {INDEX} SELECT term, df, round(idf, 6) AS idf FROM idf",
    "bm25_postings": f"WITH {INDEX} SELECT doc, dl, term, tf FROM post JOIN len USING (doc)",
    "bm25_scores": f"WITH {SCORES} SELECT query_id, doc, round(score, 6) AS score FROM scores",
    "bm25_topk": f"WITH {KEYWORD} SELECT query_id, doc, round(score, 6) AS score, rank FROM keyword",
    "dense_topk": """WITH parts AS (
  SELECT label, vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
mean AS (SELECT label, pos, avg(x) AS x FROM parts GROUP BY ALL),
dot AS (SELECT m.label AS query_id, p.vec_id AS doc,
    sum(m.x * p.x) / (sqrt(sum(m.x * m.x)) * sqrt(sum(p.x * p.x))) AS score
  FROM parts p JOIN mean m USING (pos) GROUP BY ALL)
SELECT CAST(query_id AS BIGINT) AS query_id, doc, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc) AS rank FROM dot)
WHERE rank <= 20""",
    "dense_groundedness": f"""WITH {SILVER}, {QUERIES}, {DENSE_PARTS}
SELECT query_id, rank, text, CAST(NULL AS VARCHAR) AS wiki, round(near.score, 4) AS cosine_score, near.score >= 0.5 AS grounded
FROM near JOIN silver ON silver.id = doc WHERE rank <= 5""",
    "rrf_fuse": f"""WITH {FUSED}
SELECT query_id, text, round(fused, 9) AS fused_score, round(dense_score, 6) AS dense_score,
  round(bm25_score, 6) AS bm25_score, dense_rank, keyword_rank, doc AS id
FROM fused JOIN silver ON silver.id = doc""",
    "dynamic_threshold": f"WITH {FUSED} SELECT query_id, pool, round(threshold, 9) AS dynamic_threshold FROM pool",
    "hybrid_search": f"WITH {HYBRID} SELECT * EXCLUDE (title) FROM hybrid",
    "display_rows": f"""WITH {HYBRID}
SELECT query_id, rank,
  coalesce(printf('%.4f', dense_score), '—') AS "Dense", coalesce(printf('%.4f', bm25_score), '—') AS "BM25",
  printf('%.5f', fused_score) AS "Fused", printf('%.5f', dynamic_threshold) AS "Threshold",
  CASE WHEN grounded THEN 'Yes' ELSE 'No' END AS "Grounded", title AS "Article Title",
  {event_details("substr(text, length(title) + 3)")} AS "Event / Edit Details", "by" AS "Author",
  CASE WHEN id <> 0 THEN concat('https://news.ycombinator.com/item?id=', id) ELSE '' END AS "Hacker News Link"
FROM hybrid""",
    "stage_depths": f"""WITH o AS ({_view(views.OFFSETS)}),
span AS (SELECT topic, partition, max("offset") - min("offset") + 1 AS n FROM o GROUP BY ALL)
SELECT CAST(coalesce(sum(n) FILTER (WHERE topic = 'raw-events-topic'), 0) AS BIGINT) AS raw,
  CAST(coalesce(sum(n) FILTER (WHERE topic = 'validated-events-topic'), 0) AS BIGINT) AS validated,
  CAST(coalesce(sum(n) FILTER (WHERE topic = 'dlq-topic'), 0) AS BIGINT) AS dlq FROM span""",
    "telemetry_snapshot": f"""WITH {EXPECTED}, {SILVER}, {STAGES}
SELECT *,
  CASE WHEN dlq_rate > 15 THEN 'bad' WHEN sync_gap > 0 THEN 'warn' ELSE 'ok' END AS health,
  CASE WHEN dlq_rate > 15 THEN printf('%.1f%% of events are rejected: look at the dead letters.', dlq_rate)
       WHEN sync_gap > 0 THEN concat(sync_gap, ' Silver rows have no vector yet.')
       ELSE concat('All well: ', bronze_rows, ' events stored and every text embedded.') END AS message
FROM snap""",
    "ingest_batch_counts": f"""WITH {LIGHT}, {SILVER}
SELECT count(*) FILTER (WHERE ok) AS valid, count(*) FILTER (WHERE NOT ok) AS dlq,
  (SELECT count(*) FROM (SELECT id FROM silver UNION SELECT id FROM judged WHERE ok)) AS silver_rows,
  (SELECT count(DISTINCT title) FROM judged WHERE ok) AS new_points
FROM judged""",
}

# The stored path gives the rows of the plans without one, but for two things. A point keeps the
# payload of the first refresh that saw its text (the earlier half of the documents came first), and equal
# similarities are settled by the point's id.
FIRST_SEEN = SILVER.removeprefix(f"{BRONZE},").replace("silver AS", "first_seen AS").replace("ORDER BY", "ORDER BY id > (SELECT avg(doc_id) FROM documents),")
POINTS = f"""points AS MATERIALIZED (
  SELECT s.id AS doc, ('0x' || substr(replace({point_id('sha256(s.text)')}, '-', ''), 1, 15))::BIGINT AS number, f.id AS first_id, f."by" AS first_by
  FROM silver s JOIN first_seen f USING (text))"""
BY_NUMBER = (
    DENSE_PARTS.replace("DESC, doc) AS rank", "DESC, number) AS rank")
    .replace("dn.doc, round(", "dn.doc, number, round(")
    .replace("CROSS JOIN dn", "CROSS JOIN (dn JOIN points USING (doc))")
)
STORED = (
    HYBRID.replace(DENSE_PARTS, f"{FIRST_SEEN}, {POINTS}, {BY_NUMBER}")
    .replace("s.id, s.\"by\", s.title", "CASE WHEN dense_rank IS NULL THEN s.id ELSE first_id END AS id, CASE WHEN dense_rank IS NULL THEN s.\"by\" ELSE first_by END AS \"by\", s.title")
    .replace("JOIN silver s ON s.id = doc", "JOIN silver s ON s.id = doc JOIN points USING (doc)")
)
ORACLE |= {
    "lake_silver": ORACLE["silver_build"],
    "lake_vectors": ORACLE["vector_points"].replace(f"{SILVER},", f"{SILVER}, {FIRST_SEEN},").replace("silver.id", "first_seen.id").replace("FROM silver", "FROM first_seen"),
    "lake_index_topk": ORACLE["bm25_topk"],
    "lake_search": ORACLE["hybrid_search"].replace(HYBRID, STORED),
    "bronze_compacted": """SELECT strftime(t, '%Y-%m-%d') AS date, strftime(t, '%H') AS hour, count(*) AS rows, 1::BIGINT AS files
FROM (SELECT make_timestamp((1704067200 + doc_id) * 1000000) AS t FROM documents) GROUP BY ALL""",
}
