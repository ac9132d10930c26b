"""SQL for DuckDB that gives the rows of registered queries."""

from __future__ import annotations

from lakesearch.llm.queries import MIX_SEED, N_SHARDS
from lakesearch.llm.shards import HEAVY_PARTS

# CRC-32 over a list of bytes: 256 table entries from the polynomial, then one step a byte.
CRC_TABLE = """bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS steps FROM bits WHERE k = 8
)"""


def crc32_of(t: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, 2 * strlen({t}) + 1, 2), lambda k: ('0x' || substr(hex(encode({t})), k, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, steps[xor(c, b) % 256 + 1])), 4294967295::BIGINT)"""


OP4 = f"""
WITH RECURSIVE {CRC_TABLE}, sized AS (
  SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, ''))::BIGINT + 1 AS size, md5(coalesce(text, '')) AS digest FROM documents
), grouped AS (
  SELECT digest, sum(size)::BIGINT AS n, (sum(sum(size)) OVER ())::BIGINT AS total FROM sized GROUP BY digest
), heavy AS (
  SELECT digest, n, row_number() OVER (ORDER BY n DESC, digest) AS k FROM grouped WHERE n * {N_SHARDS * HEAVY_PARTS} > total AND n * {N_SHARDS} <= total
), packed AS (
  SELECT 0::BIGINT AS k, [0::BIGINT FOR i IN range({N_SHARDS})] AS loads, -1::BIGINT AS shard
  UNION ALL
  SELECT h.k, list_transform(loads, lambda v, i: CASE WHEN i = list_position(loads, list_min(loads)) THEN v + h.n ELSE v END), list_position(loads, list_min(loads))::BIGINT - 1
  FROM packed p JOIN heavy h ON h.k = p.k + 1
), lacking AS (
  SELECT s, list_sum(loads)::HUGEINT AS load, greatest(0, total - {N_SHARDS} * loads[s + 1])::HUGEINT AS lack, total
  FROM (SELECT arg_max(loads, k) AS loads FROM packed), (SELECT any_value(total) AS total FROM grouped), range({N_SHARDS}) t(s)
), cuts AS (
  SELECT list(((2 * (total - load) * up + everything - 1) // everything)) FILTER (s > 0) AS places, any_value(load) AS load
  FROM (SELECT *, coalesce(sum(lack) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS up, greatest(1, sum(lack) OVER ())::HUGEINT AS everything FROM lacking)
), placed AS (
  SELECT doc_id, t, size, s.digest, p.shard AS block, (sum(size) OVER w)::HUGEINT - size - load AS position
  FROM sized s LEFT JOIN heavy h ON s.digest = h.digest LEFT JOIN packed p ON h.k = p.k, cuts
  WINDOW w AS (ORDER BY coalesce(p.shard, {N_SHARDS}), s.digest, doc_id ROWS UNBOUNDED PRECEDING)
), met AS (
  SELECT p.*, CASE WHEN n * {N_SHARDS} <= total THEN 2 * min(position) OVER (PARTITION BY p.digest) + n ELSE 2 * position + size END AS middle
  FROM placed p JOIN grouped g ON p.digest = g.digest
), cut AS (
  SELECT m.*, coalesce(block, len([c FOR c IN places IF c <= middle]))::INT AS shard FROM met m, cuts
)
SELECT doc_id, size,
  {crc32_of("t")} AS text_crc32,
  'bytes' AS law, shard, row_number() OVER (PARTITION BY shard ORDER BY block IS NULL, digest, doc_id) - 1 AS slot, NULL::INT AS grown_shard
FROM cut, crc
"""

OP10 = f"""
WITH RECURSIVE counts AS (
  SELECT coalesce(source, '') AS name, count(*) AS n FROM documents GROUP BY 1
), rates AS (
  SELECT name, 1.0::DOUBLE / (SELECT count(*) FROM counts)::DOUBLE * (SELECT sum(n) FROM counts)::DOUBLE / n AS rate FROM counts
), drawn AS (
  SELECT name, rate, greatest(ceil(rate / 16), 1)::INT AS draws FROM rates
), terms AS (
  SELECT name, draws, rate / draws AS r, 0 AS k, exp(-(rate / draws)) AS p, exp(-(rate / draws)) AS f FROM drawn
  UNION ALL
  SELECT name, draws, r, k + 1, p * r / (k + 1), f + p * r / (k + 1) FROM terms WHERE k < 80
), cdf AS (
  SELECT name, any_value(draws) AS draws, list(f ORDER BY k) AS f FROM terms GROUP BY name
), counted AS (
  SELECT d.*, list_sum([len([x FOR x IN f IF x <= ('0x' || substr(md5('{MIX_SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, '')) || '|' || number::VARCHAR || '|' || i::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE])
    FOR i IN range(1, draws + 1)])::INT AS n_copies
  FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, text, lang, source, n_chars) AS number FROM documents) d JOIN cdf ON coalesce(d.source, '') = cdf.name
)
SELECT doc_id, text, lang, source, n_chars, n_copies, unnest(range(1, n_copies + 1))::INT AS copy FROM counted WHERE n_copies > 0
"""

OP11 = r"""
WITH RECURSIVE orders AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || f FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE NOT contains(o, f)
), steps AS (
  SELECT o AS filter_order, s::INT AS step, o[s] AS f, o[1:s - 1] AS earlier FROM orders, range(1, 6) t(s) WHERE length(o) = 5
), texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least FROM documents
), words AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts
), failed AS (
  SELECT doc_id, part, (CASE WHEN len(w) < 100 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END) || (CASE WHEN least < doc_id THEN 'E' ELSE '' END) AS fails
  FROM words
), marked AS (
  SELECT *, EXISTS (FROM labels l WHERE l.doc_id = failed.doc_id AND quality = 1) AS good, EXISTS (FROM labels l WHERE l.doc_id = failed.doc_id AND toxic = 1) AS toxic FROM failed
), alike AS (
  SELECT part, fails, good, toxic, count(*) AS n FROM marked GROUP BY ALL
), judged AS (
  SELECT *, contains(fails, f) AS here, length(regexp_replace(fails, '[' || earlier || '0]', '', 'g')) < length(fails) AS gone FROM alike, steps
), stepped AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT here AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (here AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (here AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (fails = f), 0)::BIGINT AS unique_fails, coalesce(sum(n) FILTER (here AND NOT gone AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (here AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
  FROM judged GROUP BY ALL
)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM stepped
"""



def _inserted(ways: str) -> str:
    return f"""list_transform({ways}, lambda x: {{'p': CASE WHEN x.p = 2 THEN 3 ELSE 2 END, 'c': x.c + 2, 'a': x.a || 'I',
      't': list_append(x.t, CASE WHEN x.p = 2 THEN 'assistant:' ELSE 'user:' END)}})"""


# Row by row, the least (cost, audit) way to each state (0 nothing, 1 system, 2 user, 3 assistant) with the rows it writes.
OP13 = rf"""
WITH RECURSIVE {CRC_TABLE}, named AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), hit AS (
  SELECT n.*, {crc32_of("name")} % 20 AS d FROM named n, crc
), damaged AS (
  SELECT k, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE d WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS again
  FROM hit
), numbered AS (
  SELECT *, left(role, 1) AS f, row_number() OVER w AS i
  FROM damaged WINDOW w AS (PARTITION BY k ORDER BY turn NULLS FIRST, role, left(text, 64), md5(text))
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 'truncated' ELSE '' END AS fault,
    lag(f) OVER (PARTITION BY k ORDER BY i) || f AS pair
  FROM (SELECT *, row_number() OVER (PARTITION BY k, role, text ORDER BY i) AS seen FROM numbered)
), steps AS (
  SELECT k, 0::BIGINT AS i, [{{'p': 0, 'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}}] AS ways FROM (SELECT DISTINCT k FROM judged)
  UNION ALL
  SELECT k, i, list_filter(sorted, lambda x, j: j = 1 OR sorted[j - 1].p <> x.p) FROM (
    SELECT k, i, list_sort(list_concat(
      list_transform(open, lambda x: {{'p': x.p, 'c': x.c + 3, 'a': x.a || 'D', 't': x.t}}),
      list_transform(list_filter(open, lambda x: stays AND CASE f WHEN 's' THEN x.p = 0 WHEN 'u' THEN x.p <> 2 WHEN 'a' THEN x.p = 2 ELSE false END),
        lambda x: {{'p': CASE f WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, 'c': x.c + more, 'a': x.a || 'K', 't': list_append(x.t, role || ':' || text)}}),
      list_transform(list_filter(open, lambda x: stays), lambda x: {{'p': CASE WHEN x.p = 2 THEN 3 ELSE 2 END, 'c': x.c + 2 + more, 'a': x.a || 'R',
        't': list_append(x.t, CASE WHEN x.p = 2 THEN 'assistant:' ELSE 'user:' END || text)}}))) AS sorted
    FROM (
      SELECT r.k, r.i, r.role, r.text, r.f, r.fault NOT IN ('blank', 'duplicate') AS stays, CASE r.fault WHEN 'truncated' THEN 1 ELSE 0 END AS more,
        list_concat(ways, {_inserted("ways")}, {_inserted(_inserted("ways"))}) AS open
      FROM steps s JOIN judged r ON r.k = s.k AND r.i = s.i + 1))
), ends AS (
  SELECT k, list_sort(list_transform(list_filter(list_concat(ways, {_inserted("ways")}, {_inserted(_inserted("ways"))}), lambda x: x.p IN (0, 3)),
    lambda x: {{'c': x.c, 'a': x.a, 't': x.t}}))[1] AS best
  FROM steps QUALIFY i = max(i) OVER (PARTITION BY k)
), counts AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY k
)
SELECT DISTINCT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
  sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM named LEFT JOIN counts USING (k) LEFT JOIN ends USING (k)
"""

ORACLE: dict[str, str] = {"op4_byte_shards": OP4, "op10_poisson_mix": OP10, "op11_filter_audit": OP11, "op13_conversation_repair": OP13}
