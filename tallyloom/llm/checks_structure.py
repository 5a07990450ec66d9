"""SQL that gives the rows of the queries on languages, hard negatives and conversations on DuckDB."""

from __future__ import annotations

from tallyloom.llm import language

# CRC-32 by its table of 256 steps; `crc` reads an expression whose characters are ASCII.
CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS steps)"""


def crc(of: str) -> str:
    chars = f"list_transform(string_split({of}, ''), lambda x: unicode(x)::BIGINT)"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {chars}), lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)))"


LANGUAGE = rf"""
WITH {CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce({crc("doc_id::VARCHAR")} % 3 = 1, false) AS held_out,
    string_split(' ' || trim(regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}]+', ' ', 'g')) || ' ', '') AS c
  FROM documents, crc_table),
spots AS (SELECT rid, c, unnest(range(1, len(c) + 1)) AS i FROM d),
grams AS (
  SELECT rid, c[i] AS g FROM spots WHERE c[i] <> ' '
  UNION ALL SELECT rid, c[i] || c[i + 1] FROM spots WHERE i < len(c) AND NOT (c[i] = ' ' AND c[i + 1] = ' ')
  UNION ALL SELECT rid, c[i] || c[i + 1] || c[i + 2] FROM spots WHERE i < len(c) - 1 AND c[i + 1] <> ' '),
times AS (SELECT rid, g, count(*) AS n FROM grams GROUP BY ALL),
own AS (SELECT rid, g, row_number() OVER (PARTITION BY rid ORDER BY n DESC, length(g), g) - 1 AS place FROM times QUALIFY place < {language.PROFILE}),
learned AS (SELECT lang, g, sum(n) AS n FROM times JOIN d USING (rid) WHERE lang IS NOT NULL AND NOT held_out GROUP BY ALL),
profile AS (SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY n DESC, length(g), g) - 1 AS place FROM learned QUALIFY place < {language.PROFILE}),
far AS (
  SELECT rid, l.lang, sum(coalesce(abs(own.place - profile.place), {language.PROFILE}))::BIGINT AS distance, count(*) * {language.PROFILE} AS most
  FROM own CROSS JOIN (SELECT DISTINCT lang FROM profile) l LEFT JOIN profile ON profile.lang = l.lang AND profile.g = own.g GROUP BY ALL),
best AS (SELECT * FROM far QUALIFY row_number() OVER (PARTITION BY rid ORDER BY distance, lang) = 1)
SELECT doc_id, held_out, coalesce(best.lang, '{language.UNKNOWN}') AS lang_pred, coalesce(1 - distance / most, 0.0) AS score FROM d LEFT JOIN best USING (rid)"""

NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, r.rid AS other, r.vec_id AS other_id, a.label = r.label AS alike, list_inner_product(a.w, r.w)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 50 = 0),
positives AS (SELECT * FROM scored WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) <= 5),
fit AS (
  SELECT p.anchor, p.anchor_id, p.other AS positive, p.other_id AS positive_id, p.score AS positive_score, n.other_id AS negative_id, n.score AS negative_score
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.alike AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor, positive ORDER BY negative_score DESC, negative_id)::INTEGER AS rank, negative_id, positive_score, negative_score
FROM fit QUALIFY rank <= 3"""

# States: nothing yet, s, u, a. Edits of a row, and insertions before it, lead from one to another.
CONVERSATIONS = rf"""
WITH RECURSIVE {CRC_TABLE},
source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM source, (VALUES (0), (1)) AS copies(c) WHERE kind <> 0 AND (c = 0 OR kind = 3)),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM damaged),
marked AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*\z') AS cut
  FROM placed),
rows_ AS (
  SELECT conv_id, turn, role, text, i, blank, NOT blank AND again AS twice, NOT blank AND NOT again AND cut AS cut,
    coalesce(left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM marked),
inserts(q, r, cost, audit, put) AS (
  VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 2, 'I', chr(10) || 'user:'), (1, 2, 2, 'I', chr(10) || 'user:'), (3, 2, 2, 'I', chr(10) || 'user:'),
    (2, 3, 2, 'I', chr(10) || 'assistant:'), (0, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), (1, 3, 4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')),
edits(q, r, cost, audit, initial) AS (
  VALUES (0, 0, 3, 'D', ''), (1, 1, 3, 'D', ''), (2, 2, 3, 'D', ''), (3, 3, 3, 'D', ''), (0, 2, 2, 'R', ''), (1, 2, 2, 'R', ''), (3, 2, 2, 'R', ''), (2, 3, 2, 'R', ''),
    (0, 1, 0, 'K', 's'), (0, 2, 0, 'K', 'u'), (1, 2, 0, 'K', 'u'), (3, 2, 0, 'K', 'u'), (2, 3, 0, 'K', 'a')),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS q, {{'cost': 0::BIGINT, 'audit': '', 'put': ''}} AS best FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT s.conv_id, d.i, e.r, min({{'cost': s.best.cost + n.cost + e.cost + CASE WHEN d.cut AND e.audit <> 'D' THEN 1 ELSE 0 END, 'audit': s.best.audit || n.audit || e.audit,
    'put': s.best.put || n.put || CASE e.audit WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || d.role || ':' || d.text ELSE chr(10) || CASE e.r WHEN 2 THEN 'user' ELSE 'assistant' END || ':' || d.text END}})
  FROM steps s JOIN rows_ d ON d.conv_id IS NOT DISTINCT FROM s.conv_id AND d.i = s.i + 1 JOIN inserts n ON n.q = s.q
    JOIN edits e ON e.q = n.r AND (e.audit = 'D' OR NOT d.blank AND NOT d.twice AND (e.audit = 'R' OR e.initial = left(d.role, 1)))
  GROUP BY s.conv_id, d.i, e.r),
ends AS (
  SELECT conv_id, min({{'cost': best.cost + n.cost, 'audit': best.audit || n.audit, 'put': best.put || n.put}}) AS best
  FROM steps JOIN inserts n USING (q) WHERE n.r IN (0, 3) AND i = (SELECT count(*) FROM rows_ WHERE rows_.conv_id IS NOT DISTINCT FROM steps.conv_id) GROUP BY conv_id),
faults AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (twice) AS duplicate,
    count(*) FILTER (cut) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM rows_ GROUP BY conv_id)
SELECT ends.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  best.cost AS cost, best.audit AS audit, sha256(substr(best.put, 2)) AS repaired_sha256
FROM ends LEFT JOIN faults ON faults.conv_id IS NOT DISTINCT FROM ends.conv_id"""
