"""SQL that gives the rows of the text queries on DuckDB, where SQL can."""

from __future__ import annotations

import string

from tallyloom.llm import decontaminate, quality_rules, secrets

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x20\x09-\x0D]+')"


def _only(members: str) -> str:
    return f"length(regexp_replace(t, '[^{members}]', '', 'g'))"


def _ratio(rule: str) -> str:
    top, below, _ = quality_rules.RULES[rule]
    return f"CASE WHEN {below} > 0 THEN {top} * 1000 // {below} ELSE 0 END"


def _fences(name: str, keys: str) -> str:
    sep = f"{keys}, " if keys else ""
    return f"""
{name}_merged AS (SELECT {sep}rule, bucket, sum(n)::BIGINT AS n FROM sketch GROUP BY ALL),
{name}_ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY {sep}rule ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {sep}rule) AS total,
    ((bucket - greatest(bucket // 32 - 1, 0) * 32 + 1) << greatest(bucket // 32 - 1, 0)) - 1 AS top
  FROM {name}_merged),
{name} AS (
  SELECT {sep}rule, max(total) AS total,
    min(top) FILTER (upto * 4 >= total * 3) + {quality_rules.FENCE} * (min(top) FILTER (upto * 4 >= total * 3) - min(top) FILTER (upto * 4 >= total)) + any_value(slack) AS fence
  FROM {name}_ranked JOIN slacks USING (rule) GROUP BY ALL)"""


_VALUES = " UNION ALL ".join(f"SELECT lang, source, '{r}' AS rule, {_ratio(r)} AS value FROM counted WHERE NOT base_failed" for r in quality_rules.RULES)
_SLACKS = ", ".join(f"('{r}', {s})" for r, (_, _, s) in quality_rules.RULES.items())
_BROKEN = ", ".join(f"CASE WHEN ({_ratio(r)}) > limits['{r}'] THEN '{r}' END" for r in quality_rules.RULES)

QUALITY = rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t, {WORDS} AS ws FROM documents),
lined AS (SELECT rid, [l for l in string_split(t, chr(10)) if regexp_matches(l, '[^\x20\x09-\x0D]')] AS lines FROM w),
grams AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
twice AS (SELECT rid, g FROM grams GROUP BY ALL HAVING count(*) > 1),
covered AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 5)) AS p FROM grams SEMI JOIN twice USING (rid, g)) GROUP BY rid),
counted AS (
  SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in ws]), 0)::BIGINT AS word_chars, {_only("#*$%&|<>")} AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, {_only("A-Z")} AS n_upper, {_only("!")} AS n_exclaim,
    (len(ws) < 10 OR 100 * coalesce(covered.n, 0) > 20 * len(ws)) AS base_failed
  FROM w JOIN lined USING (rid) LEFT JOIN covered USING (rid)),
cells AS ({_VALUES}),
sketch AS (SELECT lang, source, rule, p * 32 + (value >> p) AS bucket, count(*) AS n FROM (SELECT *, greatest(length(bin(value::BIGINT)) - 6, 0) AS p FROM cells) GROUP BY ALL),
slacks AS (SELECT * FROM (VALUES {_SLACKS}) AS s(rule, slack)),
{_fences("own", "lang, source")}, {_fences("by_lang", "lang")}, {_fences("by_all", "")},
groups AS (
  SELECT own.lang, own.source, map_from_entries(list((own.rule, CASE WHEN own.total >= {quality_rules.MIN_ROWS} THEN own.fence WHEN by_lang.total >= {quality_rules.MIN_ROWS} THEN by_lang.fence ELSE by_all.fence END))) AS limits
  FROM own JOIN by_lang ON own.lang IS NOT DISTINCT FROM by_lang.lang AND own.rule = by_lang.rule JOIN by_all ON own.rule = by_all.rule GROUP BY ALL),
judged AS (SELECT counted.*, concat_ws(',', {_BROKEN}) AS broken_rules FROM counted LEFT JOIN groups ON counted.lang IS NOT DISTINCT FROM groups.lang AND counted.source IS NOT DISTINCT FROM groups.source)
SELECT *, NOT base_failed AND broken_rules = '' AS kept FROM judged"""

NEAR = f"""
WITH RECURSIVE w AS (SELECT DISTINCT doc_id, {LOWER_WORDS} AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
sized AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM sh x JOIN sh y USING (s) WHERE x.doc_id <> y.doc_id GROUP BY ALL)
  JOIN sized sa ON sa.doc_id = a JOIN sized sb ON sb.doc_id = b WHERE 100 * common >= 80 * (sa.n + sb.n - common)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM sized UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id, d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM documents d LEFT JOIN sized ON sized.doc_id = d.doc_id LEFT JOIN least ON least.doc_id = d.doc_id"""

PASSAGES = f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS ws FROM documents),
windows AS (SELECT rid, doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
firsts AS (SELECT g, min(doc_id) AS low FROM windows GROUP BY g),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (g) WHERE low < doc_id),
placed AS (SELECT rid, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM placed ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, len(ws)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (rid)"""

LEAKS = f"""
WITH shingle AS (
  SELECT kind, id, i - 1 AS pos, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT kind, id, ws, unnest(range(1, len(ws) - 3)) AS i FROM (
    SELECT 'd' AS kind, doc_id AS id, {LOWER_WORDS} AS ws FROM documents UNION ALL SELECT 'b', item_id, {LOWER_WORDS} FROM benchmark) WHERE id IS NOT NULL)),
docs AS (SELECT id AS doc_id, pos, s FROM shingle WHERE kind = 'd'), items AS (SELECT id AS item_id, s FROM shingle WHERE kind = 'b'),
longs AS (SELECT doc_id, count(*) AS len FROM docs GROUP BY ALL), sizes AS (SELECT item_id, count(*) AS m FROM items GROUP BY ALL),
bags AS (SELECT item_id, s, count(*) AS times FROM items GROUP BY ALL),
hits AS (SELECT DISTINCT doc_id, item_id, pos FROM docs JOIN bags USING (s)),
starts AS (
  SELECT DISTINCT doc_id, item_id, m, len, unnest(range(least(greatest(pos - m + 1, 0), greatest(len - m, 0)), least(pos, greatest(len - m, 0)) + 1)) AS start
  FROM hits JOIN sizes USING (item_id) JOIN longs USING (doc_id)),
parts AS (
  SELECT starts.doc_id, item_id, start, m, least(m, len) AS held, docs.s, count(*) AS times
  FROM starts JOIN docs ON docs.doc_id = starts.doc_id AND docs.pos >= start AND docs.pos < start + m GROUP BY ALL),
scored AS (SELECT doc_id, item_id, start, sum(least(parts.times, bags.times))::BIGINT AS common, any_value(held + m) AS every FROM parts JOIN bags USING (item_id, s) GROUP BY ALL),
alike AS (SELECT doc_id, item_id, start, common / (every - common) AS similarity FROM scored WHERE 100 * common >= {decontaminate.PERCENT} * (every - common))
SELECT doc_id, item_id, count(*) AS n_windows, arg_max(start, row(similarity, -start)) AS start_word, max(similarity) AS similarity FROM alike GROUP BY ALL"""


def _found(kind: str) -> str:
    pattern, group, least = (secrets.BASE | secrets.ADDED)[kind]
    quoted = pattern.replace("'", "''")
    return f"""
SELECT rid, doc_id, owner, '{kind}' AS kind, {secrets.KINDS.index(kind)} AS rank, values_[k] AS value, from_ AS start, from_ + length(whole[k]) AS stop
FROM (SELECT *, (list_sum([length(x) for x in gaps[1:k]]) + coalesce(list_sum([length(x) for x in whole[1:k - 1]]), 0))::BIGINT AS from_
  FROM (SELECT *, unnest(range(1, len(whole) + 1)) AS k
    FROM (SELECT rid, doc_id, owner, regexp_extract_all(t, '{quoted}') AS whole, regexp_extract_all(t, '{quoted}', {group}) AS values_, regexp_split_to_array(t, '{quoted}') AS gaps FROM d WHERE regexp_matches(t, '{quoted}'))))
WHERE length(values_[k]) >= {least}"""


SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS owner, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(map(_found, secrets.KINDS))}),
owners AS (
  SELECT value, count(*) AS n_owners, sum(repos) AS n_repos
  FROM (SELECT value, owner, count(*) AS repos FROM (SELECT DISTINCT value, owner, doc_id FROM found) GROUP BY ALL) GROUP BY value),
judged AS (
  SELECT found.*, rank < {len(secrets.BASE)} AS base, value = '' OR n_owners <= {secrets.MAX_OWNERS} AND n_repos <= {secrets.MAX_REPOS} AS live FROM found JOIN owners USING (value)),
spans AS (
  SELECT rid, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.BASE)},
    count(*) FILTER (base AND live) AS n_live, count(*) FILTER (base AND NOT live) AS n_copied,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) FILTER (base) AS base_spans,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) FILTER (base OR live) AS spans
  FROM judged GROUP BY rid)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE)}, coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN spans USING (rid)"""
