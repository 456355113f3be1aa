"""DuckDB SQL for the operators that SQL can state."""

from __future__ import annotations

from tablewright.llm import licenses, line_dedup, mixing

_WS = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

OP6 = f"""
WITH lines AS (
  SELECT doc_id, source, text, generate_subscripts(string_split(text, chr(10)), 1) AS pos,
         unnest(string_split(text, chr(10))) AS line
  FROM documents),
totals AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
freq AS (
  SELECT source, trim(line, ' ') AS line, count(DISTINCT doc_id) AS pages
  FROM lines WHERE trim(line, ' ') <> '' GROUP BY ALL),
boiler AS (
  SELECT f.source, f.line FROM freq f JOIN totals t ON f.source IS NOT DISTINCT FROM t.source
  WHERE f.pages >= {line_dedup.MIN_PAGES} AND f.pages > CAST({line_dedup.RATIO} AS DOUBLE) * t.total),
marked AS (
  SELECT l.*, b.line IS NOT NULL AS dropped
  FROM lines l LEFT JOIN boiler b ON l.source IS NOT DISTINCT FROM b.source AND trim(l.line, ' ') = b.line)
SELECT d.doc_id, d.source,
       CASE WHEN d.text IS NULL THEN NULL ELSE
         coalesce(string_agg(m.line, chr(10) ORDER BY m.pos) FILTER (WHERE NOT m.dropped), '') END AS text,
       CAST(count(m.pos) AS BIGINT) AS n_lines,
       CAST(count(m.pos) FILTER (WHERE m.dropped) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id
GROUP BY d.doc_id, d.source, d.text
"""

# Sources by code point, weights 5, 2, 1 repeating. Capped water-filling in
# closed form, then whole repetitions and a prefix by hash up to the rest.
OP7 = f"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(concat_ws(':', '{mixing.SEED}', doc_id, md5(coalesce(text, '')))), 1, 15) AS BIGINT) AS h
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE rk % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END AS weight,
         {mixing.MAX_EPOCHS} * size AS cap, {mixing.TOTAL_SHARE} * sum(size) OVER () AS total
  FROM s),
o AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
l AS (
  SELECT *, (SELECT level FROM o o2 WHERE level <= cap / weight ORDER BY cap / weight, rk LIMIT 1) AS fill FROM o),
t AS (
  SELECT source, size, least(cap, coalesce(fill * weight, cap)) AS target FROM l),
p AS (
  SELECT *, CASE WHEN size > 0 THEN floor(target / size) ELSE 0 END AS whole FROM t),
r AS (SELECT *, target - whole * size AS rest FROM p),
c AS (
  SELECT d.*, r.size AS source_size, r.target, r.whole, r.rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         sum(d.size) OVER (PARTITION BY d.source, d.h) AS tie
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
k AS (
  SELECT *, CAST(whole AS BIGINT) + CASE WHEN rest > 0 AND (cum <= rest OR cum - rest < rest - (cum - tie)) THEN 1 ELSE 0 END AS copies
  FROM c)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(copies AS BIGINT) AS copies, CAST(size * copies AS BIGINT) AS taken
FROM k
"""

OP8 = f"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '{_WS}', ' ', 'g') AS n FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY n) AS keep_id,
       CAST(count(*) OVER (PARTITION BY n) AS BIGINT) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY n) AS kept,
       sha256(n) AS text_sha256
FROM t
"""

# Calls and results derived as in ``queries.tool_turns``; levels by the longest
# chain of needs; canonical JSON written key by key.
OP1 = f"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, role, text, substr(md5(concat_ws(':', conv_id, turn)), 1, 12) AS own,
         substr(md5(concat_ws(':', conv_id, turn - 1)), 1, 12) AS before,
         len(regexp_extract_all(text, '{_WORD}')) AS n
  FROM conversations),
c AS (
  SELECT conv_id, own AS id, turn, n, text, role,
         CASE WHEN n % 23 = 0 THEN 'translate' WHEN n % 2 = 0 THEN 'search' ELSE 'classify' END AS tool,
         CAST(n % 11 AS DOUBLE) / 10 AS threshold
  FROM t WHERE role = 'assistant'),
a AS (
  SELECT *,
         CASE WHEN tool = 'search' THEN '{{"query":' || to_json(text) || ',"limit":' || n
              ELSE '{{"threshold":' || threshold || ',"text":' || to_json(text) || ',"labels":["a","' || role || '"]' END AS broken,
         CASE WHEN tool = 'search' THEN '{{"limit":' || n || ',"query":' || to_json(text) || '}}'
              ELSE '{{"labels":["a","' || role || '"],"text":' || to_json(text) || ',"threshold":'
                   || CASE WHEN threshold IN (0, 1) THEN CAST(CAST(threshold AS INTEGER) AS VARCHAR) ELSE CAST(threshold AS VARCHAR) END || '}}'
         END AS good
  FROM c),
needs AS (
  SELECT conv_id, id, substr(md5(concat_ws(':', conv_id, 2 * ((turn + 1) // 4) - 1)), 1, 12) AS need FROM c WHERE turn >= 3
  UNION
  SELECT conv_id, id, substr(md5(concat_ws(':', conv_id, turn - 2)), 1, 12) FROM c WHERE turn >= 3 AND turn % 3 = 0),
edges AS (SELECT n.* FROM needs n JOIN c ON c.conv_id = n.conv_id AND c.id = n.need),
walk AS (
  SELECT conv_id, id, 0 AS level FROM c
  UNION
  SELECT e.conv_id, e.id, w.level + 1 FROM edges e JOIN walk w ON w.conv_id = e.conv_id AND w.id = e.need),
levels AS (SELECT conv_id, id, max(level) AS level FROM walk GROUP BY ALL),
r AS (SELECT conv_id, before AS id, turn, text FROM t WHERE role <> 'assistant'),
m AS (
  SELECT a.conv_id, 0 AS k, a.id, l.level, a.turn AS call_turn, a.turn,
         CASE WHEN n % 19 = 0 THEN 'invalid_json' WHEN tool = 'translate' THEN 'unknown_tool'
              WHEN tool = 'search' AND n NOT BETWEEN 1 AND 250 THEN 'invalid_arguments' ELSE 'ok' END
         || CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.conv_id = a.conv_id AND r.id = a.id) THEN '' ELSE ', unanswered' END AS status,
         CASE WHEN n % 19 = 0 THEN 'JSONDecodeError' WHEN tool = 'search' AND n NOT BETWEEN 1 AND 250 THEN '$.limit: out of range' ELSE '' END AS error,
         '{{"function":{{"arguments":' || CASE WHEN n % 19 = 0 THEN CAST(to_json(broken) AS VARCHAR) ELSE good END
         || ',"name":"' || tool || '"}},"id":"' || a.id || '","role":"assistant","type":"function"}}' AS message
  FROM a JOIN levels l ON l.conv_id = a.conv_id AND l.id = a.id
  UNION ALL
  SELECT r.conv_id, 1, r.id, l.level, coalesce(c.turn, r.turn), r.turn,
         CASE WHEN c.id IS NULL THEN 'orphan' ELSE 'ok' END, '',
         '{{"content":' || to_json(r.text) || ',"role":"tool","tool_call_id":"' || r.id || '"}}'
  FROM r LEFT JOIN c ON c.conv_id = r.conv_id AND c.id = r.id LEFT JOIN levels l ON l.conv_id = r.conv_id AND l.id = r.id)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY coalesce(level, 1 << 30), call_turn, id, k, turn) - 1 AS position,
       CASE k WHEN 0 THEN 'call' ELSE 'result' END AS kind, id AS call_id, level, status, error, CAST(1 AS BIGINT) AS copies, message
FROM m
"""

OP3 = f"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM t),
g AS (
  SELECT doc_id, pos, word || ' ' || lead(word, 1) OVER d || ' ' || lead(word, 2) OVER d AS win
  FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos, win IS NOT NULL AND count(win) OVER (PARTITION BY doc_id, win) > 1 AS again FROM g),
c AS (
  SELECT doc_id, again OR coalesce(lag(again, 1) OVER d, false) OR coalesce(lag(again, 2) OVER d, false) AS inside
  FROM r WINDOW d AS (PARTITION BY doc_id ORDER BY pos)),
rep AS (SELECT doc_id, count(*) FILTER (WHERE inside) AS n FROM c GROUP BY doc_id),
facts AS (SELECT doc_id, word, count(*) AS n FROM w GROUP BY ALL),
per_word AS (
  SELECT doc_id, max(n) AS top, sum(n) FILTER (WHERE contains(word, '!!')) AS loud,
         sum(n) FILTER (WHERE regexp_matches(word, '[A-Za-z\\x{{80}}-\\x{{10FFFF}}]')) AS letters
  FROM facts GROUP BY doc_id),
ln AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
  FROM ln WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
b AS (
  SELECT t.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '{_WS}', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(l.n, 0) AS n_lines, coalesce(p.top, 0) AS top, coalesce(p.loud, 0) AS loud, coalesce(p.letters, 0) AS letters
  FROM t LEFT JOIN rep USING (doc_id) LEFT JOIN per_word p USING (doc_id) LEFT JOIN lines l USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 5 * top > 2 * n_words
            OR 10 * loud > 3 * n_words OR 2 * letters < n_words) AS kept
FROM f
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LICENSE_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_PHRASES = ", ".join(f"('{a}', string_split('{p}', ' '))" for a, p in licenses.PHRASES)
_TELLING = ", ".join(f"('{label}', '{w}')" for label, ws in licenses.TELLING.items() for w in ws)
_TEMPLATES = ", ".join(f"({i}, '{a}', '{b}')" for i, (a, b) in enumerate(licenses.TEMPLATES))

OP9 = f"""
WITH phrases(label, p) AS (VALUES {_PHRASES}),
told(label, word) AS (VALUES {_TELLING}),
templates AS (
  SELECT i, label, list_distinct(regexp_extract_all(translate(body, '{_UPPER}', '{_UPPER.lower()}'), '{_LICENSE_WORDS}')) AS tw
  FROM (VALUES {_TEMPLATES}) AS v(i, label, body)),
t AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, '{_LICENSE_WORDS}') AS ws FROM t),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(0, len(ws)), lambda i: ws[i + 1:i + len(p)] = p)) AS pos
  FROM w, phrases),
base AS (
  SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY doc_id),
lists AS (
  SELECT i, t.label, len(tw) AS size, word, (t.label, word) IN (SELECT (label, word) FROM told) AS must
  FROM templates t, unnest(tw) u(word)),
own AS (
  SELECT doc_id, i, label, size, word, must, pos
  FROM (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM w) JOIN lists USING (word)),
-- a telling word counts beside another word of the template
seen AS (
  SELECT * FROM own o
  WHERE NOT must OR EXISTS (SELECT 1 FROM own n WHERE n.doc_id = o.doc_id AND n.i = o.i AND n.pos = o.pos - 1)
                 OR EXISTS (SELECT 1 FROM own n WHERE n.doc_id = o.doc_id AND n.i = o.i AND n.pos = o.pos + 1)),
-- a run of twice the template's words from every place of one of them
runs AS (
  SELECT a.doc_id, a.i, a.pos, a.label, a.size, count(DISTINCT b.word) AS n, count(DISTINCT b.word) FILTER (WHERE b.must) AS n_must
  FROM (SELECT DISTINCT doc_id, i, pos, label, size FROM seen) a
  JOIN seen b ON a.doc_id = b.doc_id AND a.i = b.i AND b.pos >= a.pos AND b.pos < a.pos + 2 * a.size
  GROUP BY ALL),
met AS (
  SELECT doc_id, list(DISTINCT label) AS labels, max(CAST(n AS DOUBLE) / size) AS containment
  FROM runs JOIN (SELECT i, count(*) FILTER (WHERE must) AS all_must FROM lists GROUP BY i) USING (i)
  WHERE n >= ceil({licenses.THRESHOLD} * size - 1e-9) AND n_must = all_must GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       first_word, last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(containment, 0.0) END AS DOUBLE) AS score
FROM w LEFT JOIN base b USING (doc_id) LEFT JOIN met m USING (doc_id)
"""

OP12 = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS doc, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents WHERE text IS NOT NULL
), corpus AS (
  SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM d WHERE len(terms) > 0
), items AS MATERIALIZED (
  SELECT row_number() OVER () AS item, item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)
), wanted AS (
  SELECT item, term, count(*) AS times FROM (SELECT item, unnest(terms) AS term FROM items) GROUP BY ALL
), tf AS (
  SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, corpus GROUP BY term, n_docs
), impacts AS (
  SELECT doc, term,
         w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * len(terms) * n_docs) // n_terms))) AS impact
  FROM tf JOIN weights USING (term) JOIN d USING (doc), corpus
), scores AS (
  SELECT item, doc, sum(times * impact)::BIGINT AS score
  FROM wanted JOIN impacts USING (term) GROUP BY ALL HAVING sum(times * impact) > 0
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scores JOIN items USING (item) JOIN d USING (doc)
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

ORACLES = {"op1_tool_calls": OP1, "op3_quality": OP3, "op9_licenses": OP9, "op6_line_dedup": OP6, "op7_mixing": OP7,
           "op8_exact_dedup": OP8, "op12_lexical_search": OP12}
