"""DuckDB twins of the operators that SQL can express."""

#: Runs of white space as a character class, and A-Z lower-cased and nothing else.
_SPACES = r"[ \t\n\x0B\f\r]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
pos AS (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM d WHERE length(x) >= 100),
win AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 100)) AS w FROM pos),
least AS (SELECT w, min(doc_id) AS m FROM win GROUP BY w),
hit AS (SELECT doc_id, i FROM win JOIN least USING (w) WHERE doc_id > m),
edge AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, TRUE) AS new FROM hit),
runs AS (SELECT doc_id, i, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM edge),
span AS (SELECT doc_id, r, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY ALL),
prev AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS p FROM span),
kept AS (
  SELECT doc_id, string_agg(substr(x, 2 * p + 1, 2 * (a - p)), '' ORDER BY a) AS head, max(b) AS last, sum(b - a) AS gone, count(*) AS n
  FROM prev JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP3 = rf"""
WITH rules(rule, v) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')),
u AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, url, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
c AS (SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html)?/*$', '') AS canonical FROM p),
listed AS (SELECT DISTINCT canonical FROM c WHERE host <> '' AND contains(url, 'utm_source=')),
fit AS (
  SELECT host, path, rule, v, row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule) AS n
  FROM (SELECT DISTINCT host, path FROM c) JOIN rules
  ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, instr(rule, '/')))),
best AS (SELECT * FROM fit WHERE n = 1)
SELECT page_id, c.host, c.path, rule,
       coalesce(v, CASE WHEN c.host <> '' AND l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       (c.host <> '' AND l.canonical IS NOT NULL) AS listed
FROM c LEFT JOIN best b ON c.host = b.host AND c.path = b.path LEFT JOIN listed l ON c.canonical = l.canonical
"""

OP4 = rf"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, source, text, regexp_extract_all(text, '[^ \t\n\x0B\f\r]+') AS words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM t),
tri AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) >= 3),
win AS (SELECT doc_id, i, list_slice(words, i, i + 2) AS g FROM tri),
again AS (SELECT doc_id, g FROM win GROUP BY ALL HAVING count(*) > 1),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM win JOIN again USING (doc_id, g)) GROUP BY doc_id),
counts AS (
  SELECT w.doc_id, source, len(words)::BIGINT AS n_words, length(regexp_replace(text, '[ \t\n\x0B\f\r]', '', 'g'))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(hit.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN hit ON w.doc_id = hit.doc_id),
f AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM counts),
h AS (SELECT source, count(*) AS docs, count(*) FILTER (WHERE base_failed) AS failed, count(*) FILTER (WHERE base_failed) / count(*) AS rate FROM f GROUP BY source),
p AS (SELECT sum(failed) / sum(docs) AS p, sum(docs) AS n, count(*) AS k FROM h),
-- What the hosts' rates vary by, and what sampling alone and full correlation within hosts would give.
q AS (SELECT any_value(p) AS p, any_value(n) AS n, sum(docs * (rate - p) ^ 2) / nullif(any_value(p * (1 - p)), 0) AS seen,
             sum(1 - docs / n) AS alone, sum(docs - docs * docs / n) AS full_, sum((docs / n) ^ 2) AS same FROM h, p),
e AS (SELECT p, seen * (1 - 1 / n) - alone AS more, full_ - alone + seen * (same - 1 / n) AS room FROM q),
r AS (SELECT p, CASE WHEN room > 1e-9 THEN least(1.0, greatest(0.0, more / room)) ELSE 0.0 END AS r FROM e),
s AS (SELECT source, (failed * r + p * (1 - r)) / (docs * r + 1 - r) AS shrunk_rate FROM h, r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (NOT base_failed AND shrunk_rate <= 0.5) AS kept, round(shrunk_rate, 9) AS shrunk_rate
FROM f JOIN s ON f.source IS NOT DISTINCT FROM s.source
"""

OP5 = rf"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS x FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last, row_number() OVER (PARTITION BY html, page_id ORDER BY url) AS copy, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM p),
k AS (SELECT *, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
bits AS (SELECT *, list_transform(range(1, 9), lambda g: ('0x' || substr(x, (5 * (g - 1) + 1)::INT, 5))::BIGINT) AS v FROM k),
o AS (SELECT page_id, payload_bytes,
       array_to_string(list_transform(v, lambda n: array_to_string(list_transform([15, 10, 5, 0], lambda s:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((n >> s) & 31) + 1)::INT, 1)), '')), '') AS payload_digest,
       CASE WHEN last IS NULL OR (page_id = last AND copy = 1) THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last OR copy > 1 OR page_id IS NULL THEN last END AS refers_to,
       CASE WHEN host = '' THEN '' ELSE array_to_string(list_reverse(string_split(host, '.')), ',') || ')' || path END AS urlkey,
       (1700000000 + (coalesce(page_id, 0) % 2147483648 + 2147483648) % 2147483648)::BIGINT AS captured FROM bits)
SELECT *, row_number() OVER (ORDER BY urlkey, captured, page_id NULLS FIRST) - 1 AS position FROM o
"""

OP8 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^ \t\n\x0B\f\r]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(list_slice(words, i, i + 3), ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(d, c) AS (SELECT a, a FROM both_ways UNION SELECT reach.d, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.c),
comp AS (SELECT d, min(c) AS c FROM reach GROUP BY d)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(c, w.doc_id) AS component_id, coalesce(c, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN comp ON comp.d = w.doc_id
"""

OP10 = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
bm AS (SELECT item_id, words, least(len(words), 10) AS m FROM b WHERE len(words) > 0),
bw AS (SELECT DISTINCT item_id, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: array_to_string(list_slice(words, i, i + m - 1), ' '))) AS g FROM bm),
dp AS (SELECT doc_id, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bw) WHERE len(words) >= m),
hit AS (SELECT doc_id, i, x.m, item_id FROM (SELECT doc_id, i, m, array_to_string(list_slice(words, i, i + m - 1), ' ') AS g FROM dp) x JOIN bw USING (m, g)),
n AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN ids ON ids.doc_id = d.doc_id
"""

OP11 = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS c, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, c)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM o WHERE rank <= 10
"""

# The cheapest edits forward: of each conversation, row and state the least (cost, initials).
# The key's CRC-32 bit by bit; more than one inserted row before a row is never cheapest.
OP12 = rf"""
WITH RECURSIVE k AS (
  SELECT *, string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS k FROM conversations),
h AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(k, lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1)))) % 20 AS h FROM k),
d AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
         unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM h WHERE h <> 0),
o AS (SELECT conv_id, turn, role, text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text))::INT AS i FROM d),
f AS (
  SELECT *, left(role, 1) AS c, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair,
    CASE WHEN NOT regexp_matches(text, '[^ 	

]') THEN 'b'
         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
         WHEN regexp_extract(text, '([^ 	

]){_SPACES}*$', 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM o),
one(s, e, c, t, cost) AS (VALUES (0, 'K', 's', 1, 0), (0, 'K', 'u', 2, 0), (1, 'K', 'u', 2, 0), (3, 'K', 'u', 2, 0), (2, 'K', 'a', 3, 0),
  (0, 'R', NULL, 2, 2), (1, 'R', NULL, 2, 2), (2, 'R', NULL, 3, 2), (3, 'R', NULL, 2, 2),
  (0, 'D', NULL, 0, 3), (1, 'D', NULL, 1, 3), (2, 'D', NULL, 2, 3), (3, 'D', NULL, 3, 3)),
ins(s, t, x) AS (VALUES (0, 2, 'user:'), (1, 2, 'user:'), (2, 3, 'assistant:'), (3, 2, 'user:')),
moves AS (SELECT s, e, e AS last, c, t, cost, []::VARCHAR[] AS x FROM one
  UNION ALL SELECT ins.s, 'I' || e, e, c, one.t, 2 + cost, [x] FROM ins JOIN one ON one.s = ins.t),
walk(conv_id, i, s, best) AS (
  SELECT DISTINCT conv_id, 0, 0, {{'cost': 0, 'audit': '', 'x': []::VARCHAR[]}} FROM f
  UNION ALL
  SELECT w.conv_id, w.i + 1, m.t, min({{'cost': w.best.cost + m.cost + (fault = 't' AND last <> 'D')::INT, 'audit': w.best.audit || e,
    'x': list_concat(w.best.x, m.x, CASE last WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
                                    ELSE [CASE m.t WHEN 2 THEN 'user:' ELSE 'assistant:' END || f.text] END)}})
  FROM walk w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
  JOIN moves m ON m.s = w.s AND (m.c IS NULL OR m.c = f.c) AND (last = 'D' OR fault NOT IN ('b', 'd'))
  GROUP BY ALL),
tail(s, cost, e, x) AS (VALUES (0, 0, '', []::VARCHAR[]), (1, 4, 'II', ['user:', 'assistant:']), (2, 2, 'I', ['assistant:']), (3, 0, '', [])),
n AS (
  SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
done AS (
  SELECT w.conv_id, min({{'cost': w.best.cost + tail.cost, 'audit': w.best.audit || e, 'x': list_concat(w.best.x, tail.x)}}) AS best
  FROM walk w JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND n.n = w.i JOIN tail USING (s) GROUP BY w.conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.x, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM a.conv_id
"""

ORACLE = {
    "op1_repeats": OP1,
    "op3_url_filter": OP3,
    "op4_quality_rules": OP4,
    "op5_warc": OP5,
    "op8_near_duplicates": OP8,
    "op10_decontaminate": OP10,
    "op11_top_k": OP11,
    "op12_conversation_repair": OP12,
}
