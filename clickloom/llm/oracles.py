"""DuckDB SQL for the queries that SQL can express, over whole tables."""

WORD = r"[^\x20\x09-\x0D]+"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# A line goes if it lies in the shortest window of 20 characters or more that begins or ends at some line and whose
# lines stand at an earlier place.
LINE_DEDUP = r"""
WITH d AS (SELECT DISTINCT doc_id, text, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS line FROM d),
c AS (SELECT *, coalesce(sum(length(line)) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING
                         AND 1 PRECEDING), 0)::BIGINT AS before,
             sum(length(line)) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS upto FROM lines),
w AS (SELECT a.doc_id, a.i AS s, min(b.i) + 1 AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i >= a.i
          AND b.upto - a.before >= 20 GROUP BY ALL
      UNION
      SELECT a.doc_id, max(b.i) AS s, a.i + 1 AS e FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.i <= a.i
          AND a.upto - b.before >= 20 GROUP BY a.doc_id, a.i),
named AS (SELECT w.*, array_to_string(d.l[s + 1:e], chr(10)) AS body, e - s AS n FROM w JOIN d USING (doc_id)),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY body, n ORDER BY doc_id, s) AS r FROM named)
          WHERE r > 1),
gone AS (SELECT DISTINCT c.doc_id, c.i FROM c JOIN later ON c.doc_id = later.doc_id AND c.i >= s AND c.i < e),
kept AS (SELECT c.doc_id, coalesce(string_agg(line, chr(10) ORDER BY c.i) FILTER (gone.i IS NULL), '') AS text,
                count(*) AS n_lines, count(gone.i) AS n_removed
         FROM c LEFT JOIN gone ON c.doc_id = gone.doc_id AND c.i = gone.i GROUP BY c.doc_id)
SELECT doc_id, kept.text, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
FROM documents LEFT JOIN kept USING (doc_id)
"""

_GRAMS = "\n".join(f"""
g{n} AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY doc_id, body ORDER BY i) AS r FROM
    (SELECT p.doc_id, p.i, array_to_string(w[p.i:p.i + {n - 1}], ' ') AS body FROM pos p JOIN d USING (doc_id)
     WHERE p.i + {n - 1} <= len(w))) WHERE r > 1),
c{n} AS (SELECT doc_id, sum(length(word)) AS c FROM pos JOIN
    (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS i FROM g{n}) USING (doc_id, i) GROUP BY doc_id),""" for n in range(5, 11))
_SHARES = ", ".join(f"coalesce(c{n}.c, 0)::DOUBLE / greatest(word_chars, 1) AS dup_{n}gram_chars" for n in range(5, 11))
_JOINS = " ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in range(5, 11))
_LIMITS = " OR ".join(f"dup_{n}gram_chars > {limit}::DOUBLE" for n, limit in
                      {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}.items())

QUALITY_RULES = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM documents),
pos AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
base AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines,
         len(l) - len(list_distinct(l)) AS n_dup_lines FROM d),
dl AS (SELECT doc_id, sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) AS c FROM
    (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS r FROM
     (SELECT doc_id, unnest(range(len(l))) AS i, unnest(l) AS line FROM d)) WHERE r > 1 GROUP BY doc_id),
g3 AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, body) AS n FROM
    (SELECT p.doc_id, p.i, array_to_string(w[p.i:p.i + 2], ' ') AS body FROM pos p JOIN d USING (doc_id)
     WHERE p.i + 2 <= len(w))) WHERE n > 1),
r3 AS (SELECT doc_id, count(DISTINCT i) AS c FROM (SELECT doc_id, unnest(range(i, i + 3)) AS i FROM g3) GROUP BY doc_id),
{_GRAMS}
f AS (SELECT base.*, coalesce(r3.c, 0) AS n_repeat_words, coalesce(dl.c, 0)::DOUBLE / greatest(word_chars, 1)
      AS dup_line_chars, {_SHARES} FROM base LEFT JOIN r3 USING (doc_id) LEFT JOIN dl USING (doc_id) {_JOINS}),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f)
SELECT *, NOT (base_failed OR dup_line_chars > 0.2::DOUBLE OR {_LIMITS}) AS kept
FROM b
"""

JACCARD_JOIN = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE
      list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS e FROM d),
x AS (SELECT doc_id, len(e) AS n, unnest(e) AS e FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.e = b.e AND a.doc_id < b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM p UNION SELECT b, a FROM p),
reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a)
SELECT s.doc_id, len(e) AS n_shingles, least(s.doc_id, coalesce(r.m, s.doc_id)) AS component_id
FROM s LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON s.doc_id = r.a
"""

_ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATE = rf"""
WITH i AS (SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{_ITEM_WORD}') AS w FROM benchmark),
iw AS (SELECT item_id, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS j, w FROM i WHERE len(w) > 0),
windows AS (SELECT item_id, n, j, array_to_string(w[j:j + n - 1], ' ') AS body FROM iw),
d AS (SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{_ITEM_WORD}') AS w FROM documents),
places AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n),
hits AS (SELECT doc_id, item_id, windows.n, p, j FROM (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS body FROM places) x
         JOIN windows ON x.n = windows.n AND x.body = windows.body),
covered AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
          FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id),
islands AS (SELECT doc_id, item_id, n, p - j AS shift, p - row_number() OVER (PARTITION BY doc_id, item_id, n, p - j ORDER BY p) AS g
            FROM hits),
longest AS (SELECT doc_id, max(c) AS m FROM (SELECT doc_id, n + count(*) - 1 AS c FROM islands
            GROUP BY doc_id, item_id, n, shift, g) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(m, 0)::BIGINT AS longest_match
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN longest USING (doc_id)
"""

# Characters of the rendered turn: the marks, three line breaks, and the text with one more backslash per control.
CHAT_FORMAT = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                                           (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
t AS (SELECT *, length(text) + len(regexp_extract_all(text,
        '### System:|### User:|### Assistant:|### Role:|</turn>|<\|endoftext\|>')) AS shown,
      CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 9 WHEN 'assistant' THEN 14 ELSE 10 + length(role) END AS head FROM c)
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(head + shown + 10)::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""
