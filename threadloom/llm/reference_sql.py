"""DuckDB statements for the results of queries that SQL can express; limits are written out again, not imported."""

from __future__ import annotations

_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUALITY_RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), counted AS (
  SELECT doc_id, w, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS adjacent
  FROM d
), lines AS (
  SELECT doc_id, line, count(*) AS n,
         list_sum(list_transform({_WORDS.format(text="line")}, lambda x: length(x))) AS chars
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL
), doubled AS (
  SELECT doc_id, sum(n - 1)::BIGINT AS n_dup_lines, sum((n - 1) * chars)::BIGINT AS dup_chars FROM lines GROUP BY doc_id
), grams AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT unnest(range(5, 11)) AS n))
), repeated AS (
  SELECT doc_id, n, i, count(*) OVER same AS copies, row_number() OVER (same ORDER BY i) AS copy
  FROM grams WINDOW same AS (PARTITION BY doc_id, n, gram)
), inside AS (
  SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS pos, later
  FROM (SELECT doc_id, n, i, false AS later FROM repeated WHERE copies > 1 AND n = 8
        UNION ALL SELECT doc_id, n, i, true FROM repeated WHERE copy > 1)
), covered AS (
  SELECT doc_id, n, later, count(*) AS words, sum(length(w[pos])) AS chars FROM inside JOIN d USING (doc_id) GROUP BY ALL
), limits(n, most) AS (VALUES (5, 0.35::DOUBLE), (6, 0.32), (7, 0.30), (8, 0.28), (9, 0.26), (10, 0.25)
), judged AS (
  SELECT c.doc_id, n_words, word_chars, n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce((SELECT words FROM covered v WHERE v.doc_id = c.doc_id AND NOT v.later), 0) AS n_repeat_words,
         coalesce(dup_chars, 0) AS dup_chars, adjacent,
         EXISTS (SELECT 1 FROM covered v JOIN limits USING (n)
                 WHERE v.doc_id = c.doc_id AND v.later AND v.chars::DOUBLE / word_chars > most) AS over
  FROM counted c LEFT JOIN doubled USING (doc_id)
), based AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM judged)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       base_failed,
       NOT base_failed AND NOT over AND dup_chars::DOUBLE / word_chars <= 0.30::DOUBLE
         AND n_symbols::DOUBLE / n_words <= 0.10::DOUBLE AND adjacent::DOUBLE / n_words <= 0.20::DOUBLE AS kept
FROM based
"""

DECONTAMINATION = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), patterns AS (
  SELECT DISTINCT item, least(len(w), 10) AS m, array_to_string(w[i : i + 9], ' ') AS pattern
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM items WHERE len(w) > 0)
), places AS (
  SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS pattern
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM words, (SELECT DISTINCT m FROM patterns))
), found AS (SELECT doc_id, i, m, item FROM places JOIN patterns USING (m, pattern)
), hit AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS pos FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM words
  UNION SELECT reach.doc_id, e.b FROM reach JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) e ON e.a = reach.other
), components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""

CONVERSATION_TRIE = """
WITH own AS (
    SELECT conv_id,
           list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns,
           -- crc32 of the decimal id, byte by byte and bit by bit
           xor(list_reduce(
               list_prepend(4294967295, list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1),
                                                       lambda i: CAST(ascii(substr(CAST(conv_id AS VARCHAR), i, 1)) AS BIGINT))),
               lambda c, b: list_reduce(
                   list_prepend(xor(c, b), range(8)),
                   lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)
           ), 4294967295) % 6 AS h
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
    FROM own c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
),
members AS (
    SELECT conv_id, d AS depth, turns[1:d] AS node, d = len(turns) AS ends
    FROM rebuilt, unnest(range(0, len(turns) + 1)) AS t(d)
),
nodes AS (
    SELECT node, depth, node[1:depth - 1] AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM members GROUP BY node, depth
),
children AS (SELECT parent, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent),
counted AS (SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.parent = n.node),
subtrees AS (
    SELECT node[1:a] AS top, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
           sum(CASE WHEN depth > 0 THEN (n_convs - 1) * length(node[depth].text) ELSE 0 END) AS saved_tokens
    FROM counted, unnest(range(0, depth + 1)) AS t(a) GROUP BY top
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM counted n JOIN subtrees s ON s.top = n.node LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.parent
"""
