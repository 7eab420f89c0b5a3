"""DuckDB SQL for the queries that SQL can express, over the same tables."""

SPACE = r"[\x20\x09-\x0D]+"

LATTICE = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pairs AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON p.a = r.b),
low AS (SELECT a, min(b) AS b FROM reach GROUP BY 1), links AS (SELECT a, count(*) AS n FROM pairs GROUP BY 1)
SELECT vec_id, coalesce(links.n, 0) AS n_links, least(vec_id, coalesce(low.b, vec_id)) AS component_id, least(vec_id, coalesce(low.b, vec_id)) = vec_id AS kept
FROM v LEFT JOIN low ON low.a = vec_id LEFT JOIN links ON links.a = vec_id"""

TEMPLATES = f"""WITH l AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no FROM documents),
t AS (SELECT doc_id, no, line, string_split(trim(regexp_replace(regexp_replace(line, '{SPACE}', ' ', 'g'), '[0-9]+', '0', 'g')), ' ') AS tok FROM l),
s AS (SELECT *, len(tok) AS n, CAST(floor(len(tok) * 0.2) AS BIGINT) AS w FROM t WHERE len(tok) >= 3),
k AS (SELECT doc_id, no, n || ' ' || array_to_string(tok, ' ') AS key FROM s
  UNION ALL SELECT doc_id, no, n || ' ' || array_to_string(tok[1:2], ' ') || chr(10) || b || chr(10) || array_to_string(tok[3:2 + b * w], ' ') || chr(10) || array_to_string(tok[3 + (b + 1) * w:], ' ')
  FROM (SELECT *, unnest(range(CAST(ceil((n - 2) / w) AS BIGINT))) AS b FROM s WHERE w > 0)),
r AS (SELECT key, min(doc_id) AS first FROM k GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT DISTINCT k.doc_id, k.no FROM k JOIN r USING (key) WHERE k.doc_id <> r.first)
SELECT l.doc_id, count(*) AS n_lines, count(d.no) AS n_dropped, coalesce(string_agg(l.line, chr(10) ORDER BY l.no) FILTER (WHERE d.no IS NULL), '') AS text
FROM l LEFT JOIN d ON d.doc_id = l.doc_id AND d.no = l.no GROUP BY 1"""

QUALITY = f"""WITH d AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '{SPACE}'), lambda x: x <> '') AS words FROM d),
p AS (SELECT doc_id, unnest(range(1, len(words) - 1)) AS pos, words FROM w WHERE len(words) >= 3),
win AS (SELECT doc_id, pos, words[pos] AS a, words[pos + 1] AS b, words[pos + 2] AS c FROM p),
again AS (SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win) WHERE n > 1),
cover AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM (SELECT doc_id, pos, unnest([0, 1, 2]) AS k FROM again) GROUP BY 1),
line AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line FROM d),
word_line AS (SELECT *, lower(trim(regexp_replace(line, '{SPACE}', ' ', 'g'))) AS norm FROM line WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM word_line GROUP BY 1),
host AS (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY 1),
freq AS (SELECT source, norm, count(DISTINCT text) AS n FROM word_line GROUP BY 1, 2),
common AS (SELECT freq.source, norm FROM freq JOIN host ON host.source IS NOT DISTINCT FROM freq.source WHERE n > 10 AND 100 * n > docs),
removed AS (SELECT doc_id, CAST(sum(len(string_split(word_line.norm, ' '))) AS BIGINT) AS n FROM word_line JOIN common ON common.source IS NOT DISTINCT FROM word_line.source AND common.norm = word_line.norm GROUP BY 1),
m AS (SELECT w.doc_id, len(words) AS n_words, length(regexp_replace(text, '{SPACE}', '', 'g')) AS word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(dup.n, 0) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words, coalesce(removed.n, 0) AS n_removed_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cover USING (doc_id) LEFT JOIN removed USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND n_words - n_removed_words >= 0.5 * n_words AS kept FROM f"""
