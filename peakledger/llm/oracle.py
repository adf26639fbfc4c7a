"""SQL twins, for DuckDB, of the queries that SQL can express. The others are tested against brute force in tests/llm."""

from __future__ import annotations

from .jaccard import PERCENT
from .quality import HOST_PERCENT, LEFT_SHARE, MAX_REPEATED, MIN_DOCS, MIN_WORDS
from .queries import URL_RULES

_SPACE = r"[\x20\x09-\x0D]"

QUALITY = rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, row_number() OVER () AS row FROM documents),
words AS (SELECT row, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT row, [x FOR x IN string_split_regex(t, '{_SPACE}+') IF x <> ''] AS w FROM d)),
windows AS (SELECT row, i, w || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 AS g FROM (
    SELECT row, i, w, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4, lead(w, 4) OVER p AS w5 FROM words WINDOW p AS (PARTITION BY row ORDER BY i)) WHERE w5 IS NOT NULL),
twice AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, g) AS n FROM windows) WHERE n > 1),
repeated AS (SELECT row, count(DISTINCT i + k) AS n FROM twice, range(5) AS r(k) GROUP BY row),
lines AS (SELECT row, source, line, i, trim(regexp_replace(lower(list_aggregate([x FOR x IN string_split_regex(line, '{_SPACE}+') IF x <> ''], 'string_agg', ' ')), '[0-9]+', '0', 'g')) AS norm,
    len([x FOR x IN string_split_regex(line, '{_SPACE}+') IF x <> '']) AS n FROM (SELECT row, source, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM (SELECT row, source, string_split(t, chr(10)) AS l FROM d))
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT row, count(*) - count(DISTINCT line) AS n FROM lines GROUP BY row),
bodies AS (SELECT row, source, string_agg(norm, chr(10) ORDER BY i) AS body FROM lines GROUP BY row, source),
hosts AS (SELECT source, count(DISTINCT body) AS total FROM bodies GROUP BY source),
per_line AS (SELECT l.source, norm, count(DISTINCT body) AS docs FROM lines l JOIN bodies b ON b.row = l.row GROUP BY l.source, norm),
common AS (SELECT p.source, norm FROM per_line p JOIN hosts h ON p.source IS NOT DISTINCT FROM h.source
    WHERE docs >= {MIN_DOCS} AND 100 * docs >= {HOST_PERCENT} * total),
gone AS (SELECT row, sum(n) AS n FROM lines l WHERE EXISTS (SELECT 1 FROM common c WHERE c.source IS NOT DISTINCT FROM l.source AND c.norm = l.norm) GROUP BY row),
base AS (SELECT doc_id, coalesce((SELECT count(*) FROM words w WHERE w.row = d.row), 0) AS n_words, length(regexp_replace(t, '{_SPACE}', '', 'g')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words, coalesce(gone.n, 0) AS n_removed_words
    FROM d LEFT JOIN dup ON dup.row = d.row LEFT JOIN repeated ON repeated.row = d.row LEFT JOIN gone ON gone.row = d.row)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, CAST(n_removed_words AS BIGINT) AS n_removed_words,
    (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AS base_failed,
    NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AND n_words - n_removed_words >= {LEFT_SHARE} * n_words AS kept FROM base
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
firsts AS (SELECT h, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY h)
SELECT page_id, strlen(p.h) AS payload_bytes, sha256(p.h) AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to FROM p LEFT JOIN firsts ON p.h = firsts.h
"""

_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
URLS = rf"""
WITH rules(verdict, host, path) AS (VALUES {_RULES}),
u AS (SELECT page_id, row_number() OVER () AS row, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
fit AS (SELECT row, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY row ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS n
    FROM u JOIN rules r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM u LEFT JOIN fit ON fit.row = u.row AND n = 1
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
CLASSES = rf"""
WITH RECURSIVE w AS (SELECT doc_id, [x FOR x IN string_split_regex({_LOWER}, '{_SPACE}+') IF x <> ''] AS w FROM documents),
shingles AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[k:k + 4], ' ') FOR k IN range(1, len(w) - 3)]) END AS s FROM w),
sets AS (SELECT min(doc_id) AS doc_id, list_sort(s) AS s, len(s) AS n FROM shingles WHERE len(s) > 0 GROUP BY ALL),
members AS (SELECT x.doc_id, x.n_shingles, sets.doc_id AS rep FROM (SELECT doc_id, len(s) AS n_shingles, list_sort(s) AS s FROM shingles) x LEFT JOIN sets ON sets.s = x.s),
tokens AS (SELECT doc_id, n, unnest(s) AS t FROM sets),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= {PERCENT} * (a.n + b.n - count(*))),
reach AS (SELECT a AS origin, a AS node FROM links UNION SELECT reach.origin, links.b FROM reach JOIN links ON links.a = reach.node),
lowest AS (SELECT origin, min(node) AS lowest FROM reach GROUP BY origin)
SELECT doc_id, CAST(n_shingles AS BIGINT) AS n_shingles, coalesce(lowest, rep, doc_id) AS component_id FROM members LEFT JOIN lowest ON origin = rep
"""

SQL = {"op4_quality": QUALITY, "op7_warc": WARC, "op9_url_rules": URLS, "op12_jaccard_classes": CLASSES}
