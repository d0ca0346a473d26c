"""Comparison SQL for DuckDB, where SQL can express a query."""

from __future__ import annotations

from mainstay.llm.columns import LOWER, UPPER
from mainstay.llm.quality_rules import STOP_WORDS

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

TOP_K = """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE)))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM pairs)
SELECT query_id, CAST(place AS INT) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""

MIXING = f"""
WITH t AS (SELECT doc_id, source, greatest(1, len({WORDS})) AS n FROM documents),
s AS (
  SELECT source, sum(n) AS tokens, (SELECT sum(n) FROM t) AS total, CAST(sum(n) AS DOUBLE) / (SELECT sum(n) FROM t) AS share
  FROM t GROUP BY source),
tried AS (
  SELECT j / 4096.0 AS a, ln(sum(pow(share, j / 4096.0)))
    - (j / 4096.0) * sum(pow(share, j / 4096.0) * ln(share)) / sum(pow(share, j / 4096.0)) AS entropy
  FROM s, range(0, 4097) r(j) GROUP BY j),
chosen AS (SELECT max(a) AS a FROM tried WHERE entropy >= 0.95 * ln((SELECT count(*) FROM s)) - 1e-12),
q AS (
  SELECT source, CAST(tokens AS BIGINT) AS tokens,
    CAST(floor(CAST(total AS DOUBLE) * (pow(share, a) / (SELECT sum(pow(share, a)) FROM s, chosen))) AS BIGINT) AS quota
  FROM s, chosen),
b AS (SELECT greatest(1, ceil(sum(quota) / 1000000.0)) AS blocks FROM q WHERE quota > 0),
copies AS (
  SELECT doc_id, t.source, n, tokens, quota, unnest(range(0, (quota - 1) // tokens + 1)) AS epoch
  FROM t JOIN q ON t.source IS NOT DISTINCT FROM q.source WHERE quota > 0),
marked AS (SELECT *, md5('17|' || epoch || '|' || doc_id) AS mark FROM copies),
placed AS (
  SELECT *, epoch * tokens + coalesce(sum(n) OVER (PARTITION BY source, epoch ORDER BY mark, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM marked),
taken AS (SELECT *, CAST(floor(start * ((SELECT blocks FROM b) / quota)) AS BIGINT) AS block FROM placed WHERE start < quota)
SELECT doc_id, source, CAST(epoch AS INT) AS epoch, CAST(n AS BIGINT) AS n_tokens, block,
  CAST(row_number() OVER (PARTITION BY block ORDER BY md5('17|' || block || '|' || mark), source, doc_id) AS INT) AS place
FROM taken
"""

RULES = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS shown
  FROM documents),
w AS (SELECT doc_id, unnest(words) AS a, generate_subscripts(words, 1) AS i FROM d),
three AS (
  SELECT doc_id, i, a, lead(a, 1) OVER (PARTITION BY doc_id ORDER BY i) AS b, lead(a, 2) OVER (PARTITION BY doc_id ORDER BY i) AS c
  FROM w),
starts AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM three WHERE c IS NOT NULL)
  WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + step) AS n FROM starts, (VALUES (0), (1), (2)) s(step) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(shown) - len(list_distinct(shown)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(shown) AS BIGINT) AS n_text_lines,
    CAST(length(text) - length(replace(text, '!', '')) AS BIGINT) AS n_exclaims,
    CAST(len(list_filter(words, lambda x: list_contains([{", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))}], x))) AS BIGINT) AS n_stop_words
  FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 12 * n_words AND n_symbols <= 0.1 * n_words
    AND n_exclaims <= 0.3 * n_words AND n_stop_words >= 0.02 * n_words AND n_dup_lines <= 0.5 * n_text_lines AS kept,
  n_text_lines, n_exclaims, n_stop_words
FROM f
"""

LINES = f"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT doc_id, pos, line, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') AS key FROM l),
firsts AS (
  SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
marked AS (SELECT k.*, coalesce(first <> doc_id, false) AS gone FROM k LEFT JOIN firsts ON firsts.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

NEAR = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (
  SELECT DISTINCT doc_id, run FROM (
    SELECT doc_id, unnest(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS run
    FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM sh x JOIN sh y ON x.run = y.run AND x.doc_id < y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common.n >= 75 * (p.n + q.n - common.n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, node) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON a = node)
SELECT d.doc_id, CAST(coalesce(sizes.n, 0) AS BIGINT) AS n_shingles, least_node AS component_id, d.doc_id = least_node AS kept
FROM d LEFT JOIN sizes ON sizes.doc_id = d.doc_id
JOIN (SELECT doc_id, min(node) AS least_node FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""

PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
f AS MATERIALIZED (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS n
  FROM placed, (VALUES (1), (2), (3)) s(size) WHERE i + size - 1 <= len(w) GROUP BY 1, 2, 3),
c AS MATERIALIZED (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
inner_parts AS (
  SELECT lang, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase, a AS longer FROM c WHERE size = 3),
covers AS (SELECT lang, phrase, max(longer) AS longer FROM inner_parts GROUP BY 1, 2),
stay AS (
  SELECT c.* FROM c LEFT JOIN covers USING (lang, phrase) WHERE covers.longer IS NULL OR 100 * covers.longer < 50 * c.a),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:size], ' ') AS rest
  FROM stay, (VALUES (1), (2)) s(k) WHERE k < size),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.n AS l, y.n AS r,
    CAST((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = head JOIN f y ON y.lang = cuts.lang AND y.phrase = rest),
weakest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM weakest WHERE place = 1),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL = {
    "op1_top_k": TOP_K, "op2_mixing": MIXING, "op3_quality_rules": RULES, "op6_line_dedup": LINES, "op8_near_dedup": NEAR,
    "op12_phrases": PHRASES,
}
