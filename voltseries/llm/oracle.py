"""DuckDB SQL for the queries that SQL can express on whole tables.

The other operators rest on a fitted model, keyed permutations, keyed draws, digests or
an approximate search; their tests compare them with brute force.
"""

from __future__ import annotations

from voltseries.llm.license_scan import COVERAGE, NOTICES, SLACK
from voltseries.llm.url_filter import BASE_RULES, PATTERN_RULES

SQL: dict[str, str] = {}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


SQL["op1_ngram_jaccard_join"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), classes AS (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY ss) AS class_id
  FROM (SELECT doc_id, list(s ORDER BY s) AS ss FROM shingles GROUP BY doc_id)
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS (
  SELECT a AS doc_id, a AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(max(z.n), 0)::BIGINT AS n_shingles, coalesce(max(c.class_id), d.doc_id) AS class_id,
       least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes z USING (doc_id) LEFT JOIN classes c USING (doc_id) LEFT JOIN reach r USING (doc_id)
GROUP BY d.doc_id
"""

# Votes of word pairs per diagonal, runs of neighbouring diagonals, and their spans.
_TEMPLATES = ", ".join(f"({no}, {_quoted(p)}, {_quoted(label)})" for no, (p, label) in enumerate(NOTICES))
_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
_PLACES = " UNION ALL ".join(
    f"SELECT doc_id, i - 1 AS place, {_quoted(label)} AS label FROM spots "
    f"WHERE array_to_string(w[i:i + {len(p.split()) - 1}], ' ') = {_quoted(p)}"
    for p, label in _PHRASES.items()
)
SQL["op3_license_scan"] = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), spots AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words
), places AS ({_PLACES}),
base AS (
  SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels
  FROM places GROUP BY doc_id
), notices AS (
  SELECT no, label, string_split(phrase, ' ') AS t FROM (VALUES {_TEMPLATES}) AS v(no, phrase, label)
), grams AS (
  SELECT no, len(t) AS size, label, i - 1 AS tpos, t[i] || ' ' || t[i + 1] AS gram
  FROM (SELECT *, unnest(range(1, len(t))) AS i FROM notices)
), votes AS (
  SELECT doc_id, no, size, label, i - 1 - g.tpos AS diagonal, g.tpos, i AS word
  FROM spots JOIN grams g ON g.gram = w[i] || ' ' || w[i + 1]
), diagonals AS (SELECT DISTINCT doc_id, no, diagonal FROM votes),
marks AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER o <= {SLACK} THEN 0 ELSE 1 END AS apart
  FROM diagonals WINDOW o AS (PARTITION BY doc_id, no ORDER BY diagonal)
), runs AS (
  SELECT *, sum(apart) OVER (PARTITION BY doc_id, no ORDER BY diagonal) AS run FROM marks
), spans AS (
  SELECT v.doc_id, v.no, run, any_value(label) AS label,
         count(DISTINCT tpos)::DOUBLE / (any_value(size) - 1) AS covered,
         max(word) - min(word) + 1 AS width, any_value(size) AS size
  FROM votes v JOIN runs r ON v.doc_id = r.doc_id AND v.no = r.no AND v.diagonal = r.diagonal
  GROUP BY 1, 2, 3
), kept AS (
  SELECT doc_id, label, covered FROM spans WHERE covered >= {COVERAGE} AND width < size * 1.5 + {SLACK}
  UNION ALL SELECT doc_id, label, 1.0 FROM places
), named AS (
  SELECT doc_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels, max(covered) AS score
  FROM kept GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_BASE_ROWS = ", ".join(f"({_quoted(v)}, {_quoted(h)}, {_quoted(p)})" for v, h, p in BASE_RULES)
_PATTERN_ROWS = ", ".join(
    f"({no}, {_quoted(v)}, {_quoted(n)}, {_quoted(p)})" for no, (v, n, p, _) in enumerate(PATTERN_RULES)
)
SQL["op8_url_filter"] = rf"""
WITH parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                   'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), base AS (
  SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
  FROM parsed JOIN (VALUES {_BASE_ROWS}) AS b(v, h, p)
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id
), pattern AS (
  SELECT page_id, arg_max(n, length(p) * 1000 - no) AS pattern_rule, arg_max(v, length(p) * 1000 - no) AS verdict
  FROM parsed JOIN (VALUES {_PATTERN_ROWS}) AS r(no, v, n, p) ON regexp_matches(host || path, p)
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(base.verdict, pattern.verdict, 'allow') AS verdict,
       CASE WHEN rule IS NULL THEN pattern_rule END AS pattern_rule
FROM parsed LEFT JOIN base USING (page_id) LEFT JOIN pattern USING (page_id)
"""

SQL["op10_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), placed AS (
  SELECT *, row_number() OVER o AS rn, count(*) OVER (PARTITION BY conv_id) AS n,
         role = 'assistant' AS trained,
         sum(length('### : ' || ' </turn>.') + length(role) + length(text)
             + length(role || text) * 3 - length(replace(role || text, '\', '')) - length(replace(role || text, '#', ''))
             - length(replace(role || text, '<', '')) + length(role) - length(replace(role, ':', ''))) OVER o AS upto
  FROM turns WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (trained), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (trained), '')) AS loss_sha256,
       sum(upto) FILTER (trained OR rn = n)::BIGINT AS formatted_chars,
       count(*) FILTER (trained OR rn = n) AS n_examples
FROM placed GROUP BY conv_id
"""

SQL["op11_collocations"] = rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM places, (VALUES (1), (2), (3)) AS s(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT *, string_split(phrase, ' ') AS t FROM counts WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.k, c.phrase, c.f AS a, l.f AS l, r.f AS r, h,
         (1000000::HUGEINT * c.f * c.f) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS h FROM candidates) c
  JOIN counts l ON l.lang = c.lang AND l.k = c.h AND l.phrase = array_to_string(t[1:h], ' ')
  JOIN counts r ON r.lang = c.lang AND r.k = c.k - c.h AND r.phrase = array_to_string(t[h + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, h) = 1
), held AS (
  SELECT lang, array_to_string(t[s:s + 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT *, unnest([1, 2]) AS s FROM candidates WHERE k = 3) GROUP BY ALL
), kept AS (
  SELECT b.* FROM best b LEFT JOIN held h ON h.lang = b.lang AND h.phrase = b.phrase
  WHERE h.f IS NULL OR 100 * h.f < 50 * a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000
"""

SQL["op12_minhash_dedup"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach AS (
  SELECT a AS doc_id, a AS other FROM links
  UNION
  SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), found AS (
  SELECT d.doc_id, coalesce(max(z.n), 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(min(r.other), d.doc_id)) AS component_id
  FROM documents d LEFT JOIN sizes z USING (doc_id) LEFT JOIN reach r USING (doc_id) GROUP BY d.doc_id
)
SELECT *, doc_id = component_id AS kept FROM found
"""

SQL["op13_hard_negatives"] = """
WITH used AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS alike, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM used a JOIN used b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
