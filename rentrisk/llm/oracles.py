"""DuckDB SQL of the queries that SQL can express, written from the contracts.

No SQL: op2 (approximate), op3 (possessive patterns and positions), op4 (trained), op6 (drawn), op7 and op9
(tokenizer), op10 (bytes of every position), pipeline. ``tests/llm`` holds those against brute force.
"""

from __future__ import annotations

from rentrisk.llm.quality import RULES, STOP_WORDS

OP1 = r"""
WITH urls AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                       THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
  FROM urls
), rules(rhost, rpath, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), best AS (
  SELECT page_id, host, path, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
         arg_max(action, length(rhost || rpath)) AS action
  FROM parts LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY page_id, host, path
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM best
"""

_FEATURES = {
    "n_words": "n_words", "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "symbol_ratio": "n_symbols / greatest(n_words, 1)", "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "word_length": "word_chars / greatest(n_words, 1)", "stop_share": "n_stop / greatest(n_words, 1)",
}


def _conditions() -> str:
    out = []
    for r in RULES:
        x = f"({_FEATURES[r.feature]})"
        out += [f"{x} >= {r.least}"] * (r.least is not None) + [f"{x} <= {r.most}"] * (r.most is not None)
    return " AND ".join(out)


def _stop_list() -> str:
    return ", ".join(f"'{w}'" for w in sorted({*STOP_WORDS, *(w.capitalize() for w in STOP_WORDS)}))


OP5 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r
), m AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum([length(x) FOR x IN w]), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         len([x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')]) AS n_lines,
         CAST(len([x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')])
              - len(list_distinct([x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')]))
              AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         len([x FOR x IN w IF x IN ({_stop_list()})]) AS n_stop
  FROM d LEFT JOIN covered c USING (r)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND {_conditions()} AS kept
FROM m
"""

OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                          ELSE [w[i] || ' ' || w[i + 1] FOR i IN generate_series(1, len(w) - 1)] END) AS g FROM d)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
                    GROUP BY 1, 2) p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT r.a AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.b) AS component_id,
       r.a = min(r.b) AS kept
FROM reach r LEFT JOIN n ON n.doc_id = r.a GROUP BY r.a
"""

OP13 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""

ORACLES = {"op1_url_filters": OP1, "op5_quality_rules": OP5, "op8_minhash": OP8, "op13_hard_negatives": OP13}
