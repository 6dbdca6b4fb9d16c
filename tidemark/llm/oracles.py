"""Answers in DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.quality_rules import STOP_WORDS

_STOP = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))

_WORDS = """
words AS (
  SELECT doc_id, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda l: regexp_matches(l, '[^ \\t-\\r]')) AS l
  FROM documents)"""

OP7 = f"""
WITH {_WORDS},
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 4), ' ') AS gram
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM words)),
repeated AS (
  SELECT doc_id, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1),
covered AS (
  SELECT doc_id, CAST(sum(least(5, coalesce(step, 5))) AS BIGINT) AS n_repeat_words
  FROM (SELECT doc_id, lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i AS step FROM repeated)
  GROUP BY doc_id),
counts AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         length(text) - length(translate(text, '!?', '')) AS n_marks,
         len(list_filter(w, lambda x: lower(trim(x, '.,;:!?"''()')) IN ({_STOP}))) AS n_stop,
         len(l) AS n_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)[ \\t-\\r]*$'))) AS n_ellipsis,
         len(list_filter(l, lambda x: regexp_matches(x, '^[ \\t-\\r]*[-*•]'))) AS n_bullet
  FROM words LEFT JOIN covered USING (doc_id)),
verdicts AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(
         word_chars / n_words < 2 OR word_chars / n_words > 15 OR n_symbols / n_words > 0.3
         OR n_marks / n_words > 0.4 OR (n_words >= 50 AND n_stop / n_words < 0.02)
         OR n_dup_lines / n_lines > 0.5 OR n_ellipsis / n_lines > 0.3
         OR n_bullet / n_lines > 0.9, FALSE) AS kept
FROM verdicts
"""

OP5 = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
                                   AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
components AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id,
       vec_id = component_id AS kept
FROM embeddings JOIN components USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

ORACLES = {"op5_projection_dedup": OP5, "op7_quality_rules": OP7}
