"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

from quarrystone.llm.collocations import OP12_SQL
from quarrystone.llm.kmeans import OP13_SQL
from quarrystone.llm.line_dedup import OP9_SQL
from quarrystone.llm.url_rules import OP11_SQL

_WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOW = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOW)} AS words FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS i FROM w WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
often AS (SELECT g FROM grams GROUP BY 1 HAVING count(*) > 1),
shared AS (SELECT doc_id, g FROM grams SEMI JOIN often USING (g)),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shared a JOIN shared b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM met JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
  WHERE 100 * met.n >= 80 * (x.n + y.n - met.n)
),
reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.doc_id = l.a
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, r.component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
"""

OP6_SQL = f"""
WITH w AS (SELECT doc_id, {_WORDS.format('text')} AS words FROM documents),
starts AS (
  SELECT doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS k
  FROM (SELECT doc_id, words, unnest(generate_series(1, len(words) - 49)) AS i FROM w WHERE len(words) >= 50)
),
flagged AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS least FROM starts) WHERE least < doc_id),
each AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
marked AS (
  SELECT e.doc_id, e.word, e.i,
    coalesce(max(f.i) OVER (PARTITION BY e.doc_id ORDER BY e.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM each e LEFT JOIN flagged f ON e.doc_id = f.doc_id AND e.i = f.i
),
summed AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
    coalesce(string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM marked GROUP BY 1
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN summed USING (doc_id)
"""

_GRAMS = ", ".join(f"({n})" for n in range(2, 11))
# As in ``quality``, the largest shares by n-gram length.
_LIMITS = "(2, 0.20), (3, 0.18), (4, 0.16), (5, 0.15), (6, 0.14), (7, 0.13), (8, 0.12), (9, 0.11), (10, 0.10)"

OP8_SQL = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format('text')} AS words FROM documents),
each AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
sized AS (SELECT *, sum(length(word)) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM each),
totals AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM each GROUP BY 1),
grams AS (
  SELECT doc_id, n, i, md5(array_to_string(words[i : i + n - 1], ' ')) AS g
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i FROM w, (VALUES {_GRAMS}) v(n) WHERE len(words) >= n)
),
turned AS (SELECT *, count(*) OVER same AS often, row_number() OVER (same ORDER BY i) AS turn FROM grams WINDOW same AS (PARTITION BY doc_id, n, g)),
top AS (
  SELECT t.doc_id, n, max(CASE WHEN often > 1 THEN often * (b.upto - a.upto + length(a.word)) ELSE 0 END) AS chars
  FROM turned t JOIN sized a ON t.doc_id = a.doc_id AND t.i = a.i JOIN sized b ON t.doc_id = b.doc_id AND t.i + n - 1 = b.i
  WHERE n <= 4 AND turn = 1 GROUP BY 1, 2
),
hits AS (
  SELECT e.doc_id, v.n, e.word,
    coalesce(max(l.i) OVER (PARTITION BY e.doc_id, v.n ORDER BY e.i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), -99) + v.n > e.i AS later,
    coalesce(max(r.i) OVER (PARTITION BY e.doc_id, v.n ORDER BY e.i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), -99) + v.n > e.i AS repeated
  FROM each e CROSS JOIN (VALUES (3), (5), (6), (7), (8), (9), (10)) v(n)
  LEFT JOIN turned l ON l.doc_id = e.doc_id AND l.n = v.n AND l.i = e.i AND l.turn > 1
  LEFT JOIN turned r ON r.doc_id = e.doc_id AND r.n = v.n AND r.i = e.i AND r.often > 1
),
covered AS (
  SELECT doc_id, n, coalesce(sum(length(word)) FILTER (WHERE later), 0) AS chars, count(*) FILTER (WHERE repeated) AS words FROM hits GROUP BY 1, 2
),
shares AS (
  SELECT doc_id, n, chars, n <= 4 AS is_top FROM top UNION ALL SELECT doc_id, n, chars, false FROM covered WHERE n >= 5
),
judged AS (
  SELECT s.doc_id, bool_and(s.chars::DOUBLE / word_chars::DOUBLE <= lim::DOUBLE) AS fine,
    max(CASE WHEN is_top THEN s.chars::DOUBLE / word_chars::DOUBLE END) AS top_share, max(CASE WHEN NOT is_top THEN s.chars::DOUBLE / word_chars::DOUBLE END) AS duplicate_share
  FROM shares s JOIN totals USING (doc_id) JOIN (VALUES {_LIMITS}) m(n, lim) USING (n) GROUP BY 1
),
lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY at_line) > 1 AS again
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS at_line FROM w)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
lined AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE again) AS n_dup_lines,
    coalesce(sum(strlen(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) FILTER (WHERE again), 0) AS dup_bytes,
    sum(strlen(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) AS all_bytes FROM lines GROUP BY 1
),
based AS (
  SELECT w.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(c.words, 0)::BIGINT AS n_repeat_words, n_lines, dup_bytes, all_bytes, coalesce(fine, true) AS fine,
    coalesce(top_share, 0) AS top_share, coalesce(duplicate_share, 0) AS duplicate_share,
    coalesce(dup_bytes::DOUBLE / greatest(1, all_bytes)::DOUBLE, 0) AS line_share
  FROM w LEFT JOIN totals USING (doc_id) LEFT JOIN lined USING (doc_id) LEFT JOIN judged USING (doc_id) LEFT JOIN (SELECT doc_id, words FROM covered WHERE n = 3) c USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND fine AND n_symbols <= 0.10::DOUBLE * n_words AND n_dup_lines <= 0.30::DOUBLE * n_lines AND dup_bytes <= 0.20::DOUBLE * all_bytes AS kept,
  top_share, duplicate_share, line_share
FROM based
"""

OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda y: y IS NOT NULL AND isfinite(y))) = len(embedding) AND len(list_filter(embedding, lambda y: y <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.98
),
reach AS (SELECT vec_id, vec_id AS root FROM embeddings UNION SELECT l.b, r.root FROM reach r JOIN links l ON r.vec_id = l.a)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY 1) r USING (vec_id)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_ngram_jaccard": OP3_SQL, "op6_substring_dedup": OP6_SQL, "op8_quality": OP8_SQL, "op9_line_dedup": OP9_SQL, "op10_embedding_dedup": OP10_SQL, "op11_url_rules": OP11_SQL, "op12_collocations": OP12_SQL, "op13_centroids": OP13_SQL}
