"""DuckDB twins of the catalogue's queries. Left out: placement (greedy packing), HTML trees, seeded hashes."""

from __future__ import annotations

FILES = """files AS (
  SELECT doc_id, CASE doc_id % 5
      WHEN 0 THEN 'PublicReports/' || source || '/' || lang || '/doc_' || doc_id || '.pdf'
      WHEN 1 THEN 'sherlock-reports/audits/' || source || '/' || lang || '/doc_' || doc_id || '.pdf'
      WHEN 2 THEN 'vault/Coverage-Agreements/' || source || '/' || lang || '/doc_' || doc_id || '.pdf'
      WHEN 3 THEN 'misc/' || source || '/' || lang || '/doc_' || doc_id || '.pdf'
      ELSE 'PublicReports/doc_' || doc_id || '.pdf' END AS rel_path,
    strlen(text)::BIGINT AS size_bytes,
    CASE WHEN doc_id % 97 <> 0 THEN ceil(n_chars / 1800.0)::INT END AS page_count
  FROM documents),
named AS (
  SELECT *, CASE doc_id % 5 WHEN 0 THEN 'public_reports/' || split_part(rel_path, '/', 2) WHEN 1 THEN 'sherlock_reports/audits'
      WHEN 2 THEN 'excluded/coverage-agreements' WHEN 3 THEN 'other_audit_repo_pdfs'
      ELSE 'public_reports/' || split_part(rel_path, '/', 2) END AS bucket
  FROM files)"""

PAGES = """docs AS (SELECT doc_id, text, greatest(1, ceil(n_chars / 1800.0))::INT AS pages FROM documents),
cut AS (SELECT doc_id, text, unnest(generate_series(1, pages))::INT AS page FROM docs),
raw AS (
  SELECT doc_id, printf('pages_%04d.raw.json', ((page - 1) // 4) * 4 + 1) AS raw_file, (page - 1) % 4 AS position,
    CASE WHEN (doc_id * 31 + page) % 53 <> 0 THEN page END AS page_number, substr(text, (page - 1) * 1800 + 1, 1800) AS text FROM cut
  UNION ALL
  SELECT doc_id, 'pages_9001.raw.json', page - 1, page, '~ ' || substr(text, (page - 1) * 1800 + 1, 1800) FROM cut WHERE doc_id % 3 = 0 AND page <= 2),
sound AS (
  SELECT * FROM (SELECT *, max(CASE WHEN page_number IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, raw_file ORDER BY position) AS bad FROM raw) WHERE bad = 0),
store AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, page_number ORDER BY raw_file DESC, position DESC) AS turn FROM sound) WHERE turn = 1),
summary AS (
  SELECT r.doc_id, raw_file_count, coalesce(page_record_count, 0) AS page_record_count, coalesce(nonempty_page_count, 0) AS nonempty_page_count, error_count,
    CASE WHEN error_count > 0 THEN 'error' WHEN coalesce(page_record_count, 0) > 0 THEN 'ok' ELSE 'skipped' END AS status
  FROM (SELECT doc_id, count(*) AS raw_file_count, count(*) FILTER (WHERE failed) AS error_count
        FROM (SELECT doc_id, raw_file, bool_or(page_number IS NULL) AS failed FROM raw GROUP BY ALL) GROUP BY doc_id) r
  LEFT JOIN (SELECT doc_id, count(*) AS page_record_count, count(*) FILTER (WHERE text <> '') AS nonempty_page_count FROM store GROUP BY doc_id) s USING (doc_id))"""

EVENTS = """e AS (
  SELECT event_id, ts, user_id, printf('chunk_%04d', user_id % 31) AS chunk_id, 'pdf_' || user_id AS pdf_id,
    CASE event_type WHEN 'view' THEN 'skipped_existing' WHEN 'error' THEN 'error' WHEN 'signup' THEN 'partial_error' ELSE 'ok' END AS status,
    event_id::VARCHAR AS rel_path, floor(value * 10)::BIGINT AS text_length, event_id % 5000 AS client_elapsed_ms, value
  FROM events)"""

LINKS = r"""tags AS (
  SELECT url AS page_url, unnest(t) AS tag, generate_subscripts(t, 1) - 1 AS pos
  FROM (SELECT url, regexp_extract_all(html, '<a href="([^"]*)"[^>]*>([^<]*)</a>') AS t FROM pages)),
links AS (
  SELECT page_url, pos::INT AS pos, regexp_extract(tag, 'href="([^"]*)"', 1) AS href, regexp_extract(tag, '>([^<]*)<', 1) AS text,
    'http://' || regexp_extract(page_url, '^[a-z]+://([^/?#]*)', 1) AS base FROM tags),
resolved AS (
  SELECT *, CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href WHEN starts_with(href, '//') THEN 'https:' || href
      WHEN starts_with(href, '/') THEN base || href ELSE base || '/' || href END AS url,
    regexp_replace(text, '^\s+|\s+$', '', 'g') AS title
  FROM links WHERE href <> '' AND NOT starts_with(href, '#') AND NOT starts_with(lower(href), 'mailto:') AND NOT starts_with(lower(href), 'javascript:'))"""

SITE = LINKS + r""",
site AS (
  SELECT page_url, pos, base, CASE pos % 6 WHEN 0 THEN '/reports/r' || pos % 4 WHEN 1 THEN '/contests/c' || pos WHEN 2 THEN '/contests/' WHEN 3 THEN '/c/' || pos
      WHEN 4 THEN '/bug-bounty/b' || pos % 3 ELSE '/docs/page' || pos || '.PDF' END AS href,
    CASE WHEN pos % 5 <> 0 THEN text ELSE '' END AS text, CASE WHEN pos % 7 <> 6 THEN pos // 3 END AS block, CASE WHEN pos % 4 <> 0 THEN 'Heading ' || pos END AS heading,
    CASE pos % 3 WHEN 0 THEN 'h1' WHEN 1 THEN 'h2' END AS under FROM links),
here AS (SELECT *, base || href AS url, regexp_replace(text, '^\s+|\s+$', '', 'g') AS title FROM site)"""

PRED = """pred AS (
  SELECT doc_id, lang, source, quality, toxic, ((doc_id * 7919) % 1000) / 1000.0::DOUBLE AS score FROM labels JOIN documents USING (doc_id))"""

PARTS = """parts AS (
  SELECT p_name AS name, CASE p_partkey % 3 WHEN 0 THEN 'github' WHEN 1 THEN 'web' ELSE 'kaggle' END AS source_type, p_brand AS category,
    CASE WHEN p_size >= 34 THEN 'high' WHEN p_size >= 17 THEN 'medium' ELSE 'low' END AS priority, p_partkey AS position FROM part)"""

CLONES = """clones AS (
  SELECT c_name AS name, c_mktsegment AS category, CASE o_orderstatus WHEN 'F' THEN 'cloned' WHEN 'O' THEN 'updated' ELSE 'failed' END AS status,
    CASE WHEN left(o_orderpriority, 1) IN ('1', '2') THEN 'high' WHEN left(o_orderpriority, 1) = '3' THEN 'medium' ELSE 'low' END AS priority,
    CASE WHEN o_orderstatus = 'P' THEN 'timed out' END AS error
  FROM orders JOIN customer ON o_custkey = c_custkey)"""

PHASES = """phases AS (
  SELECT l_returnflag || '-' || l_linestatus || '-' || l_linenumber AS name, l_returnflag AS category, l_linenumber AS gpu_count, sum(l_quantity) AS hours
  FROM lineitem GROUP BY ALL)"""

COMPLETION = f"""{EVENTS},
plan AS (SELECT chunk_id, count(*) AS expected FROM e WHERE status IN ('ok', 'skipped_existing') OR chunk_id >= 'chunk_0005' GROUP BY 1),
seen AS (SELECT chunk_id, count(*) AS processed, count(*) FILTER (WHERE status IN ('error', 'partial_error', 'unknown')) AS failing
         FROM e WHERE status IN ('ok', 'skipped_existing') OR chunk_id >= 'chunk_0007' GROUP BY 1),
done AS (SELECT chunk_id, expected, coalesce(processed, 0) AS processed, coalesce(processed = expected AND failing = 0, false) AS complete FROM plan LEFT JOIN seen USING (chunk_id))"""

DIVERGENCE = f"""{EVENTS},
div AS (SELECT user_id, min(event_id % 100) FILTER (WHERE value / 100 > 0.5) AS first_divergence, max(event_id % 100) AS last_step FROM e GROUP BY 1)"""

DONE = "done AS (SELECT DISTINCT event_id AS doc_id, (user_id % 4 * 4 + 1)::INT AS page_start FROM events WHERE event_type = 'click')"


def _windows(width: int, start: int = 1, end: str = "page_count") -> str:
    last = f"least(page_count, {end})"
    return f"""windows AS (
  SELECT doc_id, page_start, least(page_start + {width - 1}, last)::INT AS page_end
  FROM (SELECT doc_id, {last} AS last, unnest(generate_series({start}, {last}, {width}))::INT AS page_start FROM files WHERE page_count > 0 AND {last} >= {start}))"""


MEASURES = """count(*) AS pdf_count, count(page_count) AS known_page_count_pdfs, count(*) FILTER (WHERE page_count IS NULL) AS unknown_page_count_pdfs,
  coalesce(sum(page_count), 0)::BIGINT AS total_known_pages, coalesce(sum(size_bytes), 0)::BIGINT AS total_size_bytes"""

SIZE = "CASE WHEN {0} < 1024 THEN printf('%.2f B', {0}::DOUBLE) WHEN {0} < 1048576 THEN printf('%.2f KiB', {0} / 1024.0::DOUBLE) WHEN {0} < 1073741824 THEN printf('%.2f MiB', {0} / 1048576.0::DOUBLE) ELSE printf('%.2f GiB', {0} / 1073741824.0::DOUBLE) END"

ORACLES: dict[str, str] = {
    "inventory": f"""WITH {FILES} SELECT printf('pdf_%06d_', row_number() OVER (ORDER BY string_split(rel_path, '/'))) || left(sha1(rel_path), 12) AS pdf_id,
      rel_path, '/audits/' || rel_path AS abs_path, 'doc_' || doc_id || '.pdf' AS filename, 'doc_' || doc_id AS stem, bucket, starts_with(bucket, 'excluded/') AS excluded, size_bytes, page_count FROM named""",
    "inventory_rollup": f"WITH {FILES} SELECT {MEASURES} FROM named WHERE NOT starts_with(bucket, 'excluded/')",
    "excluded_files": f"WITH {FILES} SELECT rel_path, bucket, size_bytes FROM named WHERE starts_with(bucket, 'excluded/')",
    "bucket_counts": f"WITH {FILES} SELECT bucket, count(*) AS pdf_count FROM named GROUP BY 1",
    "chunk_count": f"WITH {FILES} SELECT CASE WHEN coalesce(sum(page_count), 0) > 0 THEN greatest(1, ceil(sum(page_count) / 500.0)) ELSE greatest(1, ceil(count(*) / 300.0)) END::BIGINT AS chunk_count FROM named WHERE NOT starts_with(bucket, 'excluded/')",
    "page_windows": f"WITH {FILES}, {_windows(4, 2, '9')} SELECT doc_id, page_start, page_end, printf('pages_%04d_%04d.raw.json', page_start, page_end) AS raw_file FROM windows",
    "window_total": f"WITH {FILES}, {_windows(4, 2, '9')} SELECT count(*)::BIGINT AS window_total FROM windows",
    "pending_windows": f"WITH {FILES}, {_windows(4)}, {DONE} SELECT doc_id, page_start, page_end FROM windows ANTI JOIN done USING (doc_id, page_start)",
    "window_events": f"WITH {FILES}, {_windows(4)}, {DONE} SELECT CASE WHEN d.doc_id IS NULL THEN 'pending' ELSE 'skipped_existing' END AS status, count(*) AS n FROM windows w LEFT JOIN done d ON w.doc_id = d.doc_id AND w.page_start = d.page_start GROUP BY 1",
    "page_store": f"WITH {PAGES} SELECT doc_id, page_number, raw_file, sha256(text) AS text_sha256, length(text) AS text_length FROM store",
    "materialize_pdf_summary": f"WITH {PAGES} SELECT * FROM summary",
    "materialize_run_summary": f"""WITH {PAGES} SELECT CASE WHEN doc_id % 11 <> 0 THEN printf('chunk_%04d', doc_id % 5) ELSE 'unknown' END AS chunk_id, status, count(*) AS pdf_count,
      sum(page_record_count)::BIGINT AS page_record_count, sum(nonempty_page_count)::BIGINT AS nonempty_page_count FROM summary GROUP BY 1, 2""",
    "window_summary": f"""WITH {PAGES} SELECT doc_id, raw_file, (sum(length(text)) + 2 * (count(*) - 1))::BIGINT AS text_length,
      string_agg(length(text)::VARCHAR, ',' ORDER BY position) AS page_text_lengths, count(*) FILTER (WHERE text <> '') AS nonempty_pages FROM raw GROUP BY 1, 2""",
    "sample_summary": f"""WITH {EVENTS}, r AS (SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN client_elapsed_ms + 10 ELSE client_elapsed_ms END / 1000.0::DOUBLE / greatest(1, event_id % 2 * 3) AS per, rel_path FROM e)
      SELECT event_id, round(per, 3) AS seconds_per_page, round(per * 40, 3) AS estimated_full_seconds, left(rel_path, 500) AS text_preview FROM r""",
    "status_counts": f"WITH {EVENTS} SELECT chunk_id, status, count(*) AS n FROM e GROUP BY 1, 2",
    "progress": f"WITH {EVENTS} SELECT least(count(*) FILTER (WHERE status IN ('ok', 'skipped_existing')), 5000) AS completed, last(rel_path ORDER BY ts, event_id) AS last_label FROM e",
    "pdf_status": f"""WITH {EVENTS} SELECT chunk_id, pdf_id, CASE WHEN count(*) FILTER (WHERE status = 'error') > 0 THEN 'partial_error' ELSE 'ok' END AS status, count(*) AS window_count,
      count(*) FILTER (WHERE status = 'ok') AS completed_windows, count(*) FILTER (WHERE status = 'skipped_existing') AS skipped_existing_windows, count(*) FILTER (WHERE status = 'error') AS error_count,
      coalesce(sum(text_length) FILTER (WHERE status = 'ok'), 0)::BIGINT AS total_text_length, coalesce(sum(client_elapsed_ms) FILTER (WHERE status = 'ok'), 0)::BIGINT AS total_client_elapsed_ms FROM e GROUP BY 1, 2""",
    "chunk_completion": f"WITH {COMPLETION} SELECT * FROM done",
    "next_incomplete_chunk": f"WITH {COMPLETION} SELECT chunk_id FROM done WHERE NOT complete AND chunk_id > 'chunk_0002' ORDER BY 1 LIMIT 1",
    "stop_after_errors": f"""WITH {EVENTS} SELECT chunk_id, event_id, status FROM (SELECT *, coalesce(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END)
      OVER (PARTITION BY chunk_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS errors FROM e) WHERE errors < 3""",
    "rate_limit_violations": f"""WITH {EVENTS} SELECT event_id, user_id, earlier FROM (SELECT *, count(*) OVER (PARTITION BY user_id ORDER BY floor(epoch(ts))::BIGINT RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW) - 1 AS earlier FROM e) WHERE earlier >= 3""",
    "rate_limit_wait": f"""WITH {EVENTS}, s AS (SELECT event_id, user_id, floor(epoch(ts))::BIGINT AS s FROM e),
      w AS (SELECT *, count(*) OVER f - 1 AS earlier, min(s) OVER f AS oldest FROM s WINDOW f AS (PARTITION BY user_id ORDER BY s RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW))
      SELECT event_id, earlier, CASE WHEN earlier < 3 THEN 0 ELSE greatest(0, oldest + 3600 - s) END::BIGINT AS wait_seconds FROM w""",
    "rate_limit_delays": """WITH RECURSIVE c AS (SELECT event_id, user_id AS k, floor(epoch(ts))::BIGINT AS s, row_number() OVER (PARTITION BY user_id ORDER BY floor(epoch(ts)), event_id) - 1 AS i FROM events),
      r AS (SELECT event_id, k, s, i, s AS start_second FROM c WHERE i < 2
        UNION ALL SELECT c.event_id, c.k, c.s, c.i, greatest(c.s, r.start_second + 28800) FROM r JOIN c ON c.k = r.k AND c.i = r.i + 2)
      SELECT event_id, start_second, start_second - s AS waited FROM r""",
    "rate_limit_delays_hot": """WITH RECURSIVE c AS (SELECT event_id, 0 AS k, floor(epoch(ts))::BIGINT AS s, row_number() OVER (PARTITION BY 0 ORDER BY floor(epoch(ts)), event_id) - 1 AS i FROM events),
      r AS (SELECT event_id, k, s, i, s AS start_second FROM c WHERE i < 4
        UNION ALL SELECT c.event_id, c.k, c.s, c.i, greatest(c.s, r.start_second + 3600) FROM r JOIN c ON c.k = r.k AND c.i = r.i + 4)
      SELECT event_id, start_second, start_second - s AS waited FROM r""",
    "stream_trailing_calls": """SELECT event_id, earlier, earlier < 5 AS can_proceed FROM (SELECT event_id, ts, count(*) OVER (PARTITION BY event_type ORDER BY floor(epoch(ts))::BIGINT RANGE BETWEEN 599 PRECEDING AND CURRENT ROW) - 1 AS earlier FROM events)
      WHERE floor(epoch(ts)) + 1 <= (SELECT floor(epoch_ms(max(ts)) / 1000.0) FROM events) - 86400""",
    "generation_rollup": f"""WITH {EVENTS}, r AS (SELECT user_id, event_id, client_elapsed_ms + 100 AS total_ms, client_elapsed_ms AS decode_ms, CASE WHEN event_id % 4 <> 0 THEN event_id % 97 END AS ttft,
        CASE WHEN user_id % 3 <> 0 OR event_id % 5 <> 0 THEN event_id % 301 END AS tokens, CASE WHEN user_id % 2 = 0 OR event_id % 2 = 0 THEN 'tokens' ELSE 'chunks' END AS units FROM e),
      a AS (SELECT user_id, count(*) AS request_count, sum(total_ms)::BIGINT AS total_ms, sum(decode_ms)::BIGINT AS decode_ms, arg_min(ttft, event_id) FILTER (WHERE ttft IS NOT NULL) AS ttft,
        CASE WHEN count(ttft) > 1 THEN floor(sum(ttft) / count(ttft))::BIGINT END AS avg_ttft, CASE WHEN count(tokens) = count(*) THEN sum(tokens)::BIGINT END AS completion_tokens,
        CASE WHEN count(DISTINCT units) = 1 THEN max(units) ELSE 'mixed' END AS output_units FROM r GROUP BY 1)
      SELECT *, CASE WHEN completion_tokens > 0 AND decode_ms > 0 THEN round(completion_tokens * 1000.0::DOUBLE / decode_ms, 3) END AS output_units_per_second FROM a""",
    "sft_rows": """WITH m AS (SELECT conv_id::VARCHAR AS record_id,
        coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE text <> '' AND role IN ('system', 'developer')), '') AS context,
        coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE text <> '' AND role NOT IN ('system', 'developer', 'assistant')), '') AS question,
        coalesce(string_agg(text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE text <> '' AND role = 'assistant'), '') AS answer FROM conversations GROUP BY 1)
      SELECT *, CASE WHEN answer = '' THEN 'no assistant answer' WHEN context = '' AND question = '' THEN 'no prompt content' END AS error FROM m""",
    "rendered_prompts": "SELECT conv_id::VARCHAR AS record_id, coalesce(string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE text <> '' AND role <> 'assistant'), '') AS prompt FROM conversations GROUP BY 1",
    "content_ref_lookup": "SELECT conv_id, turn, sha256(d.text) AS value_sha256 FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id % 400",
    "content_ref_json": """WITH f AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN concat_ws(chr(10), nullif(text, ''), 'b') WHEN 1 THEN 'user: ' || concat_ws(chr(10), nullif(text, ''), 'q') WHEN 2 THEN text
        WHEN 3 THEN concat_ws(chr(10), nullif(text, ''), lang) ELSE '{"a": "' || lang || '", "z": 1}' END AS value FROM documents)
      SELECT conv_id, turn, sha256(value) AS value_sha256 FROM conversations LEFT JOIN f ON doc_id = conv_id % 400""",
    "dpo_pairs": f"""WITH {EVENTS}, u AS (SELECT user_id, value AS score, event_id AS item FROM e WHERE status <> 'error'),
      r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score, item) AS up, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item DESC) AS down, count(*) OVER (PARTITION BY user_id) AS candidates FROM u)
      SELECT user_id, max(item) FILTER (WHERE down = 1) AS chosen, max(item) FILTER (WHERE up = 1) AS rejected, max(score) AS chosen_score, min(score) AS rejected_score, max(candidates) AS candidates FROM r GROUP BY 1 HAVING max(score) - min(score) > 1.0""",
    "dpo_rows": """SELECT conv_id::VARCHAR AS record_id, conv_id::VARCHAR AS task_id, coalesce(string_agg(role || ': ' || text, chr(10) || chr(10) ORDER BY turn) FILTER (WHERE text <> '' AND role <> 'assistant'), '') AS prompt,
      'yes' AS chosen, 'no' AS rejected, false AS prompt_is_list, false AS chosen_is_list, false AS rejected_is_list FROM conversations GROUP BY 1, 2""",
    "group_advantage": f"WITH {EVENTS} SELECT event_id, user_id, round((value - avg(value) OVER w) / (stddev_pop(value) OVER w + 1e-6), 6) AS advantage FROM e WINDOW w AS (PARTITION BY user_id)",
    "holdout_exclusion": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text <> '' AND contains(d.text, b.text))",
    "holdout_identity": """SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE b.text <> '' AND contains(d.text, b.text))
      AND NOT EXISTS (SELECT 1 FROM benchmark b WHERE d.doc_id // 3 = b.item_id AND d.lang = CASE WHEN b.item_id % 2 = 0 THEN 'en' WHEN b.item_id % 3 = 0 THEN 'de' END)""",
    "links_seen_first": f"""WITH {LINKS}, r AS (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM resolved WHERE NOT contains(lower(href), 'the,'))
      SELECT page_url, pos, url, title FROM r WHERE turn = 1 AND regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) = regexp_extract(base, '^[a-z]+://([^/?#]*)', 1) AND length(title) >= 3""",
    "links_title_first": f"""WITH {LINKS}, r AS (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM resolved WHERE regexp_matches(href, '^/[a-z]+') AND length(title) >= 3)
      SELECT page_url, pos, url, title FROM r WHERE turn = 1""",
    "dedupe_items": f"WITH {LINKS} SELECT href, page_url, pos FROM (SELECT *, row_number() OVER (PARTITION BY href ORDER BY page_url, pos) AS turn FROM links WHERE href <> '') WHERE turn = 1",
    "finding_links": f"""WITH {LINKS}, f AS (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM resolved
        WHERE length(title) >= 3 AND (contains(lower(href), '/issues/') OR contains(lower(href), '/findings/') OR contains(lower(href), '/checklist/') OR contains(lower(href), '/report/'))),
      g AS (SELECT *, row_number() OVER (PARTITION BY page_url ORDER BY pos) AS place FROM f WHERE turn = 1) SELECT page_url, url FROM g WHERE place <= 5""",
    "report_envelope": "SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS source, count(*) AS count, string_agg(page_id::VARCHAR, ',' ORDER BY page_id) AS page_ids FROM pages GROUP BY 1",
    "raw_landing_names": r"""SELECT page_id, 'page_' || left(md5(url), 12) || '.html' AS landing_name, left(trim(regexp_replace(url, '[<>:"/\\|?*]', '_', 'g'), '. '), 255) AS file_name FROM pages""",
    "slugs": f"""WITH {FILES} SELECT doc_id, left(trim(regexp_replace(rel_path, '[^A-Za-z0-9._-]+', '_', 'g'), '_'), 24) AS slug,
      CASE WHEN length(rel_path) <= 16 THEN rel_path ELSE '...' || right(rel_path, 13) END AS short, {SIZE.format('(size_bytes * 1000)')} AS size_text FROM files""",
    "swc_ids": """SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR doc_id % 2 = 0 THEN 'SWC-' || doc_id END AS swc_id,
      'SC' || CASE WHEN doc_id % 120 < 10 THEN '0' ELSE '' END || doc_id % 120 AS sc_id FROM documents""",
    "clone_status_summary": f"""WITH {CLONES} SELECT category, priority, count(*) AS total, count(*) FILTER (WHERE status = 'cloned') AS cloned, count(*) FILTER (WHERE status = 'updated') AS updated,
      count(*) FILTER (WHERE status IN ('cloned', 'updated')) AS success, count(*) FILTER (WHERE status = 'failed') AS failed FROM clones GROUP BY GROUPING SETS ((category), (priority), ())""",
    "clone_errors": f"WITH {CLONES} SELECT name AS repo, count(*) AS n FROM clones WHERE error IS NOT NULL GROUP BY 1",
    "registry_summary": f"""WITH {PARTS} SELECT source_type, category, count(*) AS total, count(*) FILTER (WHERE priority = 'high') AS high, count(*) FILTER (WHERE priority = 'medium') AS medium,
      count(*) FILTER (WHERE priority = 'low') AS low FROM parts GROUP BY ROLLUP (source_type, category)""",
    "registry_filter": f"WITH {PARTS} SELECT name, source_type, position FROM parts WHERE category = 'Brand#7' AND priority = 'high'",
    "registry_categories": f"WITH {PARTS} SELECT DISTINCT category FROM parts",
    "invalid_categories": f"WITH {PARTS} SELECT DISTINCT 'Brand#' || n_nationkey AS category FROM nation WHERE 'Brand#' || n_nationkey NOT IN (SELECT category FROM parts)",
    "download_rollup": "SELECT s_nationkey % 5 AS phase, count(*) AS total, count(*) FILTER (WHERE s_acctbal > 0) AS success, count(*) FILTER (WHERE NOT s_acctbal > 0) AS failed, bool_and(s_acctbal > 0) AS all_success FROM supplier GROUP BY 1",
    "extension_histogram": "SELECT CASE doc_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '.sol' WHEN 2 THEN '.gz' ELSE 'no_extension' END AS extension, count(*) AS n FROM documents GROUP BY 1",
    "directory_totals": f"WITH {FILES}, t AS (SELECT split_part(rel_path, '/', 1) AS directory, count(*) AS file_count, sum(size_bytes)::BIGINT AS total_bytes FROM files GROUP BY 1) SELECT *, {SIZE.format('total_bytes')} AS total_size FROM t",
    "dataset_status": "SELECT n_nationkey AS dataset, n_name AS name, n IS NOT NULL AS downloaded, n AS file_count FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier WHERE s_nationkey < 20 GROUP BY 1) ON n_nationkey = s_nationkey",
    "budget_phases": f"WITH {PHASES} SELECT name, category, gpu_count, round(gpu_count * hours, 4) AS gpu_hours, round(gpu_count * hours * 6.2496::DOUBLE, 4) AS cost_usd FROM phases",
    "budget_totals": f"""WITH {PHASES}, t AS (SELECT sum(gpu_count * hours) AS planned, sum(gpu_count * hours * 6.2496::DOUBLE) AS cost, 1000000.0::DOUBLE / 6.2496::DOUBLE AS bought FROM phases)
      SELECT round(planned, 4) AS planned_hours, round(cost, 4) AS planned_cost_usd, round(bought, 4) AS purchased_hours, round(bought - planned, 4) AS reserve_hours, bought < planned AS over_budget FROM t""",
    "exact_dedup": "SELECT sha256(text) AS text_sha256, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1",
    "prf_by_bucket": f"""WITH {PRED}, c AS (SELECT lang, count(*) FILTER (WHERE quality = 1 AND score >= 0.5) AS tp, count(*) FILTER (WHERE quality <> 1 AND score >= 0.5) AS fp,
        count(*) FILTER (WHERE quality = 1 AND score < 0.5) AS fn, count(*) FILTER (WHERE quality <> 1 AND score < 0.5) AS tn FROM pred GROUP BY 1),
      p AS (SELECT *, tp / greatest(1, tp + fp)::DOUBLE AS p, tp / greatest(1, tp + fn)::DOUBLE AS r, fp / greatest(1, fp + tn)::DOUBLE AS f FROM c)
      SELECT lang, tp, fp, fn, tn, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS fpr, round(2 * p * r / greatest(1e-9, p + r), 6) AS f1 FROM p""",
    "brier_ece": f"""WITH {PRED}, b AS (SELECT least(10, floor(score * 10) + 1) AS bin, count(*) AS n, avg(quality) AS acc, avg(score) AS conf, sum((score - quality) ** 2) AS sq FROM pred GROUP BY 1)
      SELECT round(sum(sq) / sum(n), 6) AS brier, round(sum(n * abs(acc - conf)) / sum(n), 6) AS ece FROM b""",
    "selective_risk": f"""WITH {PRED} SELECT threshold::DOUBLE AS threshold, round(count(*) FILTER (WHERE score >= threshold) / count(*)::DOUBLE, 6) AS coverage,
      round(avg(CASE WHEN quality = 0 THEN 1.0::DOUBLE ELSE 0 END) FILTER (WHERE score >= threshold), 6) AS risk FROM pred, (VALUES (0.25), (0.5), (0.75)) t(threshold) GROUP BY 1""",
    "recall_at_k": f"""WITH {PRED}, r AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM pred), t AS (SELECT sum(toxic) AS positives, count(*) AS total FROM pred),
      h AS (SELECT k, sum(toxic)::BIGINT AS hits FROM r, (VALUES (10), (50), (100)) v(k) WHERE rank <= k GROUP BY 1)
      SELECT k::INT AS k, hits, round(hits / greatest(1, positives)::DOUBLE, 6) AS recall, round(hits / greatest(1, positives)::DOUBLE / (k / total::DOUBLE), 6) AS enrichment, round(1 - k / total::DOUBLE, 6) AS replay_savings FROM h, t""",
    "first_divergence": f"WITH {DIVERGENCE} SELECT * FROM div",
    "survival_at_k": f"WITH {DIVERGENCE} SELECT k::INT AS k, round(avg(CASE WHEN first_divergence IS NULL OR first_divergence > k THEN 1.0::DOUBLE ELSE 0 END), 6) AS survival FROM div, (VALUES (1), (5), (10), (20)) v(k) GROUP BY 1",
    "temporal_holdout": """WITH d AS (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1),
      s AS (SELECT day, sum(n) OVER (ORDER BY day DESC) <= 0.2 * sum(n) OVER () AS newest FROM d)
      SELECT CASE WHEN newest THEN 'evaluate' ELSE 'train' END AS split, count(*) AS n, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders JOIN s ON o_orderdate::DATE = day GROUP BY 1""",
    "acceptance_gates": f"""WITH {PRED}, b AS (SELECT least(10, floor(score * 10) + 1) AS bin, count(*) AS n, avg(quality) AS acc, avg(score) AS conf, sum((score - quality) ** 2) AS sq FROM pred GROUP BY 1),
      m AS (SELECT sum(sq) / sum(n) AS brier, sum(n * abs(acc - conf)) / sum(n) AS ece FROM b)
      SELECT 'brier' AS metric, 0.5::DOUBLE AS threshold, brier <= 0.5 AS passed FROM m UNION ALL SELECT 'ece', 0.2, ece <= 0.2 FROM m UNION ALL SELECT 'recall', 0.8, false""",
    "split_counts": "SELECT CASE WHEN doc_id % 10 = 0 THEN 'validation' ELSE 'train' END AS split, count(*) AS n, count(DISTINCT source) AS labels FROM documents GROUP BY 1",
    "embedding_topk": """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
      p AS (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.x, v.x) AS cosine FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0),
      r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS rank FROM p) SELECT query_id, rank::INT AS rank, vec_id, round(cosine, 6) AS cosine FROM r WHERE rank <= 5""",
    "mix_quota": """WITH q(lang, quota) AS (VALUES ('en', 50), ('de', 20), ('fr', 20), ('es', 10)),
      r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5(doc_id::VARCHAR), doc_id) AS turn FROM documents)
      SELECT doc_id, lang FROM r JOIN q USING (lang) WHERE turn <= quota""",
    "seeded_sample": "SELECT doc_id FROM documents ORDER BY md5('7/' || doc_id), doc_id LIMIT 20",
    "link_hosts": f"WITH {LINKS}, h AS (SELECT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(base, '^[a-z]+://([^/?#]*)', 1) AS own FROM resolved) SELECT host, host = own AS same, count(*) AS n FROM h GROUP BY 1, 2",
    "offset_limit": "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 20 OFFSET 30",
    "pagination_chain": """WITH RECURSIVE edges AS (SELECT a.url, b.url AS next_url FROM pages a JOIN pages b ON a.page_id = (b.page_id + 7) % (SELECT count(*) FROM pages)),
      c AS (SELECT url AS start, url, 1 AS step, [url] AS seen FROM pages
        UNION ALL SELECT start, next_url, step + 1, list_append(seen, next_url) FROM c JOIN edges USING (url) WHERE step < 6 AND NOT list_contains(seen, next_url))
      SELECT start, url, step FROM c""",
    "pagination_template": "SELECT 'https://example.com/list?page=' || i AS url, i AS page FROM range(1, 13) t(i)",
    "severity_counts": r"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all('H-0' || doc_id % 7 || ' then M-1 and ' || text, '\b([HMLQG])-\d{1,3}\b', 1)) AS severity FROM documents)
      SELECT doc_id, severity, count(*) AS n FROM t GROUP BY 1, 2""",
    "inverted_index": r"""WITH t AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term FROM documents)
      SELECT term, count(DISTINCT doc_id) AS documents, count(*) AS occurrences FROM t WHERE term <> '' GROUP BY 1""",
    "search_phrase": r"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM documents), p AS (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM t)
      SELECT doc_id, count(*) AS occurrences, min(i) - 1 AS first FROM p WHERE w[i] = 'of' AND w[i + 1] = 'the' GROUP BY 1""",
    "search_topk": r"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS w FROM documents), n AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM t),
      f AS (SELECT doc_id, len(w) AS length, term, len(list_filter(w, lambda x: x = term)) AS tf FROM t, (VALUES ('the'), ('of'), ('and'), ('de'), ('unseenword')) q(term)),
      df AS (SELECT term, count(*) AS df FROM f WHERE tf > 0 GROUP BY 1),
      s AS (SELECT doc_id, round(sum(ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / mean))), 6) AS score FROM f JOIN df USING (term), n WHERE tf > 0 GROUP BY 1)
      SELECT row_number() OVER (ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM s QUALIFY rank <= 20""",
    "duplication_risk": """WITH t AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL), n AS (SELECT source, count(*) AS items FROM t GROUP BY 1),
      s AS (SELECT x.source AS a, y.source AS b, count(*) AS shared FROM t x JOIN t y ON x.text = y.text AND x.source < y.source GROUP BY 1, 2)
      SELECT p.source AS a, q.source AS b, p.items AS items_a, q.items AS items_b, coalesce(shared, 0) AS shared, round(coalesce(shared, 0) / least(p.items, q.items)::DOUBLE, 6) AS risk
      FROM n p JOIN n q ON p.source < q.source LEFT JOIN s ON a = p.source AND b = q.source""",
    "evidence_pages": f"""WITH {FILES}, {PAGES}, f AS (SELECT doc_id AS pdf_id, unnest([1, page_count]) AS page_number FROM files WHERE page_count > 1)
      SELECT pdf_id, count(*) AS pages, sum(length(text))::BIGINT AS chars FROM f JOIN store ON pdf_id = doc_id AND f.page_number = store.page_number GROUP BY 1""",
    "distances": """WITH x AS (SELECT l_returnflag, l_extendedprice AS a, l_extendedprice * (1 - l_discount) AS b FROM lineitem)
      SELECT l_returnflag, round(avg(least(1.0, abs(a - b) / greatest(1.0, abs(a)))), 8) AS error, round(avg(abs(a - b) / greatest(1.0, abs(a))), 8) AS relative, count(*) FILTER (WHERE sign(a) = sign(b)) AS same_sign FROM x GROUP BY 1""",
    "stream_status_counts": f"WITH {EVENTS} SELECT status, count(*) AS n FROM e GROUP BY 1",
    "page_records": f"""WITH {FILES}, {PAGES} SELECT 'p' || s.doc_id AS pdf_id, page_number, CASE WHEN s.doc_id % 3 <> 0 AND s.doc_id % 2 = 0 THEN 'f' || s.doc_id ELSE 'doc_' || s.doc_id || '.pdf' END AS source_filename,
      page_count AS source_page_count, sha256(rel_path) AS source_pdf_sha256, CASE WHEN s.doc_id % 2 = 0 THEN 'm-1' ELSE 'm' END AS ocr_model_version, sha256(coalesce(text, '')) AS text_sha256, 0 AS n_warnings,
      'd' || s.doc_id || '/' || raw_file AS raw_response_ref, (CASE WHEN s.doc_id % 4 = 0 THEN position WHEN s.doc_id % 5 = 0 THEN 7 ELSE -1 END)::BIGINT AS total_ms FROM store s JOIN files f ON s.doc_id = f.doc_id""",
    "content_text": """SELECT conv_id, turn, CASE turn % 5 WHEN 0 THEN CASE WHEN text = '' THEN role ELSE text || chr(10) || role END WHEN 1 THEN CASE WHEN text = '' THEN role ELSE text || chr(10) || role END
      WHEN 2 THEN '' WHEN 3 THEN turn::VARCHAR ELSE role END AS content FROM conversations""",
    "report_links": f"""WITH {SITE}, r AS (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM here WHERE title <> '' AND starts_with(href, '/reports/'))
      SELECT page_url, pos, url, title FROM r WHERE turn = 1""",
    "contest_links": f"""WITH {SITE}, r AS (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM here WHERE length(title) >= 3 AND starts_with(href, '/contests/') AND href <> '/contests/')
      SELECT page_url, pos, url, title FROM r WHERE turn = 1""",
    "contest_links_short": f"""WITH {SITE}, r AS (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM here WHERE length(title) >= 3 AND (starts_with(href, '/contests/c') OR starts_with(href, '/c/')))
      SELECT page_url, pos, url, title FROM r WHERE turn = 1""",
    "bounty_links": f"""WITH {SITE}, n AS (SELECT page_url, pos, url, regexp_replace(CASE WHEN length(title) < 2 THEN coalesce(heading, '') ELSE text END, '^\\s+|\\s+$', '', 'g') AS title FROM here WHERE starts_with(href, '/bug-bounty/')),
      r AS (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM n) SELECT page_url, pos, url, title FROM r WHERE turn = 1 AND length(title) >= 3""",
    "documentation_links": f"""WITH {SITE}, r AS (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM here WHERE title <> '' AND (starts_with(href, '/docs/') OR href IN ('/reports/r0', '/reports/r1')))
      SELECT page_url, pos, url, title FROM r WHERE turn = 1""",
    "pdf_links": f"WITH {SITE} SELECT page_url, string_agg(DISTINCT url, ' ' ORDER BY url) AS pdf_links FROM here WHERE ends_with(href, '.PDF') GROUP BY 1",
    "article_links": f"""WITH {SITE}, one AS (SELECT page_url, pos, url, coalesce(nullif(heading, ''), title) AS title, row_number() OVER (PARTITION BY page_url, block ORDER BY pos) AS turn FROM here WHERE block IS NOT NULL),
      kept AS (SELECT page_url, pos, url, title FROM (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS place FROM one WHERE turn = 1 AND length(title) >= 4) WHERE place = 1),
      plain AS (SELECT page_url, pos, url, title FROM (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM here) WHERE turn = 1 AND length(title) >= 4)
      SELECT * FROM kept UNION ALL SELECT * FROM plain WHERE page_url NOT IN (SELECT page_url FROM kept)""",
    "post_links": f"""WITH {SITE}, one AS (SELECT page_url, pos, url, CASE WHEN block % 2 = 0 THEN coalesce(nullif(heading, ''), title) ELSE title END AS title, row_number() OVER (PARTITION BY page_url, block ORDER BY pos) AS turn FROM here WHERE block IS NOT NULL),
      kept AS (SELECT page_url, pos, url, title FROM (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS place FROM one WHERE turn = 1 AND length(title) >= 6) WHERE place = 1),
      plain AS (SELECT page_url, pos, url, title FROM (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM here) WHERE turn = 1 AND length(title) >= 6)
      SELECT * FROM kept UNION ALL SELECT * FROM plain WHERE page_url NOT IN (SELECT page_url FROM kept)""",
    "swc_entries": f"""WITH {SITE}, x AS (SELECT page_url, pos, base || CASE WHEN pos % 4 = 1 THEN '/docs/SWC-' || pos ELSE '/docs/' || pos % 9 END AS url, CASE WHEN pos % 4 = 0 THEN 'swc ' || (pos + 100) ELSE title END AS title,
        CASE pos % 4 WHEN 0 THEN 'SWC-' || (pos + 100) WHEN 1 THEN 'SWC-' || pos END AS swc_id FROM here),
      f AS (SELECT swc_id, title, url FROM (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM x WHERE swc_id IS NOT NULL) WHERE turn = 1)
      SELECT * FROM f UNION ALL SELECT 'SWC-' || n_nationkey, n_name, 'https://known/' || n_nationkey FROM nation WHERE 'https://known/' || n_nationkey NOT IN (SELECT url FROM f)""",
    "top_entries": f"""WITH {SITE}, x AS (SELECT page_url, pos, CASE WHEN pos % 5 = 0 THEN '/top/sc' || pos ELSE '/docs/' || pos % 9 END AS href, base, CASE WHEN pos % 3 = 0 THEN 'SC' || pos % 12 || ' thing' ELSE title END AS title,
        CASE WHEN pos % 3 = 0 THEN 'SC' || CASE WHEN pos % 12 < 10 THEN '0' ELSE '' END || pos % 12 END AS sc_id FROM here),
      f AS (SELECT sc_id, title, base || href AS url FROM (SELECT *, row_number() OVER (PARTITION BY page_url, base || href ORDER BY pos) AS turn FROM x WHERE title <> '' AND (sc_id IS NOT NULL OR pos % 5 = 0)) WHERE turn = 1)
      SELECT * FROM f UNION ALL SELECT NULL, 'Heading', url || '#s' || page_id FROM pages WHERE page_id % 4 <> 0 AND url || '#s' || page_id NOT IN (SELECT url FROM f)""",
    "section_bodies": """SELECT url AS page_url, 's' || i AS section_id, 't' || page_id AS title, length(html)::INT AS body FROM (SELECT *, unnest(range(0, page_id % 4 + 1)) AS i FROM pages) WHERE (page_id + i) % 3 <> 0""",
    "response_complete": "SELECT doc_id, doc_id % 6 > 3 AS complete FROM documents",
    "file_kinds": """WITH k AS (SELECT doc_id, (['.pdf', '.PDF', '.png', '.jpg', '.jpeg', '.webp'])[doc_id % 6 + 1] AS suffix FROM documents)
      SELECT 'a/b.c/' || doc_id || suffix AS path, CASE WHEN lower(suffix) = '.pdf' THEN 'pdf' ELSE 'image' END AS kind,
        CASE lower(suffix) WHEN '.pdf' THEN 'application/pdf' WHEN '.png' THEN 'image/png' WHEN '.webp' THEN 'image/webp' ELSE 'image/jpeg' END AS mime FROM k""",
    "budget_lines": f"""WITH {PHASES} SELECT name, format('{{:<28s}} {{:4d}} x {{:8.2f}} h = {{:10.2f}} h  ${{:12.2f}}', name, gpu_count, hours, gpu_count * hours, gpu_count * hours * 6.2496::DOUBLE) AS line FROM phases""",
    "source_json": f"""WITH {PARTS} SELECT name, source_type, '{{"name":"' || name || '","source_type":"' || source_type || CASE WHEN position % 5 <> 0 THEN '","category":"' || category ELSE '' END || '","priority":"' || priority || '","position":' || position || '}}' AS source FROM parts""",
    "generic_articles": f"""WITH {SITE}, k AS (SELECT *, CASE WHEN block IS NOT NULL AND under = 'h2' THEN 0 WHEN block IS NOT NULL AND under = 'h1' THEN 1 WHEN under IS NOT NULL THEN 2 WHEN block IS NOT NULL THEN 3 END AS rank FROM here WHERE length(title) >= 3),
      r AS (SELECT *, row_number() OVER (PARTITION BY page_url, href ORDER BY rank, pos) AS turn FROM k WHERE rank IS NOT NULL) SELECT page_url, pos, url, title FROM r WHERE turn = 1""",
    "link_details": f"""WITH {SITE}, r AS (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY pos) AS turn FROM here WHERE title <> '' AND starts_with(href, '/reports/'))
      SELECT page_url, url, 'site' AS source, 'audits' AS category, title AS listing_title, CASE WHEN right(url, 1) IN ('0', '2') THEN length(url)::INT END AS content,
        CASE WHEN right(url, 1) NOT IN ('0', '2') THEN 'detail page missing' END AS error FROM r WHERE turn = 1""",
    "set_scores": """WITH s AS (SELECT l_orderkey, list(DISTINCT l_partkey % 7) AS e, list(DISTINCT l_suppkey % 7) AS a FROM lineitem GROUP BY 1),
      p AS (SELECT l_orderkey, len(list_intersect(e, a)) / greatest(1, len(a))::DOUBLE AS p, len(list_intersect(e, a)) / greatest(1, len(e))::DOUBLE AS r FROM s)
      SELECT l_orderkey, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / greatest(1e-9, p + r), 6) AS f1 FROM p""",
    "simulator_rewards": """WITH x AS (SELECT *, 0.7::DOUBLE * least(1.0::DOUBLE, abs(l_extendedprice - l_extendedprice * (1 - l_discount)) / greatest(1.0::DOUBLE, abs(l_extendedprice))) + 0.3::DOUBLE * l_tax AS away FROM lineitem)
      SELECT l_orderkey, l_linenumber, round(away, 6) AS distance, round(1 - away / 2.0::DOUBLE, 6) AS fidelity,
        1.0::DOUBLE + CASE WHEN l_discount > 0.05::DOUBLE THEN 0.5 ELSE 0 END + CASE WHEN l_returnflag = 'R' THEN 0.25 ELSE 0 END AS weight FROM x""",
    "detection_rewards": """WITH s AS (SELECT l_orderkey, coalesce(list(DISTINCT l_linenumber) FILTER (WHERE l_quantity > 20), []) AS a, coalesce(list(DISTINCT l_linenumber) FILTER (WHERE l_discount > 0.04::DOUBLE), []) AS b,
        max(l_returnflag) = 'R' AS correct, count(*) > 3 AS validated FROM lineitem GROUP BY 1),
      r AS (SELECT *, CASE WHEN correct THEN 1.0::DOUBLE ELSE -1 END + CASE WHEN len(a) + len(b) = 0 THEN 0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b)))::DOUBLE END AS base FROM s)
      SELECT l_orderkey, round(CASE WHEN validated THEN (base + 0.5) / 3 ELSE base / 2 END, 6) AS reward FROM r""",
    "cache_keys": "SELECT c_custkey, sha256(length(c_custkey::VARCHAR) || ':' || c_custkey || '|' || length(c_name) || ':' || c_name || '|' || length(c_mktsegment) || ':' || c_mktsegment) AS cache_key FROM customer",
    "admitted": "SELECT doc_id, 'train' AS split FROM documents WHERE doc_id % 3 = 0 AND doc_id % 5 <> 0",
    "minimum_quality": "SELECT doc_id, coalesce(n_chars > 100, false) AND coalesce(lang = 'en', false) AND doc_id % 7 <> 0 AS admissible FROM documents",
    "scored_matches": """WITH m AS (SELECT c_custkey AS pdf_id, s_suppkey AS repo_id, (s_acctbal > 5000)::INT + (abs(c_acctbal - s_acctbal) < 1000)::INT + (s_suppkey % 2 = 0)::INT AS n FROM customer JOIN supplier ON c_nationkey = s_nationkey),
      r AS (SELECT *, row_number() OVER (PARTITION BY pdf_id ORDER BY n DESC, repo_id) AS turn FROM m)
      SELECT pdf_id, repo_id, round(n / 3.0::DOUBLE, 6) AS score, CASE n WHEN 3 THEN 'exact' WHEN 2 THEN 'probable' ELSE 'weak' END AS confidence FROM r WHERE turn = 1""",
    "pdf_landing": r"""WITH l AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || '.PDF' WHEN 1 THEN split_part(split_part(url, '#', 1), '?', 1) || '.pdf' ELSE url END AS url, page_id % 4 = 2 AS served FROM pages),
      n AS (SELECT *, url IS NOT NULL AND (served OR lower(url) LIKE '%.pdf') AS is_pdf, regexp_extract(regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), '([^/]*)/*$', 1) AS name FROM l)
      SELECT page_id, is_pdf, CASE WHEN is_pdf THEN CASE WHEN lower(name) LIKE '%.pdf' THEN left(trim(regexp_replace(name, '[<>:"/\\|?*]', '_', 'g'), '. '), 255) ELSE 'document_' || left(md5(url), 12) || '.pdf' END END AS pdf_name FROM n""",
    "finding_eligibility": """SELECT doc_id, CASE WHEN doc_id % 4 = 2 THEN 'other ecosystem' WHEN NOT contains(text, 'ther') THEN 'no loss of funds' WHEN doc_id % 4 = 3 OR text IS NULL THEN 'review' ELSE 'eligible' END AS eligibility FROM documents""",
    "pdf_pages": """SELECT doc_id, CASE WHEN doc_id % 97 <> 0 THEN greatest(1, ceil(length(coalesce(text, '')) / 1800.0))::INT END AS page_count,
      CASE WHEN doc_id % 97 = 0 THEN 'no PDF header' END AS page_count_error FROM documents""",
    "sql_dump": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "finding_candidates": "SELECT l_orderkey AS pdf_id, l_suppkey % 3 AS match_id, count(*) AS findings, string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) AS severities FROM lineitem GROUP BY 1, 2",
    "normalized_records": """WITH r AS (SELECT p_brand AS source, 'vulnerability' AS type, 'SWC-' || p_size AS swc_id, NULL::VARCHAR AS cwe_id, lower(upper(p_type)) AS severity, trim(p_name) AS title, NULL::VARCHAR AS description,
        CASE WHEN p_size = 3 THEN '3' WHEN p_size < 3 THEN p_size || ',3' ELSE '3,' || p_size END AS line_numbers, 0 AS n_tags, NULL::VARCHAR AS timestamp FROM part)
      SELECT sha256(source || chr(31) || type || chr(31) || swc_id || chr(31) || chr(31) || severity || chr(31) || title || chr(31) || chr(31) || chr(31) || chr(31) || line_numbers || chr(31) || chr(31)) AS id, * FROM r""",
    "vulnerability_ids": "SELECT p_partkey, sha256(p_name || chr(31) || p_brand || chr(31) || p_size) AS id FROM part",
    "category_overlay": f"""WITH {PARTS}, c AS (SELECT 'https://example.com/' || s_suppkey AS url, CASE WHEN s_acctbal > 0 THEN 'cloned' ELSE 'failed' END AS status, CASE WHEN s_acctbal <= 0 THEN 'timed out' END AS error FROM supplier)
      SELECT name, 'https://example.com/' || position AS url, status, error FROM parts LEFT JOIN c ON c.url = 'https://example.com/' || position WHERE category = 'Brand#7' AND priority = 'high'""",
    "window_errors": """SELECT event_id, CASE WHEN event_id % 5 <= 0 THEN 'page start must be positive' WHEN event_id % 3 <> 0 AND user_id % 7 < event_id % 5 THEN 'page end lies before page start'
      WHEN event_id % 4 <= 0 THEN 'window size must be positive' END AS error FROM events""",
    "run_paths": """WITH r AS (SELECT event_id, user_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp FROM events)
      SELECT event_id, 'chunk_plan_' || stamp AS run_id, '/ocr/chunk_plan_' || stamp AS plan, '/ocr/raw/chunk_plan_' || stamp AS raw, '/ocr/artifacts/chunk_plan_' || stamp AS artifacts,
        CASE WHEN event_id % 2 = 0 THEN '/ocr/artifacts/materialized_' || stamp ELSE '/ocr/artifacts/run_' || user_id END AS artifact_root, '/ocr/logs/ocr_modal_run_' || printf('chunk_%04d', event_id % 40) || '.log' AS log_file FROM r""",
    "file_functions": """WITH f AS (SELECT doc_id, source, 'src/' || source || '/f' || doc_id || (['.sol', '.md', '.json', '.PNG', '.jpg', '.yml', '.pdf', ''])[doc_id % 8 + 1] AS path FROM documents)
      SELECT doc_id, (['solidity', 'document', 'data', 'image', 'image', 'data', 'document', 'other'])[doc_id % 8 + 1] AS kind,
        (['application/octet-stream', 'application/octet-stream', 'application/octet-stream', 'image/png', 'image/jpeg', 'application/octet-stream', 'application/pdf', 'application/octet-stream'])[doc_id % 8 + 1] AS mime,
        CASE WHEN doc_id % 2 = 0 THEN substr(path, 5) ELSE path END AS ref, source || '_a_b_' || doc_id AS directory, 'pdf_' || left(sha256(path), 16) AS stable_id, path AS base_url,
        CASE WHEN doc_id % 3 = 2 THEN source END AS setting, source || '/r' || doc_id AS repository FROM f""",
    "matching_files": f"WITH {FILES} SELECT rel_path FROM files WHERE regexp_full_match(rel_path, 'PublicReports/.*/doc_1.*[.]pdf') OR regexp_full_match(rel_path, 'misc/..*7[.]pdf')",
    "dataset_listing": "SELECT 'owner/' || p_partkey AS dataset_id FROM part WHERE p_partkey % 10 <> 0",
    "merged_totals": "SELECT o_orderkey, o_custkey AS a, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE 1 END AS b FROM orders",
    "checksum_mismatches": "SELECT doc_id AS pdf_id FROM documents WHERE doc_id % 9 IN (0, 1)",
    "phase_summary": """SELECT 'nation' AS phase, count(*) AS n, count(n_name) AS names, 0 AS balances FROM nation UNION ALL SELECT 'supplier', count(*), 0, count(s_acctbal) FROM supplier UNION ALL SELECT 'region', count(*), 0, 0 FROM region""",
    "dataset_card": f"""WITH {FILES}, t AS (SELECT count(*) AS file_count, sum(size_bytes)::BIGINT AS total FROM files), u AS (SELECT file_count, {SIZE.format('total')} AS total_size FROM t)
      SELECT file_count, total_size, array_to_string(['---', 'license: other', 'tags:', '- smart-contracts', '- security', '- audits', '- vulnerability-detection', '---', '', '# Audits', '', 'All reports.', '', '## Contents', '',
        '- Files: ' || file_count, '- Total size: ' || total_size, '- Local source root: `/audits`', '- Upload include pattern: `**/*.pdf`', '- Manifest: `manifest.csv`', '- Generated: 2024-05-06 07:08:09 UTC', '', '## Notes', '',
        'Made from a local crawl. Check the licences of the original sources before sharing these files.', ''], chr(10)) AS card FROM u""",
    "stream_sliding_calls": """WITH w AS (SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) - h * INTERVAL 30 MINUTE AS start FROM events, (VALUES (0), (1)) v(h))
      SELECT event_type, strftime(start, '%Y-%m-%d %H:%M:%S') AS start, count(*) AS calls FROM w GROUP BY 1, 2""",
}
