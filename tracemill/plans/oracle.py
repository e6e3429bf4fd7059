"""The same results stated in SQL over the same tables, for checking."""

CORPUS = """
corpus AS (
  SELECT path, regexp_extract(path, '[^/]*$') AS name, regexp_replace(path, '/[^/]*$', '') AS parent,
         strlen(body) AS length, mtime, body
  FROM (
    SELECT '/documents/' || lang || '/' || source || '/' || doc_id || '.txt' AS path, text AS body, NULL::TIMESTAMP AS mtime FROM documents
    UNION ALL SELECT '/pages/' || page_id || '.html', html, NULL FROM pages
    UNION ALL SELECT '/conversations/' || conv_id || '/' || turn || '.txt', text, NULL FROM conversations
    UNION ALL SELECT '/events/' || event_type || '/' || event_id || '.json', props, ts FROM events
  )
)"""

WORK = CORPUS + """,
hits AS (
  SELECT path, parser
  FROM corpus, (VALUES ('html', '<!DOCTYPE html'), ('markup', '<'), ('json', '{')) s(parser, magic)
  WHERE starts_with(body, magic)
),
work AS (
  SELECT path, parser FROM hits
  UNION ALL SELECT path, 'text' FROM corpus WHERE path NOT IN (SELECT path FROM hits)
  UNION ALL SELECT path, 'filestat' FROM corpus
)"""

RESULTS = WORK + """,
w AS (SELECT work.parser, corpus.* FROM work JOIN corpus USING (path)),
lines AS (
  SELECT path, generate_subscripts(l, 1) - 1 AS seq, unnest(l) AS line
  FROM (SELECT path, string_split(body, chr(10)) AS l FROM w WHERE parser = 'text')
),
results AS (
  SELECT 'event_data' AS container, path, 'filestat' AS parser, 0::BIGINT AS seq, NULL::VARCHAR AS message,
         'size' AS attr, length::VARCHAR AS val, mtime AS t FROM w WHERE parser = 'filestat'
  UNION ALL SELECT 'event_data', path, 'html', 0, NULL, 'title', regexp_extract(body, '<title>(.*?)</title>', 1), NULL FROM w WHERE parser = 'html'
  UNION ALL SELECT 'recovery_warning', path, 'html', 0, 'unterminated document', NULL, NULL, NULL FROM w WHERE parser = 'html' AND NOT contains(body, '</html>')
  UNION ALL SELECT 'event_data', path, 'markup', 0, NULL, 'tags', (length(body) - length(replace(body, '<', '')))::VARCHAR, NULL FROM w WHERE parser = 'markup'
  UNION ALL SELECT 'event_data', path, 'json/kv', 0, NULL, 'k', json_extract_string(body, '$.k'), mtime FROM w WHERE parser = 'json'
  UNION ALL SELECT 'event_data', path, 'text', seq, NULL, 'bytes', strlen(line)::VARCHAR, NULL FROM lines WHERE line <> ''
  UNION ALL SELECT 'extraction_warning', path, 'text', seq, 'line exceeds 2000 bytes', NULL, NULL, NULL FROM lines WHERE strlen(line) > 2000
)"""

ODD_FILES = """
f AS (
  SELECT '/d ' || doc_id || '%41[' || CASE doc_id % 4 WHEN 0 THEN '.gz' ELSE '.txt' END AS path,
         CASE doc_id % 3 WHEN 1 THEN replace(text, chr(10), chr(13) || chr(10)) ELSE text END AS body
  FROM documents
)"""

LOGS = """
ev AS (SELECT event_id, event_type, ts, '/logs/user_' || user_id || '.log' AS path FROM events),
streams AS (SELECT o_orderkey AS stream_id, '/logs/user_' || o_custkey || '.log' AS path FROM orders)"""

EVEN = """,
placed AS (SELECT path, length, ('0x' || substr(md5(path), 1, 15))::BIGINT AS place FROM corpus),
summed AS (
  SELECT path, length, sum(length) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)::BIGINT AS before,
         sum(length) OVER ()::BIGINT AS total
  FROM placed
),
dealt AS (SELECT path, length, least(15, floor(coalesce(before, 0) / total * 16))::INT AS bucket FROM summed)"""

BUCKET = "('0x' || substr(md5(path || '|' || parser), 1, 8))::BIGINT % 16"

_OVER_CORPUS = {
    "only_files": "SELECT path, length FROM corpus",
    "path_source": "SELECT path FROM corpus",
    "read_range": """
        SELECT path, left(hex(encode(body)), 8) AS head, right(hex(encode(body)), 8) AS tail FROM corpus""",
    "resolve_entries": """
        SELECT r.path, c.path IS NOT NULL AS present, c.length
        FROM (SELECT '/pages/' || (page_id * 2) || '.html' AS path FROM pages) r LEFT JOIN corpus c USING (path)""",
    "missing_entries": """
        SELECT path FROM (SELECT '/pages/' || (page_id * 2) || '.html' AS path FROM pages)
        WHERE path NOT IN (SELECT path FROM corpus)""",
    "list_area": """
        SELECT path, 'file' AS entry_type FROM corpus WHERE len(string_split(path, '/')) <= 3
        UNION ALL SELECT DISTINCT '/' || array_to_string(list_slice(p, 1, n), '/'), 'directory'
        FROM (SELECT string_split(substr(path, 2), '/') AS p FROM corpus), generate_series(1, 2) g(n)
        WHERE n < len(p)""",
    "list_tree": """
        SELECT parent, count(*) AS children FROM (
          SELECT DISTINCT '/' || array_to_string(list_slice(p, 1, n - 1), '/') AS parent,
                          '/' || array_to_string(list_slice(p, 1, n), '/') AS child
          FROM (SELECT string_split(substr(path, 2), '/') AS p FROM corpus), generate_series(1, 4) g(n)
          WHERE n <= len(p)
        ) GROUP BY parent""",
    "file_stat": "SELECT path, name, parent, length, 'file' AS entry_type, mtime FROM corpus",
    "event_sources": "SELECT 'FILE' AS file_entry_type, path FROM corpus",
    "data_streams": "SELECT path FROM corpus",
    "path_functions": """
        SELECT path, regexp_extract(path, '[^/]*$') AS basename,
               CASE WHEN regexp_replace(path, '/[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '/[^/]*$', '') END AS dirname,
               'file://store' || path AS uri, '/a/b' || path AS joined
        FROM corpus""",
    "unpack_names": """
        SELECT path, replace(name, '.', '_') || '_extracted' || substr(md5(path), 1, 8) AS folder,
               string_split(name, '.')[1] AS member
        FROM corpus""",
    "source_disposition": """
        SELECT path,
               CASE WHEN name LIKE '%.html' THEN 'drop' WHEN starts_with(path, '/documents/') THEN 'move' ELSE 'keep' END AS disposition,
               CASE WHEN starts_with(path, '/documents/') THEN '/processed/' || substr(path, 12) ELSE path END AS out_path
        FROM corpus""",
    "land_files": "SELECT path, length, md5(body) AS digest FROM corpus",
    "display_names": """
        SELECT path, path AS display_name, path AS relative_path, 'file' AS entry_type FROM corpus
        UNION ALL SELECT DISTINCT p, p, p, 'directory' FROM (
          SELECT '/' || array_to_string(list_slice(s, 1, n), '/') AS p
          FROM (SELECT string_split(substr(path, 2), '/') AS s FROM corpus), generate_series(0, 4) g(n)
          WHERE n < len(s)
        )""",
}

_OVER_EVEN = {
    "spread_by_bytes": "SELECT path, length, bucket FROM dealt",
    "byte_stats": """
        SELECT min(n) AS min_bytes, max(n) AS max_bytes, avg(n) AS avg_bytes, max(largest) AS largest_row, count(*) AS partitions,
               max(n) <= avg(n) + max(largest) AS even
        FROM (SELECT g.b, coalesce(sum(length), 0)::BIGINT AS n, coalesce(max(length), 0) AS largest
              FROM generate_series(0, 15) g(b) LEFT JOIN dealt ON bucket = g.b GROUP BY g.b)""",
}

_OVER_WORK = {
    "signature_match": "SELECT path, parser FROM hits",
    "signature_match_table": "SELECT path, parser FROM hits",
    "signature_split": "SELECT (path IN (SELECT path FROM hits)) AS has_signature, count(*) AS files FROM corpus GROUP BY 1",
    "assign_nonsig": """
        SELECT path, p.parser FROM corpus, (VALUES ('text'), ('filestat')) p(parser)
        WHERE path NOT IN (SELECT path FROM hits)""",
    "filter_extractors": "SELECT path, parser FROM work WHERE parser <> 'markup'",
    "work_items": "SELECT path, parser FROM work",
    "repartition_buckets": f"SELECT path, parser, ({BUCKET})::INT AS bucket FROM work",
    "partition_sizes": f"""
        SELECT g.b::INT AS partition, count(w.path) AS rows FROM generate_series(0, 15) g(b)
        LEFT JOIN (SELECT path, {BUCKET} AS b FROM work) w ON w.b = g.b GROUP BY g.b""",
    "partition_stats": f"""
        SELECT min(n) AS min_rows, max(n) AS max_rows, avg(n) AS avg_rows, count(*) AS partitions FROM (
          SELECT g.b, count(w.path) AS n FROM generate_series(0, 15) g(b)
          LEFT JOIN (SELECT path, {BUCKET} AS b FROM work) w ON w.b = g.b GROUP BY g.b
        )""",
}

_OVER_RESULTS = {
    "unknown_extractor": """
        SELECT a.parser, a.items, coalesce(d.events, 0) AS events
        FROM (SELECT parser, count(*) AS items FROM (
                SELECT parser FROM work UNION ALL SELECT 'no_such_parser' FROM corpus) GROUP BY parser) a
        LEFT JOIN (SELECT string_split(parser, '/')[1] AS parser, count(*) AS events FROM results
                   WHERE container = 'event_data' GROUP BY 1) d USING (parser)""",
    "extract_results": "SELECT container, path, parser, seq, message, attr, val, t FROM results",
    "filestat_events": "SELECT path, val AS size, t AS mtime FROM results WHERE parser = 'filestat'",
    "extraction_warnings": "SELECT path, parser AS parser_chain, seq, message FROM results WHERE container = 'extraction_warning'",
    "recovery_warnings": "SELECT path, parser AS parser_chain, seq, message FROM results WHERE container = 'recovery_warning'",
    "partial_results": """
        SELECT path, rows_kept, errors FROM (
          SELECT path, count(*) FILTER (line <> '' AND (stop IS NULL OR seq < stop)) AS rows_kept,
                 count(DISTINCT stop) AS errors
          FROM lines LEFT JOIN (SELECT path, min(seq) AS stop FROM lines WHERE strlen(line) > 2000 GROUP BY path) USING (path)
          GROUP BY path
        ) WHERE rows_kept + errors > 0""",
    "results_timeline": """
        SELECT path, parser, seq, CASE WHEN t IS NULL THEN 'Not a time' ELSE 'Modification Time' END AS timestamp_desc, t AS timestamp
        FROM results WHERE container = 'event_data'""",
    "route_containers": "SELECT container, count(*) AS rows FROM results GROUP BY container",
    "run_summary": """
        SELECT count(*) FILTER (container = 'event_data') AS events,
               count(*) FILTER (container = 'extraction_warning') AS warnings,
               count(*) FILTER (container = 'recovery_warning') AS recovery
        FROM results""",
    "warning_counts": """
        SELECT parser AS parser_chain, container, count(*) AS n FROM results WHERE container <> 'event_data' GROUP BY ALL""",
    "parser_counts": """
        SELECT parser AS name, count(*) AS number_of_events FROM results WHERE container = 'event_data' GROUP BY parser""",
    "merge_parser_counts": """
        SELECT name, sum(n)::BIGINT AS number_of_events FROM (
          SELECT parser AS name, count(*) AS n FROM results WHERE container = 'event_data' GROUP BY 1
          UNION ALL SELECT parser, count(*) FROM results WHERE container = 'event_data' AND t IS NOT NULL GROUP BY 1
          UNION ALL SELECT * FROM (VALUES ('filestat', 5), ('legacy', 7)) o(name, n)
        ) GROUP BY name""",
    "parser_chain": """
        SELECT parser AS chain, string_split(parser, '/')[1] AS root, len(string_split(parser, '/'))::INT AS depth, count(*) AS n
        FROM results GROUP BY ALL""",
    "extract_tally": "SELECT count(*) AS events FROM results",
    "session_record": """
        SELECT n AS ordinal, string_split('html,json,text,filestat', ',')[n] AS enabled_parser, number_of_events
        FROM generate_series(1, 4) g(n)
        JOIN (SELECT string_split(parser, '/')[1] AS root, count(*) AS number_of_events FROM results
              WHERE container = 'event_data' GROUP BY 1) ON root = string_split('html,json,text,filestat', ',')[n]""",
    "json_events": "SELECT container, path, parser, seq, message, attr, val, t FROM results",
    "write_containers": """
        SELECT 'event_source' AS container, count(*) AS rows FROM corpus
        UNION ALL SELECT 'event_data_stream', count(*) FROM corpus
        UNION ALL SELECT container, count(*) FROM results GROUP BY container
        UNION ALL SELECT 'timeline', count(*) FROM results WHERE container = 'event_data'
        UNION ALL SELECT 'parser_count', count(DISTINCT parser) FROM results WHERE container = 'event_data'""",
}

_OVER_RESULTS["atomic_sessions"] = """
    SELECT 'kept' AS session_id, container, path, parser, seq, message, attr, val FROM results
    UNION ALL SELECT 'rewritten', container, path, parser, seq, message, attr, val FROM results WHERE parser = 'filestat'"""

_OVER_RESULTS["stored_run"] = """,
n AS (
  SELECT count(*) FILTER (container = 'event_data') AS events, count(*) FILTER (container = 'extraction_warning') AS warnings,
         count(*) FILTER (container = 'recovery_warning') AS recovery, count(*) AS everything FROM results
)
    SELECT 'response' AS part, 'number of events' AS name, events::VARCHAR AS value FROM n
    UNION ALL SELECT 'response', 'number of warnings', warnings::VARCHAR FROM n
    UNION ALL SELECT 'response', 'number of recovery', recovery::VARCHAR FROM n
    UNION ALL SELECT 'completion', 'events', events::VARCHAR FROM n
    UNION ALL SELECT 'completion', 'warnings', warnings::VARCHAR FROM n
    UNION ALL SELECT 'completion', 'recovery', recovery::VARCHAR FROM n
    UNION ALL SELECT 'dry run', 'events', everything::VARCHAR FROM n
    UNION ALL SELECT 'dry run', 'partitions', '16'
    UNION ALL SELECT 'session', unnest(['start', 'system', 'completion']), '1'
    UNION ALL SELECT 'kept', parser, count(*)::VARCHAR FROM results WHERE container = 'event_data' GROUP BY parser"""

_OVER_RESULTS["long_signed_files"] = """,
objects AS (
  SELECT '/objects/' || (doc_id // 64) || '.json' AS path, count(*)::INT AS n,
         md5(string_agg(doc_id || '=' || text, ';' ORDER BY doc_id || '=' || text)) AS digest
  FROM documents GROUP BY 1
)
    SELECT container, path, parser, seq, message, (attr IS NOT NULL)::INT AS n, md5(coalesce(attr || '=' || val, '')) AS digest
    FROM results WHERE path LIKE '/pages/%' AND parser <> 'filestat'
    UNION ALL SELECT 'event_data', path, 'json/kv', 0, NULL, n, digest FROM objects"""

_OVER_LOGS = {
    "event_stream_join": """
        SELECT e.event_id, e.path, s.stream_id, s.path AS stream_path
        FROM ev e LEFT JOIN (SELECT path, min(stream_id) AS stream_id FROM streams GROUP BY path) s ON s.path = e.path""",
    "emitted_streams": "SELECT stream_id, path FROM streams WHERE path IN (SELECT path FROM ev)",
    "stream_runs": """
        SELECT event_type, event_id, path FROM (
          SELECT *, lag(path) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS prev FROM ev
        ) WHERE prev IS DISTINCT FROM path""",
    "stream_runs_global": """
        SELECT event_id, path FROM (SELECT *, lag(path) OVER (ORDER BY ts, event_id) AS prev FROM ev)
        WHERE prev IS DISTINCT FROM path""",
}

_OVER_TABLES = {
    "timeline": """
        WITH d AS (
          SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderdate END AS c, min(l_shipdate) AS m
          FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
        )
        SELECT o_orderkey, 'Creation Time' AS timestamp_desc, c AS timestamp FROM d WHERE c IS NOT NULL
        UNION ALL SELECT o_orderkey, 'Modification Time', m FROM d WHERE m IS NOT NULL
        UNION ALL SELECT o_orderkey, 'Not a time', NULL FROM d WHERE c IS NULL AND m IS NULL""",
    "normalize_time": """
        SELECT event_id, ts - INTERVAL 2 HOUR AS ts_utc,
               make_timestamp(2023, month(ts)::BIGINT, day(ts)::BIGINT, hour(ts)::BIGINT, minute(ts)::BIGINT,
                              (microsecond(ts) / 1000000.0)::DOUBLE) AS in_2023
        FROM events""",
    "detect_kind": """
        SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'gzip' WHEN 1 THEN 'bzip2' WHEN 2 THEN 'xz' ELSE 'plain' END AS kind
        FROM documents""",
    "decompress": "SELECT doc_id, md5(text) AS digest, strlen(text) AS length FROM documents",
    "expand_archive": """
        SELECT lang || '_' || source || '_' || (doc_id // 256) || '.zip' AS archive, doc_id || '.txt' AS member,
               strlen(text) AS length, md5(text) AS digest
        FROM documents""",
    "split_streams": """
        SELECT 'v' || (doc_id // 256) AS volume, strlen(string_agg(text || chr(10), '' ORDER BY doc_id)) AS length,
               md5(string_agg(text || chr(10), '' ORDER BY doc_id)) AS digest
        FROM documents GROUP BY doc_id // 256""",
    "unpack_recursive": "SELECT doc_id::VARCHAR AS member, 2 AS depth, md5(text) AS digest FROM documents",
    "scan_files": """
        SELECT '/turns/' || conv_id || '/' || turn || '.txt' AS path, turn || '.txt' AS name, 'file' AS entry_type,
               strlen(text) AS length, md5(text) AS digest
        FROM conversations""",
    "upload_report": """
        WITH d AS (
          SELECT doc_id, text, doc_id % 10 = 7 AS gone, '/d/uploads/' || doc_id || '.txt.packed' AS path,
                 '/d/uploads/' || doc_id || '_txt_packed_extracted' AS folder
          FROM documents
        )
        SELECT path, CASE WHEN gone THEN 'unreadable' WHEN doc_id % 4 = 3 THEN 'landed' ELSE 'unpacked' END AS outcome,
               CASE WHEN gone THEN 'could not be read' END AS warning
        FROM d WHERE doc_id % 5 <> 0
        UNION ALL SELECT '/empty/' || doc_id || '/.keep', 'landed', NULL FROM d WHERE doc_id % 5 = 0
        UNION ALL SELECT '/empty/' || doc_id, 'held', 'folder' FROM d WHERE doc_id % 5 = 0
        UNION ALL SELECT DISTINCT unnest(['/d', '/d/uploads', '/empty']), 'held', 'folder' FROM d
        UNION ALL SELECT CASE WHEN doc_id % 4 = 3 THEN path ELSE folder END, 'held', md5(text) FROM d WHERE doc_id % 5 <> 0 AND NOT gone""",
    "scan_tree": f"""
        WITH {ODD_FILES} SELECT path, strlen(body) AS length, md5(body) AS digest FROM f""",
    "long_files": f"""
        WITH {ODD_FILES},
        lines AS (
          SELECT path, generate_subscripts(l, 1) - 1 AS seq, unnest(l) AS line
          FROM (SELECT path, string_split(body, chr(10)) AS l FROM f)
        )
        SELECT 'event_data' AS container, path, 'text' AS parser, seq, NULL::VARCHAR AS message, 'bytes' AS attr, strlen(line)::VARCHAR AS val
        FROM lines WHERE line <> ''
        UNION ALL SELECT 'extraction_warning', path, 'text', seq, 'line exceeds 2000 bytes', NULL, NULL FROM lines WHERE strlen(line) > 2000
        UNION ALL SELECT 'event_data', path, 'filestat', 0, NULL, 'size', strlen(body)::VARCHAR FROM f""",
    "raising_extractors": """
        WITH f AS (
          SELECT '/documents/' || lang || '/' || source || '/' || doc_id || '.txt' AS path, strlen(text) AS n, text FROM documents
        ),
        lines AS (SELECT path, string_split(unnest(string_split(text, chr(10))), ' ') AS w FROM f),
        found AS (
          SELECT path, 'ratio' AS parser, n % 3 = 0 AS failed, 'values could not be computed' AS message FROM f
          UNION ALL SELECT path, 'strict', n % 5 = 0, 'content could not be cut' FROM f
          UNION ALL SELECT path, 'words', len(w) < 3, 'condition could not be computed' FROM lines WHERE len(w) < 3 OR w[3] <> ''
        )
        SELECT path, parser, CASE WHEN failed THEN 'extraction_error' ELSE 'event_data' END AS container,
               CASE WHEN failed THEN message END AS message, count(*) AS rows
        FROM found GROUP BY ALL""",
    "posix_times": "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN ts END AS ts FROM events",
    "text_files": """
        SELECT '/notes/' || doc_id || '.txt' AS path, strlen(body) AS length, md5(body) AS digest
        FROM (SELECT doc_id, text || ' – ž 梦' AS body FROM documents)""",
    "isolated_failures": """
        SELECT path, parser, CASE WHEN parser = 'late' AND n % 2 = 1 THEN 2 ELSE 1 END::BIGINT AS rows_kept,
               CASE WHEN parser = 'late' AND n % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS errors
        FROM (SELECT '/documents/' || lang || '/' || source || '/' || doc_id || '.txt' AS path, strlen(text) AS n FROM documents),
             (VALUES ('number'), ('late')) p(parser)""",
    "decode_text": """
        SELECT doc_id, CASE doc_id % 4 WHEN 1 THEN 'UTF-16' WHEN 0 THEN 'UTF-8' ELSE 'cp1252' END AS charset,
               CASE doc_id % 4 WHEN 2 THEN 'é' || regexp_replace(text, '[^\x00-\x7F]', 'é', 'g')
                    WHEN 3 THEN NULL ELSE text END AS text,
               CASE doc_id % 4 WHEN 3 THEN 'unable to decode text' END AS warning
        FROM documents""",
}


def _with(prelude: str, queries: dict[str, str]) -> dict[str, str]:
    return {name: f"WITH {prelude.strip()}\n{sql.strip()}" for name, sql in queries.items()}


ORACLE: dict[str, str] = {
    **_with(CORPUS, _OVER_CORPUS),
    **_with(CORPUS + EVEN, _OVER_EVEN),
    **_with(WORK, _OVER_WORK),
    **_with(RESULTS, _OVER_RESULTS),
    **_with(LOGS, _OVER_LOGS),
    **{name: sql.strip() for name, sql in _OVER_TABLES.items()},
}
