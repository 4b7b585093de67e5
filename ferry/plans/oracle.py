"""DuckDB SQL twins of the registered queries (the correctness oracle).

Each string runs on DuckDB with the driver tables registered as views and
must return the same rows as the Spark query of the same name. Derived
registry rows follow the rules of ``ferry.plans.tables``.
"""

from __future__ import annotations

TS = "'%Y-%m-%dT%H:%M:%S.%fZ'"
BOUNDARY = "TIMESTAMP '2024-01-15 00:00:00'"

_SOURCES = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'web_scraper' WHEN 'MACHINERY' THEN 'api'
            ELSE 'file_extractor' END AS type,
       CASE WHEN c_acctbal > 0 THEN '/data/customer/' || CAST(c_custkey AS VARCHAR) || '.txt'
            ELSE '' END AS raw_url,
       CAST(NULL AS VARCHAR) AS raw_path
FROM customer"""

_LOADERS = """
SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, 'json_loader' AS type,
       CAST(NULL AS VARCHAR) AS raw_url,
       CASE WHEN s_acctbal > 0 THEN '/out/' || CAST(s_suppkey AS VARCHAR) || '/' END AS raw_path
FROM supplier"""

# parsed config of a registry row: url / path of its own type, error
_PARSED = """
SELECT *, CASE WHEN type IN ('file_extractor', 'web_scraper') THEN raw_url END AS url,
       CASE WHEN type = 'json_loader' THEN raw_path END AS path,
       CASE WHEN type NOT IN ('file_extractor', 'web_scraper', 'json_loader')
              THEN 'unknown config type: ' || type
            WHEN type = 'file_extractor' AND coalesce(raw_url, '') = '' THEN 'url is required'
            WHEN type = 'web_scraper' AND coalesce(raw_url, '') = '' THEN 'URL is required'
            WHEN type = 'json_loader' AND coalesce(raw_path, '') = '' THEN 'path is required'
       END AS error
FROM ({inner})"""

_CONNS = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS source_id,
       CAST(o_orderkey % 100 AS VARCHAR) AS loader_id,
       CASE o_orderstatus WHEN 'F' THEN 'manual' WHEN 'O' THEN 'scheduled' ELSE 'hourly' END
         AS sync_type
FROM orders"""

_RESOLVED = f"""
SELECT c.id AS connection_id, c.source_id, c.loader_id, s.type AS source_type,
       l.type AS loader_type, s.url AS source_url, l.path AS loader_path,
       s.type || '_' || c.id AS queue
FROM ({_CONNS}) c
JOIN ({_PARSED.format(inner=_SOURCES)}) s ON s.id = c.source_id
JOIN ({_PARSED.format(inner=_LOADERS)}) l ON l.id = c.loader_id"""

_DOC_BYTES = "SELECT doc_id, encode(text) AS b FROM documents WHERE octet_length(encode(text)) > 0"

_DOC_CHUNKS = f"""
SELECT doc_id, seq, array_slice(b, seq * 1024 + 1, (seq + 1) * 1024) AS chunk
FROM (SELECT doc_id, b, unnest(range(0, (octet_length(b) + 1023) // 1024)) AS seq
      FROM ({_DOC_BYTES}))"""

_UNTIL_END = """
SELECT * FROM (
  SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS m
  FROM events) WHERE m = 0"""

_DEDUP_LATEST = """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id
                               ORDER BY value DESC NULLS LAST, event_id DESC) AS rn
  FROM events) WHERE rn = 1"""

ORACLE = {
    "extract_chunks": f"""
SELECT doc_id, CAST(seq AS BIGINT) AS seq, CAST(octet_length(chunk) AS BIGINT) AS n_bytes,
       md5(chunk) AS data_md5
FROM ({_DOC_CHUNKS})""",

    "envelope_json": f"""
SELECT event_id, CAST(json_object(
  'connection_id', 'events', 'queue', CAST(user_id AS VARCHAR), 'seq', event_id,
  'data', to_base64(encode(event_type)),
  'metadata', json_object('source', 'events', 'destination', 'json_loader'),
  'created_at', strftime(ts, {TS}), 'updated_at', strftime(ts, {TS}),
  'stringified_data', '', 'IsEnd', false) AS VARCHAR) AS message
FROM events""",

    "queue_roundtrip": """
SELECT doc_id, CAST((octet_length(encode(text)) + 1023) // 1024 AS BIGINT) AS n_chunks,
       CAST(octet_length(encode(text)) AS BIGINT) AS n_bytes, md5(text) AS text_md5
FROM documents WHERE octet_length(encode(text)) > 0""",

    "stringify": "SELECT doc_id, text FROM documents WHERE octet_length(encode(text)) > 0",

    "until_end": f"SELECT user_id, event_id FROM ({_UNTIL_END})",

    "queue_rejects": """
SELECT 'events' AS kind, CAST(event_id AS VARCHAR) AS key, true AS accepted,
       CAST(NULL AS VARCHAR) AS reason
FROM events
UNION ALL
SELECT 'conversations' AS kind, CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS key,
       coalesce(CASE WHEN json_valid(text) THEN json_type(text) = 'OBJECT' ELSE false END, false) AS accepted,
       CASE WHEN text IS NULL THEN 'null message'
            WHEN NOT coalesce(CASE WHEN json_valid(text) THEN json_type(text) = 'OBJECT' ELSE false END, false)
              THEN 'malformed message' END AS reason
FROM conversations""",

    "page_source": """
SELECT page_id, url, CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes
FROM pages WHERE starts_with(url, 'https://')""",

    "config_parse": f"""
SELECT 'source' AS kind, id, type, url, path, error FROM ({_PARSED.format(inner=_SOURCES)})
UNION ALL
SELECT 'loader' AS kind, id, type, url, path, error FROM ({_PARSED.format(inner=_LOADERS)})""",

    "options_map": f"""
SELECT connection_id,
  array_to_string(list_sort(list_concat(
     ['CONNECTION_ID=' || connection_id, 'SOURCE_ID=' || source_id, 'QUEUE_NAME=' || queue],
     CASE WHEN source_type IN ('file_extractor', 'web_scraper')
          THEN ['URL=' || coalesce(source_url, '')] ELSE [] END)), ' ') AS source_env,
  array_to_string(list_sort(list_concat(
     ['CONNECTION_ID=' || connection_id, 'LOADER_ID=' || loader_id, 'QUEUE_NAME=' || queue],
     CASE WHEN loader_type = 'json_loader' AND loader_path IS NOT NULL
          THEN ['PATH=' || loader_path] ELSE [] END)), ' ') AS loader_env,
  CASE WHEN source_type IN ('file_extractor', 'web_scraper') AND coalesce(source_url, '') = ''
         THEN 'URL environment variable not set'
       WHEN source_type NOT IN ('file_extractor', 'web_scraper', 'json_loader')
         THEN 'unknown config type: ' || source_type END AS source_check,
  CASE WHEN loader_type = 'json_loader' AND coalesce(loader_path, '') = ''
         THEN 'PATH environment variable not set' END AS loader_check
FROM ({_RESOLVED})""",

    "connection_resolve": f"""
SELECT connection_id, source_id, loader_id, source_type, loader_type, queue FROM ({_RESOLVED})""",

    "connection_rejects": f"""
SELECT c.id AS connection_id,
       CASE WHEN s.id IS NULL THEN 'Invalid source_id' ELSE 'Invalid loader_id' END AS reason
FROM ({_CONNS}) c
LEFT JOIN (SELECT id FROM ({_PARSED.format(inner=_SOURCES)}) WHERE error IS NULL) s
  ON s.id = c.source_id
LEFT JOIN (SELECT id FROM ({_PARSED.format(inner=_LOADERS)}) WHERE error IS NULL) l
  ON l.id = c.loader_id
WHERE s.id IS NULL OR l.id IS NULL""",

    "connector_lookup": f"""
SELECT kind, id, type,
       CASE type WHEN 'file_extractor' THEN 'file_chunks' WHEN 'web_scraper' THEN 'page_source'
                 WHEN 'json_loader' THEN 'json' END AS connector,
       CASE WHEN type NOT IN ('file_extractor', 'web_scraper', 'json_loader')
            THEN 'unknown type' END AS reason
FROM (SELECT 'source' AS kind, id, type FROM ({_SOURCES})
      UNION ALL SELECT 'loader' AS kind, id, type FROM ({_LOADERS}))""",

    "route_sync_type": f"""
SELECT id AS connection_id, sync_type,
       CASE WHEN sync_type IN ('manual', 'scheduled') THEN sync_type ELSE 'invalid' END AS route
FROM ({_CONNS})""",

    "incremental_append": f"SELECT * FROM events WHERE ts > {BOUNDARY}",

    "dedup_latest": _DEDUP_LATEST,

    "incremental_dedup": _DEDUP_LATEST,

    "dedup_exact": """
SELECT d.* FROM documents d
JOIN (SELECT min(doc_id) AS doc_id FROM documents GROUP BY text) k ON k.doc_id = d.doc_id""",

    "sync_state": """
SELECT event_type, max(ts) AS cursor, CAST(count(*) AS BIGINT) AS rows_read
FROM events GROUP BY event_type""",

    "full_override": f"""
SELECT event_type AS connection_id, event_id, ts, user_id, value, props FROM events
WHERE event_type NOT IN ('click', 'view') OR ts >= {BOUNDARY}""",

    "sync_append_runs": f"""
SELECT event_id, CAST(CASE WHEN ts < {BOUNDARY} THEN 1 ELSE 2 END AS BIGINT) AS run,
       ts, user_id, event_type, value, props
FROM events""",

    "sync_upsert_runs": _DEDUP_LATEST,

    "json_load": f"""
SELECT 'events' AS connection_id, CAST(user_id AS VARCHAR) AS queue, event_id AS seq,
       props AS stringified_data, 'events' AS source, 'json_loader' AS destination,
       ts AS created_at, true AS data_is_null
FROM ({_UNTIL_END})""",

    "queue_text": """
SELECT doc_id, CAST((octet_length(encode(text)) + 1023) // 1024 AS BIGINT) AS n_chunks, text
FROM documents WHERE octet_length(encode(text)) > 0""",

    "run_sync_text": "SELECT doc_id, text FROM documents",

    "run_sync_files": "SELECT CAST(doc_id % 2 + 1 AS BIGINT) AS run, doc_id, text FROM documents",

    "file_lines": "SELECT row_number() OVER (ORDER BY doc_id) - 1 + min(doc_id) OVER () AS line, doc_id, text FROM documents",

    "file_chunks": """
SELECT parse_filename(filename) AS file, CAST(seq AS BIGINT) AS seq,
       CAST(octet_length(chunk) AS BIGINT) AS n_bytes, md5(chunk) AS data_md5
FROM (SELECT filename, seq,
             array_slice(content, seq * 1048576 + 1, (seq + 1) * 1048576) AS chunk
      FROM (SELECT filename, content, unnest(range(0, (size + 1048575) // 1048576)) AS seq
            FROM read_blob('/root/testdata/sf0.01/*.parquet')))""",

    "map_chunks": f"""
SELECT doc_id, CAST(seq AS BIGINT) AS seq, CAST(length(try(decode(chunk))) AS BIGINT) AS n_chars,
       try(decode(chunk)) IS NULL AS quarantined
FROM ({_DOC_CHUNKS})""",

    "queue_consume": """
SELECT 'events' AS connection_id, event_type AS queue, event_id AS seq,
       props AS stringified_data, ts AS created_at
FROM events""",

    "queue_consume_one": """
SELECT 'events' AS connection_id, event_type AS queue, event_id AS seq, props AS stringified_data
FROM events WHERE event_type = 'click'""",

    "stream_sync": """
SELECT 'events' AS connection_id, event_type AS queue, event_id AS seq,
       props AS stringified_data
FROM events""",

    "stream_dedup": """
SELECT 'events' AS connection_id, event_type AS queue, event_id AS seq,
       props AS stringified_data
FROM events""",

    "stream_until_end": f"""
SELECT 'events' AS connection_id, CAST(user_id AS VARCHAR) AS queue, event_id AS seq,
       props AS stringified_data
FROM ({_UNTIL_END})""",

    "stream_reorder": """
SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(text, '') AS text FROM (
  SELECT *, sum(CASE WHEN octet_length(encode(coalesce(text, ''))) % 4 = 0 THEN 1 ELSE 0 END)
              OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS m
  FROM conversations) WHERE m = 0""",

    "stream_state": """
SELECT event_type AS connection_id, max(ts) AS cursor, CAST(count(*) AS BIGINT) AS rows_read
FROM events GROUP BY event_type""",

    "run_scheduled": """
SELECT 'copy-' || replace(parse_filename(filename), '.parquet', '') AS connection_id,
       CAST((size + 1048575) // 1048576 AS BIGINT) AS loaded, CAST(NULL AS VARCHAR) AS reason
FROM read_blob('/root/testdata/sf0.01/*.parquet')
UNION ALL
SELECT 'copy-documents-2' AS connection_id, CAST((size + 1048575) // 1048576 AS BIGINT) AS loaded,
       CAST(NULL AS VARCHAR) AS reason
FROM read_blob('/root/testdata/sf0.01/documents.parquet')""",

    "run_scheduled_tables": f"""
SELECT 'log' AS connection_id, CAST(CASE WHEN ts < {BOUNDARY} THEN 1 ELSE 2 END AS BIGINT) AS run, * FROM events
UNION ALL
SELECT 'all' AS connection_id, CAST(NULL AS BIGINT) AS run, * FROM events
UNION ALL
SELECT 'by-user' AS connection_id, CAST(NULL AS BIGINT) AS run, * FROM ({_DEDUP_LATEST})""",

    "run_scheduled_pages": """
SELECT connection_id, page_id, CAST(octet_length(encode(html)) AS BIGINT) AS n_bytes,
       CAST((octet_length(encode(html)) + 1023) // 1024 AS BIGINT) AS n_chunks
FROM pages JOIN (VALUES ('secure', 'https://'), ('plain', 'http://'), ('any', 'http')) r(connection_id, prefix)
  ON starts_with(url, prefix)
WHERE octet_length(encode(html)) > 0""",

    "run_sync": """
SELECT 'c1' AS connection_id, CAST((size + 1048575) // 1048576 AS BIGINT) AS read,
       CAST((size + 1048575) // 1048576 AS BIGINT) AS loaded, CAST(0 AS BIGINT) AS rejected
FROM read_blob('/root/testdata/sf0.01/documents.parquet')""",
}

ORACLE["stream_upsert"] = _DEDUP_LATEST
ORACLE["stream_dedup_all"] = ORACLE["stream_dedup"]
# A connection's config gives the same rows as the sync called by hand.
ORACLE["run_sync_append"] = ORACLE["sync_append_runs"]
ORACLE["run_sync_upsert"] = ORACLE["sync_upsert_runs"]
