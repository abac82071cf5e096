"""Reusable SQL fragments for the DuckDB oracles (independent of Spark code)."""

# The virtual-file scheme of tidewater.sources.virtual, in plain SQL.
VFILES = r"""
vf0 AS (
  SELECT doc_id, source, lang, n_chars, text,
         ['csv','json','ndjson','jsonl','parquet','txt','CSV'][(doc_id % 7) + 1] AS ext,
         CASE WHEN doc_id % 11 = 0 THEN from_hex('50415231') || encode(text)
              WHEN doc_id % 13 = 0 THEN from_hex('1f8b') || encode(text)
              ELSE encode(text) END AS content
  FROM documents
),
vf AS (
  SELECT doc_id, source, lang, n_chars,
         'source=' || source || '/date=2026-05-17/doc_' || doc_id || '.' || ext AS key,
         's3://landing/source=' || source || '/date=2026-05-17/doc_' || doc_id || '.' || ext AS path,
         sha256(content) AS content_hash,
         CAST(octet_length(content) AS BIGINT) AS length,
         CASE WHEN doc_id % 11 = 0 THEN 'parquet'
              WHEN doc_id % 13 = 0 THEN 'gzip'
              WHEN ext = 'csv' THEN 'csv'
              WHEN ext IN ('json','ndjson','jsonl') THEN 'ndjson'
              WHEN ext = 'parquet' THEN 'parquet'
              ELSE 'unknown' END AS format,
         TIMESTAMP '2026-05-17 00:00:00' + to_seconds(doc_id) AS received_at,
         'source=' || source || '/date=2026-05-17/doc_' || doc_id || '.' || ext AS mkey
  FROM vf0
),
vfc AS (
  SELECT *,
         CASE WHEN format = 'unknown' THEN 'unsupported file format'
              WHEN length = 0 THEN 'file is empty'
              WHEN length > 524288000 THEN 'file size exceeds maximum limit of 524288000 bytes'
              ELSE NULL END AS reason
  FROM vf
)"""

# First file per hash by (received_at, path), with the scenario outcome.
FIRST = r"""
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY content_hash ORDER BY received_at, path) AS rn
    FROM vfc) WHERE rn = 1
),
outc AS (
  SELECT *,
    CASE WHEN reason IS NOT NULL THEN 'quarantined'
         WHEN format NOT IN ('csv','ndjson','parquet') THEN 'failed'
         ELSE ['done','failed','processing','pending'][(doc_id % 4) + 1] END AS outcome,
    CASE WHEN reason IS NOT NULL THEN reason
         WHEN format NOT IN ('csv','ndjson','parquet') THEN 'unsupported format: ' || format
         WHEN doc_id % 4 = 1 THEN 'failed to parse file: malformed CSV'
         ELSE NULL END AS outcome_reason,
    received_at + to_seconds(((doc_id % 4) + 1) * 60) AS outcome_at
  FROM firsts
),
mcur AS (
  SELECT path, content_hash, source, outcome AS status, received_at AS created_at,
         CASE WHEN outcome IN ('done','failed','quarantined') THEN outcome_at END AS processed_at,
         outcome_reason AS reason, doc_id, format, length, received_at, key
  FROM outc
)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip().rstrip(",") for p in parts) + "\n"
