"""Fixed values that must equal the reference's for identical results.

Fixed values (reference behaviour, kept verbatim):
- manifest statuses: pending, processing, done, failed, quarantined
- terminal statuses (set processed_at): done, failed, quarantined
- skip statuses for idempotency: done, processing, failed, quarantined
- maximum file size: 500 * 1024 * 1024 = 524288000 bytes, rejected when strictly larger
- Parquet magic: the 4 ASCII bytes "PAR1"; gzip magic: bytes 0x1f 0x8b
- extension map (case-sensitive, last "." of the key): csv -> csv;
  json, ndjson, jsonl -> ndjson; parquet -> parquet; anything else -> unknown
- validation messages, first failure wins, in this order:
  "unsupported file format", "file is empty",
  "file size exceeds maximum limit of 524288000 bytes",
  "content hash mismatch: expected <expected>, got <actual>"
- parse messages: "unsupported format: <format>", "no records found in file"
- processed part sizes: 128 MiB minimum, 256 MiB maximum, target their mean (192 MiB)
- part key suffix ".part-%05d.parquet" from 1; parts manifest suffix ".manifest.json"
- stuck threshold: 31 minutes, by created_at, status processing
- default processed topic: files.processed
- topics (partitions, retention ms): files.raw (6, 604800000),
  files.processed (6, 2592000000), cdc.events (3, 604800000),
  dead-letter (1, 2592000000)
"""

PENDING = "pending"
PROCESSING = "processing"
DONE = "done"
FAILED = "failed"
QUARANTINED = "quarantined"
STATUSES = (PENDING, PROCESSING, DONE, FAILED, QUARANTINED)
TERMINAL = (DONE, FAILED, QUARANTINED)
SKIP_STATUSES = (DONE, PROCESSING, FAILED, QUARANTINED)

MAX_FILE_SIZE = 500 * 1024 * 1024

PARQUET_MAGIC_HEX = "50415231"  # "PAR1"
GZIP_MAGIC_HEX = "1F8B"

EXTENSION_FORMATS = {
    "csv": "csv",
    "json": "ndjson",
    "ndjson": "ndjson",
    "jsonl": "ndjson",
    "parquet": "parquet",
}
PARSEABLE_FORMATS = ("csv", "ndjson", "parquet")

MSG_UNSUPPORTED = "unsupported file format"
MSG_EMPTY = "file is empty"
MSG_TOO_BIG = f"file size exceeds maximum limit of {MAX_FILE_SIZE} bytes"
MSG_HASH_MISMATCH = "content hash mismatch: expected {expected}, got {actual}"
MSG_NO_PARSER = "unsupported format: {format}"
MSG_NO_RECORDS = "no records found in file"

PART_MIN_BYTES = 128 * 1024 * 1024
PART_MAX_BYTES = 256 * 1024 * 1024
PART_TARGET_BYTES = (PART_MIN_BYTES + PART_MAX_BYTES) // 2

STUCK_AFTER_SECONDS = 31 * 60

PROCESSED_TOPIC = "files.processed"
TOPICS = {
    "files.raw": (6, 604_800_000),
    "files.processed": (6, 2_592_000_000),
    "cdc.events": (3, 604_800_000),
    "dead-letter": (1, 2_592_000_000),
}

# Our own choices (not from the reference).
MSG_HIDDEN = "hidden name"
MSG_UNREADABLE = "payload not found"
MSG_PARSE_CSV = "failed to parse file: malformed CSV"
MSG_PARSE_JSON = "failed to parse file: invalid JSON value sequence"
MSG_PARSE_PARQUET = "failed to parse file: unreadable parquet"
INGRESS = "s3"
