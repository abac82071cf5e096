"""tidewater: a Spark-native file ingestion and feature engine.

Files landing under ``source=<s>/date=<d>/`` are identified by content hash and
magic bytes, validated, de-duplicated against an append-only manifest, parsed
with fail-the-whole-file semantics and written as all-string Parquet; feature,
CDC, table-layout, serving and monitoring operators sit on top as plain
DataFrame transforms.
"""

__version__ = "0.1.0"
