"""DataFrame operators (ingest bookkeeping, features, CDC, layout, serving, monitoring)."""
