"""Structured Streaming drivers: landing ingest, processed-event topic, metrics."""
