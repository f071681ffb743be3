"""Incremental ingest of document batches."""
