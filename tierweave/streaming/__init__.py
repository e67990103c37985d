"""Incremental forms of ingest and quota."""
