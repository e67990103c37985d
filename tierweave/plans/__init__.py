"""Whole runs: ingest and enrichment, as chains of operators."""
