"""Structured Streaming forms of ingest and ledger rollups."""
