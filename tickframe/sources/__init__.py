"""Fixture mapping, ingest and sinks."""
