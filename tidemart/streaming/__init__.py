"""Structured Streaming forms of the ingest and SCD layers."""
