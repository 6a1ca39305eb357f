"""Incremental ingestion and scoring with Structured Streaming."""
