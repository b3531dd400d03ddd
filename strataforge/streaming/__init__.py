"""Structured Streaming: event windows and incremental ingestion."""
