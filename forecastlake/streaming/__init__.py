"""Structured Streaming: incremental ingestion of newly landed responses."""
