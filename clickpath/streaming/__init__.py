"""Structured Streaming: event intake, Parquet archive, session scoring."""
