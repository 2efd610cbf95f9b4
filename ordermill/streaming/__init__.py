"""Load-once ingestion with Structured Streaming."""
