"""File-arrival ingest with Structured Streaming."""
