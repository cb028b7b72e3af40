"""Composed models: staging -> intermediate -> marts; ingest; scoring; the daily run."""
