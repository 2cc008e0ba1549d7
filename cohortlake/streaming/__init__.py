"""Structured Streaming ingest of encoded records into Parquet."""
