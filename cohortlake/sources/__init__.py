"""Readers and writers: delimited text, messages, Parquet batches, reports, results."""
