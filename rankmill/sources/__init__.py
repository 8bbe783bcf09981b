"""Readers and writers: CSV impression logs, parquet tables, run logs."""
