"""Readers: the driver's parquet tables, delimited text and CSV, streams."""
