"""Readers: delimited text, Parquet, pandas frames, SQLite files, paths."""
