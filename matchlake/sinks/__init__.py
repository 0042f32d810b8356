"""Writers: delimited text, indexed text, Parquet (plain, partitioned, refreshed)."""
