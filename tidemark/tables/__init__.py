"""The keyed table: versioned parquet, commits, maintenance and catalog entries."""
