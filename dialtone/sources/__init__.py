"""Table sources: parquet readers, derived test fixtures, dimensions, sinks."""
