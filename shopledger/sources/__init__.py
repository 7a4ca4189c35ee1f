"""Table schemas, readers and the parquet layout the reports like best."""
