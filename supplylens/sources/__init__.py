"""Source tables: schemas, CSV ingest, parquet and test-data readers, publishing."""
