"""Sources and sinks: the test-table role mapping, CSV/Parquet ingest and export, dimension patches."""
