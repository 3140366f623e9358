"""Sources and sinks: contracted CSV scans, driver tables, parquet sinks."""
