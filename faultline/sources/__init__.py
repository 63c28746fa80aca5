"""Sources and sinks: Parquet tables, derived fixtures, keyed topics."""
