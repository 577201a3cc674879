"""Sources and sinks: Parquet tables as views, catalogs of their columns, JSON output."""
