"""Sources and sinks: parquet tables, CSV edges, fixture views."""
