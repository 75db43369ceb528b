"""Sources and sinks: CSV files, weather payloads, Parquet tables, fixture."""
