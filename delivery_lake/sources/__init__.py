"""Sources and sinks: test-data derivation, file layers (CSV / parquet snapshots), JDBC."""
