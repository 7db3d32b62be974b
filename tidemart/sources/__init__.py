"""Sources and sinks: test-table adapters, JDBC, raw/bronze files, snapshots."""
