"""Sources and sinks: raw files, layer tables, test-data fixtures."""
