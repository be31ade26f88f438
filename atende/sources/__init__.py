"""Sources and sinks: raw scans, table bindings, landing, stored tables."""
