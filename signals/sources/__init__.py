"""Sources and sinks: log files, datagrams, tail data source, JDBC, tenant zones, artifacts, metrics, ledger."""
