"""Sources and sinks: driver-table fixture, CSV ingest, album JSON, table I/O,
JDBC export, SQL catalog registration."""
