"""Sources and sinks: table loading, fixture views, CSV ingest, writers."""
