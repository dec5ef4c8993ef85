"""Sources and sinks: table snapshots, packet files/streams, change capture."""
