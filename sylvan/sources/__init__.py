"""Sources and sinks: text export scan, catalog, snapshots, trait records, chunks."""
