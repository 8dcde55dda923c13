"""Sources: declared-schema file scans, raw-file resolution, table adapters."""
