"""Sinks: partitioned files with dynamic overwrite, flat exports, warehouse tables."""
