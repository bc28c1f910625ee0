"""Sinks: the partitioned forecast lake, single-file writes and run reports."""
