"""Readers and writers: typed CSV scans, table sinks, test-table adapters."""
