"""Sinks: idempotent partitioned table writes."""
