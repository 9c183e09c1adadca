"""Operators: cleaning, staging, lookup and interval joins, enrichment, data quality."""
