"""Incremental month-by-month build driven by Structured Streaming."""
