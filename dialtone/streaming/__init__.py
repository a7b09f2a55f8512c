"""Structured Streaming forms of the live dashboard counters."""
