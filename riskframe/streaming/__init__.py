"""Structured Streaming forms of monitoring (K9), scoring (K10) and run logs."""
