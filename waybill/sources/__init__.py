"""Readers for record topics, event JSON, log files and the test tables."""
