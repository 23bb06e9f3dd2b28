"""Scans, sinks and fixed schemas."""
