"""Scans, sources and sinks."""
