"""Scans, landing, sinks and the catalog."""
