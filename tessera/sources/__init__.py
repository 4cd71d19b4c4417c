"""Scans, sinks and materialisation."""
