"""Scans, sinks and landing-zone bookkeeping."""
