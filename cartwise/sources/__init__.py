"""Scans (driver tables, derived inputs, fixed lookup values) and sinks."""
