"""Scalar and array-valued Column functions (no Python per row)."""
