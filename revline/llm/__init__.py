"""Operators for large training-data pipelines (optional subpackage)."""
