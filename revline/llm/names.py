"""Helper column names that cannot clash with a caller's."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
