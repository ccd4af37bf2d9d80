"""Sizes of hash parts."""

from __future__ import annotations

from pyspark.sql import DataFrame


def n_parts(df: DataFrame, size: int) -> int:
    """How many parts of about ``size`` rows a table makes (one at least)."""
    return max(1, -(-df.count() // size))
