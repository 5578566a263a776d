"""Joins against a side with unique keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_seen(frame: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key: the one with the smallest order value. Rows are reduced before the shuffle."""
    values = [c for c in frame.columns if c not in keys and c != order]
    picked = F.min_by(F.struct(*values), F.col(order)).alias("picked")
    return frame.groupBy(*keys).agg(picked).select(*keys, "picked.*")
