"""Sorts, top-N and previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows in ``order``. Planned as TakeOrderedAndProject: each
    task keeps its own best ``n`` and only those reach the final merge, so
    the cost is bounded by ``n`` per task, not by the input."""
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows, no sort (a head preview)."""
    return df.limit(n)
