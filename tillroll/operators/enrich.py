"""Line amount (the only enrichment step)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillroll.functions.columns import line_amount


def total_amount(df: DataFrame) -> DataFrame:
    """``TotalAmount = round(Quantity * UnitPrice, 2)`` (cluster rule)."""
    return df.withColumn("TotalAmount", line_amount("Quantity", "UnitPrice", rounded=True))


def total_amount_unrounded(df: DataFrame) -> DataFrame:
    """``TotalAmount = Quantity * UnitPrice`` without rounding (single-machine rule)."""
    return df.withColumn("TotalAmount", line_amount("Quantity", "UnitPrice", rounded=False))
