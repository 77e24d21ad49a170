"""Joins of invoice lines with the supplier bridge and the country mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import normalize_headers

def normalize_mapping(mapping: DataFrame) -> DataFrame:
    """Country/Continent columns whatever the header case and padding."""
    return normalize_headers(mapping, ("Country", "Continent")).select("Country", "Continent")


def normalize_supplier(supplier: DataFrame) -> DataFrame:
    """Bridge as (InvoiceNo text, SupplierID)."""
    bridge = normalize_headers(supplier, ("InvoiceNo", "Fournisseur", "SupplierID"))
    if "SupplierID" not in bridge.columns:
        bridge = bridge.withColumnRenamed("Fournisseur", "SupplierID")
    return bridge.select(F.col("InvoiceNo").cast("string").alias("InvoiceNo"), "SupplierID")


def with_continent(lines: DataFrame, mapping: DataFrame) -> DataFrame:
    """Left join lines with the mapping on Country (unmatched -> null Continent).

    This is the row-level joined table. No hint is given: the planner
    broadcasts the mapping when its size in bytes is under the session's
    threshold, and adaptive execution decides again on the measured size."""
    return lines.join(normalize_mapping(mapping), on="Country", how="left")


def with_supplier(lines: DataFrame, supplier: DataFrame) -> DataFrame:
    """Row-level left join of lines with the bridge on text InvoiceNo. A
    bridge row repeated for an invoice repeats the line (fan-out).

    Written as an inner join and an anti join: adaptive execution may then
    split a hot invoice on either side, which a left join does not allow for
    its right side. The join key is a struct, never null itself, so that both
    branches share one shuffle of the lines.
    """
    key = F.struct(F.col("InvoiceNo").cast("string").alias("InvoiceNo")).alias("_invoice")
    lines = lines.withColumn("InvoiceNo", F.col("InvoiceNo").cast("string"))
    names = [c for c in lines.columns if c != "InvoiceNo"]
    keyed = lines.select(key, *names)
    bridge = normalize_supplier(supplier).filter(F.col("InvoiceNo").isNotNull()).select(key, "SupplierID")
    matched = keyed.join(bridge, "_invoice")
    alone = keyed.join(bridge.select("_invoice").distinct(), "_invoice", "left_anti").withColumn(
        "SupplierID", F.lit(None).cast(dict(bridge.dtypes)["SupplierID"])
    )
    return matched.unionByName(alone).select(F.col("_invoice.InvoiceNo").alias("InvoiceNo"), *names, "SupplierID")
