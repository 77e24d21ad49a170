"""A hot invoice holding a third of the lines and of the bridge rows."""

from pyspark.sql import functions as F

from tillroll.operators import aggregates as agg
from tillroll.operators import cleaning, quality

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _with_conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


import pytest


@pytest.mark.parametrize("suppliers_of_hot", [500, None])
def test_hot_invoice_supplier_sales(spark, suppliers_of_hot):
    """500 suppliers: summing first already collapses the hot invoice. All
    distinct: the hot invoice still holds a third of the bridge after summing,
    and adaptive execution splits it."""
    n = 30_000
    hot = F.col("id") % 3 == 0
    lines = spark.range(n).select(
        F.when(hot, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("InvoiceNo"),
        F.lit(1.25).alias("TotalAmount"),
    )
    supplier = F.col("id") if suppliers_of_hot is None else F.col("id") % suppliers_of_hot
    bridge = spark.range(n).select(
        F.when(hot, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("InvoiceNo"),
        supplier.cast("string").alias("Fournisseur"),
    ).filter(F.col("id") % 7 != 1)  # some invoices without a supplier
    old = _with_conf(spark, SKEW_CONF)
    try:
        got = agg.aggregate_supplier_data(lines, bridge)
        rows = {r.SupplierID: r.TotalAmount for r in got.collect()}
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)

    naive = (
        lines.join(bridge.withColumnRenamed("Fournisseur", "SupplierID"), "InvoiceNo", "left")
        .groupBy("SupplierID")
        .agg(F.round(F.sum("TotalAmount"), 2).alias("TotalAmount"))
    )
    expected = {r.SupplierID: r.TotalAmount for r in naive.collect()}
    assert rows == expected
    if suppliers_of_hot is None:
        assert "skew=true" in plan


def test_hot_copy_group_dedup_and_waterfall(spark):
    # one row repeated 20k times next to 10k distinct rows
    copies = spark.range(20_000).select(F.lit("1").alias("InvoiceNo"))
    distinct = spark.range(10_000).select((F.col("id") + 2).cast("string").alias("InvoiceNo"))
    raw = copies.unionByName(distinct).select(
        "InvoiceNo",
        F.lit("A").alias("StockCode"),
        F.lit("Lamp").alias("Description"),
        F.lit("1").alias("Quantity"),
        F.lit("1/10/2011 8:00").alias("InvoiceDate"),
        F.lit("2.5").alias("UnitPrice"),
        F.lit("7").alias("CustomerID"),
        F.lit("FR").alias("Country"),
    )
    assert cleaning.remove_duplicates(raw).count() == 10_001
    got = {r.step: r.row_count for r in quality.cleaning_waterfall(raw).collect()}
    assert got["raw_retail"] == 30_000 and got["after remove_duplicates"] == 10_001
