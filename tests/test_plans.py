"""Physical-plan properties: no job before the result is asked for, no hints or
repartitioning by size, no Python workers, pushdown to the scan, aggregation
before the supplier join, one scan of the lines."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from tillroll.operators import aggregates as agg
from tillroll.plans import catalog
from tillroll.sources import driver_views as views

from conftest import SMOKE_DIR

#: Queries that write before they read back, or infer a file's schema; all others are lazy.
WRITING = {
    "parquet_roundtrip", "csv_header_roundtrip", "json_counts_roundtrip", "run_manifest_classified", "csv_reordered_header",
    "result_dir_scan", "csv_preview_roundtrip", "single_machine_save", "cleaning_job_audit", "enrich_job",
    "aggregation_job_audit", "all_in_one_answers", "optional_sources", "csv_quoted_roundtrip", "csv_accepted_rows",
    "csv_rejected_records", "published_results", "catalog_table_scan",
    "supplier_sales_by_month_layout", "sales_of_listed_months", "clustered_market_lines", "supplier_sales_colocated",
    "stored_invoice_counts", "incremental_distinct_lines",
}


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan_text(df).split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - WRITING))
def test_building_runs_no_job_and_plan_is_plain(spark, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"build-{name}", name)
    try:
        df = catalog.queries()[name](spark, SMOKE_DIR)
        text = plan_text(df)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert not sc.statusTracker().getJobIdsForGroup(f"build-{name}")
    assert "REPARTITION_BY_NUM" not in text
    for marker in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "InPandas", "InArrow", "MapInPandas", "MapInArrow", "CartesianProduct"):
        assert marker not in text, marker


def test_the_manifest_reads_footers_in_tasks(spark):
    """The one plan with a Python node: it sits on the file listing."""
    df = catalog.queries()["run_manifest_classified"](spark, SMOKE_DIR)
    text = plan_text(df).split("== Initial Plan ==")[0]
    assert "Python" not in text and "InPandas" not in text
    assert text.count("InArrow") == text.count("binaryFile") >= 1


@pytest.mark.parametrize("name", ["csv_quoted_roundtrip", "csv_accepted_rows", "csv_rejected_records", "published_results", "catalog_table_scan"])
def test_written_queries_use_no_python_worker(spark, name):
    text = plan_text(catalog.queries()[name](spark, SMOKE_DIR))
    assert "Python" not in text and "InPandas" not in text and "InArrow" not in text


def scans(plan: str, column: str) -> int:
    return len([x for x in re.findall(r"Scan parquet .*", plan) if column in x])


def test_supplier_sales_scans_lines_and_bridge_once(spark):
    # on the driver's tables the bridge itself comes from lineitem: two scans in all
    assert scans(final_plan(catalog.queries()["supplier_sales"](spark, SMOKE_DIR)), "l_orderkey") == 2


def test_supplier_sales_on_files_scans_once(spark, scratch):
    lines, bridge = os.path.join(scratch, "lines"), os.path.join(scratch, "bridge")
    catalog.enriched(spark, SMOKE_DIR).write.parquet(lines)
    views.bridge(spark, SMOKE_DIR).write.parquet(bridge)
    plan = final_plan(agg.aggregate_supplier_data(spark.read.parquet(lines), spark.read.parquet(bridge)))
    assert scans(plan, "TotalAmount") == 1 and scans(plan, "Fournisseur") == 1


def test_result_volumes_scan_lines_three_times(spark):
    assert scans(final_plan(catalog.queries()["result_volumes"](spark, SMOKE_DIR)), "l_orderkey") <= 3


def test_hot_order_key_on_files_is_split(spark, scratch):
    """Lines of one order make up a third of five files: the join is split."""
    folder = os.path.join(scratch, "tables")
    for name in views.DRIVER_SCHEMAS:
        spark.read.parquet(f"{SMOKE_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    li = spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet")
    hot = li.withColumn("l_orderkey", F.when(F.xxhash64("l_orderkey", "l_linenumber") % 3 == 0, F.lit(1).cast("long")).otherwise(F.col("l_orderkey")))
    hot.repartition(5).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        assert "skew=true" in final_plan(views.retail(spark, folder))
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_year_filter_reaches_the_scan(spark, scratch):
    path = os.path.join(scratch, "enriched")
    spark.createDataFrame(
        [("1", "UK", dt.datetime(2011, 5, 1), 1.0)],
        "InvoiceNo string, Country string, InvoiceDate timestamp_ntz, TotalAmount double",
    ).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        df = agg.filter_country_year(spark.read.parquet(path), "UK", 2011)
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(InvoiceDate" in text and "LessThan(InvoiceDate" in text
    assert "EqualTo(Country,UK)" in text


def test_supplier_lines_summed_before_join(spark):
    df = catalog.queries()["supplier_sales"](spark, SMOKE_DIR)
    text = plan_text(df)
    assert text.count("sum(TotalAmount") >= 1
    logical = df._jdf.queryExecution().optimizedPlan().toString()
    join_at = logical.find("Join Inner")
    assert join_at > 0 and "sum(TotalAmount" in logical[join_at:]


def test_top_n_is_take_ordered(spark):
    df = catalog.queries()["chart_top_countries"](spark, SMOKE_DIR)
    assert "TakeOrderedAndProject" in plan_text(df)


def test_waterfall_is_one_aggregate_pass(spark):
    df = catalog.queries()["cleaning_waterfall"](spark, SMOKE_DIR)
    # one keyed shuffle for the distinct rows (plus the single-partition merge of the global total)
    lines = [l for l in plan_text(df).split("\n") if "Exchange hashpartitioning" in l and "Quantity" in l]
    assert len(lines) == 1
