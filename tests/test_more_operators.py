"""Row-level joins, the world bundle, chart and ranking helpers."""

import datetime as dt

import pytest

from tillroll.functions.columns import nice_number
from tillroll.operators import cleaning, quality
from tillroll.operators.aggregates import best_product_in_country, build_cancellations_by_continent
from tillroll.operators.joins import with_continent, with_supplier
from tillroll.operators.ranking import preview, top_n
from tillroll.plans.jobs import world_analysis


def _lines(spark):
    return spark.createDataFrame(
        [("1", "FR", 10.0), ("1", "FR", 5.0), ("2", "DE", 7.0), ("3", "XX", 1.0)],
        "InvoiceNo string, Country string, TotalAmount double",
    )


def test_with_supplier_fans_out_rows(spark):
    bridge = spark.createDataFrame([("1", "S1"), ("1", "S2"), ("2", "S1")], "InvoiceNo string, Fournisseur string")
    out = with_supplier(_lines(spark), bridge)
    assert out.count() == 2 * 2 + 1 + 1  # invoice 1 lines x 2 suppliers, 2 once, 3 unmatched
    assert out.filter("SupplierID IS NULL").count() == 1


def test_world_bundle(spark):
    mapping = spark.createDataFrame([("FR", "Europe"), ("DE", "Europe")], "Country string, Continent string")
    raw = spark.createDataFrame([("C9", "FR"), ("5", "DE")], "InvoiceNo string, Country string")
    res = world_analysis(_lines(spark), mapping, raw)
    assert {r.Continent: r.TotalAmount for r in res["continent_sales"].collect()} == {"Europe": 22.0, None: 1.0}
    assert res["top_cancelled_continent"].first()[0] == "Europe"
    assert res["world_df"].count() == 4
    assert with_continent(_lines(spark), mapping).columns == ["Country", "InvoiceNo", "TotalAmount", "Continent"]


def test_line_chart_and_missing_counts(spark):
    monthly = spark.createDataFrame(
        [("2011-02", 50.0), ("2011-01", 100.0), (None, 3.0)], "InvoiceMonth string, TotalSales double"
    )
    rows = quality.line_chart_dataset(monthly, "InvoiceMonth", "TotalSales").collect()
    assert [(r.InvoiceMonth, r.share) for r in rows] == [("2011-01", 1.0), ("2011-02", 0.5)]
    df = spark.createDataFrame([(None, 1), ("a", None), (None, None)], "Description string, Quantity int")
    got = {r.step: r.row_count for r in quality.missing_counts(df, ["Description", "Quantity"]).collect()}
    assert got == {"missing_Description": 2, "missing_Quantity": 2}


def test_top_n_preview_and_cancelled_only(spark):
    df = spark.createDataFrame([(i, float(i % 7)) for i in range(50)], "k int, v double")
    assert [r.k for r in top_n(df, 3, "v", "k").collect()] == [0, 7, 14]
    assert preview(df, 5).count() == 5
    inv = spark.createDataFrame([("C1",), ("c2",), ("3",)], "InvoiceNo string")
    assert sorted(r.InvoiceNo for r in cleaning.cancelled_only(inv).collect()) == ["C1", "c2"]
    assert [r.InvoiceNo for r in cleaning.cancelled_only(inv, case_sensitive=True).collect()] == ["C1"]


def test_chart_dataset_positions(spark):
    cs = spark.createDataFrame([("FR", 2_500_000.0), ("DE", 2_500_000.0), ("ES", 1200.0)], "Country string, TotalAmount double")
    rows = quality.chart_dataset(cs, "Country", "TotalAmount", top_n=2).collect()
    assert [(r.position, r.Country, r.value_label, r.share) for r in rows] == [(1, "DE", "2.5M", 1.0), (2, "FR", "2.5M", 1.0)]


def test_dataset_profile(spark):
    df = spark.createDataFrame([(1, "a", dt.datetime(2011, 1, 1))], "a int, b string, c timestamp_ntz")
    rows = sorted(map(tuple, quality.dataset_profile(df).collect()), key=lambda r: r[2])
    assert rows == [("a", "int", 1, 1, 3), ("b", "string", 2, 1, 3), ("c", "timestamp_ntz", 3, 1, 3)]


def test_labels_round_half_way_to_even(spark):
    values = [1250.0, 1450.0, 0.125, 2_500_000.0, 42.0, -1250.0, 999.5, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(nice_number("v").alias("l")).collect()
    assert [r.l for r in rows] == ["1.2K", "1.4K", "0.12", "2.5M", "42", "-1.2K", "999.50", None]


def test_best_product_ignores_nulls_and_compares_raw_sums(spark):
    rows = [("FR", None, 9.0), ("FR", "nothing", None), ("FR", "a", 5.001), ("FR", "b", 5.004)]
    df = spark.createDataFrame(rows, "Country string, Description string, TotalAmount double")
    assert best_product_in_country(df, "fr").first()[0] == "b"
    assert best_product_in_country(df.limit(0), "fr").first()[0] is None


def test_single_machine_cancellations_strip_tabs(spark):
    raw = spark.createDataFrame([("C1", "FR"), ("C2", "\tFR "), ("c3", "FR")], "InvoiceNo string, Country string")
    mapping = spark.createDataFrame([("FR", "Europe")], "Country string, Continent string")
    exact = build_cancellations_by_continent(raw, mapping, case_sensitive=True, keep_unmapped=False)
    assert exact.collect() == [("Europe", 2)]
    loose = {r.Continent: r.CancelledOperations for r in build_cancellations_by_continent(raw, mapping).collect()}
    assert loose == {"Europe": 2, None: 1}


def test_mixed_schema_error_counts_all_runs(spark):
    manifest = spark.range(30).selectExpr("cast(id as string) as run_id", "2L as schema_variants")
    with pytest.raises(ValueError, match="30 runs"):
        quality.check_consistent_schemas(manifest)
