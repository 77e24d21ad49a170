"""The reference's ten unit tests, re-stated on Spark frames."""

import datetime as dt
import os

import pytest

from tillroll.operators import aggregates as agg
from tillroll.operators import cleaning, enrich
from tillroll.schemas import MAPPING, RETAIL, SUPPLIER
from tillroll.sources.readers import load_csv, load_source
from tillroll.sources.writers import save_parquet_guarded


def ts(s):
    return dt.datetime.strptime(s, "%Y-%m-%d %H:%M")


def test_monthly_sales(spark):
    df = spark.createDataFrame(
        [
            (ts("2011-01-10 08:00"), "1001", 10.0),
            (ts("2011-01-10 08:05"), "1001", 5.0),
            (ts("2011-02-03 09:30"), "1002", 20.0),
            (ts("2011-02-20 16:10"), "1003", 15.0),
        ],
        "InvoiceDate timestamp_ntz, InvoiceNo string, TotalAmount double",
    )
    rows = [tuple(r) for r in agg.aggregate_monthly_data(df).collect()]
    assert rows == [("2011-01", 15.0, 1), ("2011-02", 35.0, 2)]


def test_supplier_sales_country_year(spark):
    lines = spark.createDataFrame(
        [
            ("1001", "United Kingdom", ts("2011-01-10 00:00"), 100.0),
            ("1002", "France", ts("2011-01-10 00:00"), 200.0),
            ("1003", "United Kingdom", ts("2010-12-20 00:00"), 300.0),
            ("1004", "United Kingdom", ts("2011-06-01 00:00"), 50.0),
        ],
        "InvoiceNo string, Country string, InvoiceDate timestamp_ntz, TotalAmount double",
    )
    supplier = spark.createDataFrame(
        [("1001", "F100"), ("1002", "F200"), ("1003", "F300"), ("1004", "F100")], SUPPLIER
    )
    rows = [tuple(r) for r in agg.aggregate_supplier_market(lines, supplier, "United Kingdom", 2011).collect()]
    assert rows == [("F100", 150.0)]


def test_total_amount(spark):
    df = spark.createDataFrame([(2, 10.0), (3, 4.5), (1, 7.25)], "Quantity int, UnitPrice double")
    assert [r.TotalAmount for r in enrich.total_amount(df).collect()] == [20.0, 13.5, 7.25]


def _text_lines(spark, rows):
    return spark.createDataFrame(
        rows,
        "InvoiceNo string, StockCode string, Description string, Quantity int, "
        "InvoiceDate string, UnitPrice double, Country string",
    )


def test_filter_outliers(spark):
    df = _text_lines(
        spark,
        [
            ("1001", "A", "Lamp", 1, "2011-01-10 08:00", 10.0, "France"),
            ("1002", "B", "Mug", 0, "2011-01-10 08:00", 5.0, "France"),
            ("1003", "C", "Cup", -3, "2011-01-10 08:00", 7.0, "France"),
            ("1004", "D", "Bowl", 20000, "2011-01-10 08:00", 12.0, "France"),
        ],
    )
    assert [r.InvoiceNo for r in cleaning.filter_outliers(df).collect()] == ["1001"]


def test_filter_valid_transactions(spark):
    df = _text_lines(
        spark,
        [
            (inv, "A", "Lamp", 1, "2011-01-10 08:00", 10.0, "France")
            for inv in ["1001", "C1002", "c1003", "1004"]
        ],
    )
    assert sorted(r.InvoiceNo for r in cleaning.filter_valid_transactions(df).collect()) == ["1001", "1004"]


def test_group_by_country(spark):
    df = spark.createDataFrame(
        [("France", 10.0), ("Germany", 15.0), ("France", 20.0), ("Germany", 5.0), ("Spain", 8.0)],
        "Country string, TotalAmount double",
    )
    rows = [tuple(r) for r in agg.group_by_country_sum_only(df).collect()]
    assert rows == [("France", 30.0), ("Germany", 20.0), ("Spain", 8.0)]


def test_group_by_country_with_invoice_count(spark):
    df = spark.createDataFrame(
        [("1", "France", 10.0), ("1", "France", 20.0), ("2", "Germany", 15.0), ("3", "Germany", 5.0)],
        "InvoiceNo string, Country string, TotalAmount double",
    )
    rows = [tuple(r) for r in agg.group_by_country(df).collect()]
    assert rows == [("France", 30.0, 1), ("Germany", 20.0, 2)]


def test_handle_missing_values_lenient(spark):
    df = spark.createDataFrame(
        [
            ("Lamp", 2, 10.0, "France", "2011-01-10 08:00", 12345.0),
            (None, 1, 5.0, "France", "2011-01-11 09:00", None),
            ("Chair", 0, 8.0, "Germany", "2011-01-12 10:00", 22222.0),
            ("Table", 4, 12.0, "Spain", "2011-01-13 11:00", None),
        ],
        "Description string, Quantity int, UnitPrice double, Country string, InvoiceDate string, CustomerID double",
    )
    out = cleaning.handle_missing_values_lenient(df).collect()
    assert [(r.Description, r.CustomerID) for r in out] == [("Lamp", 12345), ("Table", -1)]


def test_load_sources(spark, scratch):
    retail_csv = os.path.join(scratch, "retail.csv")
    with open(retail_csv, "w") as f:
        f.write("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n")
        f.write("1001,A1,Lamp,2,2011-01-10 08:00:00,10.0,12345,France\n")
    supplier_csv = os.path.join(scratch, "supplier.csv")
    with open(supplier_csv, "w") as f:
        f.write("InvoiceNo,Fournisseur\n1001,F100\n")
    mapping_csv = os.path.join(scratch, "mapping.csv")
    with open(mapping_csv, "w") as f:
        f.write("Country,Continent\nFrance,Europe\n")

    retail = load_source(spark, retail_csv, RETAIL)
    assert (retail.count(), len(retail.columns)) == (1, 8)
    assert retail.first().InvoiceDate == dt.datetime(2011, 1, 10, 8, 0)
    assert load_csv(spark, supplier_csv, SUPPLIER).first().Fournisseur == "F100"
    assert load_csv(spark, mapping_csv, MAPPING).first().Continent == "Europe"


def test_remove_duplicates(spark):
    df = spark.createDataFrame(
        [("1001", "Lamp", 2), ("1001", "Lamp", 2), ("1002", "Mug", 1)],
        "InvoiceNo string, Description string, Quantity int",
    )
    out = cleaning.remove_duplicates(df)
    assert sorted(r.InvoiceNo for r in out.collect()) == ["1001", "1002"]


def test_guarded_save_rejects_empty(spark, scratch):
    empty = spark.createDataFrame([], RETAIL)
    with pytest.raises(ValueError):
        save_parquet_guarded(empty, os.path.join(scratch, "out.parquet"))
