"""Edge cases D1-D12 and the column functions."""

import datetime as dt


from tillroll.functions import columns as C
from tillroll.operators import aggregates as agg
from tillroll.operators import cleaning, quality
from tillroll.schemas import RETAIL_TEXT
from tillroll.sources.writers import audit_path


def _raw(spark, rows):
    return spark.createDataFrame(rows, RETAIL_TEXT)


def test_cancelled_case_and_null_invoice(spark):
    df = spark.createDataFrame([("C1",), ("c2",), ("3",), (None,)], "InvoiceNo string")
    assert sorted(r.InvoiceNo for r in cleaning.filter_valid_transactions(df).collect()) == ["3"]
    lenient = cleaning.filter_valid_transactions(df, case_sensitive=True).collect()
    assert sorted((r.InvoiceNo or "") for r in lenient) == ["", "3", "c2"]


def test_blank_text_dropped_and_customer_filled(spark):
    df = spark.createDataFrame(
        [("", 1, 1.0, "FR", dt.datetime(2011, 1, 1), None), ("Lamp", 1, 1.0, "", dt.datetime(2011, 1, 1), 5),
         ("Lamp", 1, 1.0, "FR", dt.datetime(2011, 1, 1), None)],
        "Description string, Quantity int, UnitPrice double, Country string, InvoiceDate timestamp_ntz, CustomerID long",
    )
    rows = cleaning.handle_missing_values(df).collect()
    assert [(r.Description, r.CustomerID) for r in rows] == [("Lamp", -1)]


def test_trim_keeps_tabs_strip_removes_them(spark):
    df = spark.createDataFrame([("\t FR  ",)], "c string")
    r = df.select(C.trimmed_text("c").alias("t"), C.stripped_text("c").alias("s")).first()
    assert r.t == "\t FR" and r.s == "FR"


def test_decimal_comma_and_customer_id(spark):
    df = spark.createDataFrame([("12,5",), ("1.234,5",), ("1,234",), ("x",), ("12345.0",)], "v string")
    rows = df.select(
        C.decimal_text_to_double("v").alias("d"), C.decimal_text_to_int("v").alias("i"), C.to_customer_id("v").alias("c")
    ).collect()
    assert [r.d for r in rows] == [12.5, None, 1.234, None, 12345.0]
    assert [r.i for r in rows] == [12, None, 1, None, 12345]
    assert rows[4].c == 12345


def test_date_patterns_first_hit_wins(spark):
    df = spark.createDataFrame(
        [("3/7/2011 9:05",), ("03/07/2011 09:05",), ("3/7/2011 9:05:30",), ("2011-03-07 09:05:00",),
         ("25/3/2011 9:05",), ("junk",), (None,)],
        "s string",
    )
    got = [r.t for r in df.select(C.parse_timestamp("s").alias("t")).collect()]
    march7 = dt.datetime(2011, 3, 7, 9, 5)
    assert got == [march7, march7, dt.datetime(2011, 3, 7, 9, 5, 30), dt.datetime(2011, 3, 7, 9, 5), None, None, None]


def test_pattern_shape_is_a_superset(spark):
    assert C.pattern_shape("M/d/yyyy H:mm") == r"^\d+/\d+/\d+\ \d+:\d+$"
    assert C.pattern_shape("dd MMM yyyy") is None


def test_normalize_without_customer_column(spark):
    df = spark.createDataFrame(
        [(" 1 ", "A", " Lamp ", "2,0", "1/10/2011 8:00", "10,5", " FR ")],
        "InvoiceNo string, StockCode string, Description string, Quantity string, "
        "InvoiceDate string, UnitPrice string, Country string",
    )
    r = cleaning.normalize_types(df).first()
    assert (r.InvoiceNo, r.Description, r.Quantity, r.UnitPrice, r.Country) == ("1", "Lamp", 2, 10.5, "FR")
    assert r.InvoiceDate == dt.datetime(2011, 1, 10, 8, 0)
    assert "CustomerID" not in cleaning.normalize_types(df).columns


def test_lenient_dedup_runs_before_trim(spark):
    rows = [("1", "A", "Lamp", "1", "2011-01-10 08:00:00", "2.0", "5", "FR"),
            ("1", "A", "Lamp ", "1", "2011-01-10 08:00:00", "2.0", "5", "FR")]
    df = cleaning.coerce_numbers(_raw(spark, rows))
    assert cleaning.clean_lenient(df).count() == 2
    assert cleaning.clean_standard(_raw(spark, rows)).count() == 1


def _lines(spark):
    return spark.createDataFrame(
        [("1", "FR", 10.0), ("1", "FR", 5.0), ("2", "DE", 7.0), ("3", "XX", 1.0)],
        "InvoiceNo string, Country string, TotalAmount double",
    )


def test_supplier_null_group_and_fanout(spark):
    bridge = spark.createDataFrame([("1", "S1"), ("1", "S1"), ("1", "S2"), ("9", "S9")], "InvoiceNo string, Fournisseur string")
    rows = {r.SupplierID: r.TotalAmount for r in agg.aggregate_supplier_data(_lines(spark), bridge).collect()}
    # invoice 1 (15.0) is listed twice for S1 and once for S2; 2 and 3 have no supplier.
    assert rows == {"S1": 30.0, "S2": 15.0, None: 8.0}
    matched = {r.SupplierID: r.TotalAmount for r in agg.aggregate_supplier_data_matched_only(_lines(spark), bridge).collect()}
    assert matched == {"S1": 30.0, "S2": 15.0}


def test_supplier_numeric_bridge_key_is_text(spark):
    bridge = spark.createDataFrame([(1, "S1")], "InvoiceNo long, Fournisseur string")
    rows = {r.SupplierID: r.TotalAmount for r in agg.aggregate_supplier_data(_lines(spark), bridge).collect()}
    assert rows == {"S1": 15.0, None: 8.0}


def test_continent_sales_and_mapping_headers(spark):
    mapping = spark.createDataFrame([("FR", "Europe"), ("DE", "Europe")], "` country ` string, CONTINENT string")
    rows = {r.Continent: r.TotalAmount for r in agg.aggregate_world_data(_lines(spark), mapping).collect()}
    assert rows == {"Europe": 22.0, None: 1.0}


def test_cancellations_and_top_continent(spark):
    raw = spark.createDataFrame(
        [("C1", " FR"), ("C1", "FR"), ("c2", "DE"), ("C3", "US"), ("C4", "US"), ("5", "FR")],
        "InvoiceNo string, Country string",
    )
    mapping = spark.createDataFrame([("FR", "Europe"), ("DE", "Europe"), ("US", "America")], "Country string, Continent string")
    cancels = agg.build_cancellations_by_continent(raw, mapping)
    assert {r.Continent: r.CancelledOperations for r in cancels.collect()} == {"Europe": 2, "America": 2}
    # tie -> alphabetical
    assert agg.top_cancelled_continent(cancels).first()[0] == "America"


def test_best_product_and_empty_country(spark):
    df = spark.createDataFrame(
        [("France", "Lamp", 10.0), ("france", "Mug", 12.0), ("FRANCE", "Lamp", 3.0), ("Spain", "Cup", 99.0)],
        "Country string, Description string, TotalAmount double",
    )
    assert agg.best_product_in_country(df, "France").first()[0] == "Lamp"
    assert agg.best_product_in_country(df, "Peru").first()[0] is None


def test_hours_and_peak_tie(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2011, 1, 1, 9), "1"), (dt.datetime(2011, 1, 1, 9, 30), "1"),
         (dt.datetime(2011, 1, 1, 8), "2"), (dt.datetime(2011, 1, 2, 9), "3"), (dt.datetime(2011, 1, 2, 8), "4")],
        "InvoiceDate timestamp_ntz, InvoiceNo string",
    )
    by_hour = agg.transactions_by_hour(df)
    assert {r.InvoiceHour: r.InvoiceNo for r in by_hour.collect()} == {8: 2, 9: 2}
    assert agg.peak_hour(by_hour).first()[0] == 8


def test_waterfall_equals_step_counts(spark):
    rows = [
        ("1", "A", "Lamp", "1", "1/10/2011 8:00", "2.0", "5", "FR"),
        ("1", "A", "Lamp", "1", "1/10/2011 8:00", "2.0", "5", "FR"),
        ("C2", "A", "Lamp", "1", "1/10/2011 8:00", "2.0", "5", "FR"),
        ("3", "A", "", "1", "1/10/2011 8:00", "2.0", "5", "FR"),
        ("4", "A", "Mug", "0", "1/10/2011 8:00", "2.0", None, "FR"),
        ("5", "A", "Mug", "1", "bad", "2.0", "5", "FR"),
        ("6", "A", "Mug", "3", "2011-01-10 08:00:00", "1,5", "5", "DE"),
    ]
    raw = _raw(spark, rows)
    got = {r.step: r.row_count for r in quality.cleaning_waterfall(raw).collect()}
    norm = cleaning.normalize_types(raw)
    dedup = cleaning.remove_duplicates(norm)
    missing = cleaning.handle_missing_values(dedup)
    valid = cleaning.filter_valid_transactions(missing)
    bounded = cleaning.filter_outliers(valid)
    assert got["raw_retail"] == 7
    assert got["after remove_duplicates"] == dedup.count() == 6
    assert got["missing_InvoiceDate"] == 1
    assert got["after handle_missing_values"] == missing.count()
    assert got["after filter_valid_transactions"] == valid.count()
    assert got["after filter_outliers"] == got["cleaned"] == bounded.count() == 2
    assert len(got) == 13


def test_nice_number_and_share(spark):
    df = spark.createDataFrame([(2_500_000.0,), (1234.0,), (42.0,), (3.14159,), (0.0,)], "v double")
    out = df.select(C.nice_number("v").alias("l"), C.share_of_max("v").alias("s")).collect()
    assert [r.l for r in out] == ["2.5M", "1.2K", "42", "3.14", "0"]
    assert out[0].s == 1.0
    zero = spark.createDataFrame([(0.0,)], "v double").select(C.share_of_max("v")).first()[0]
    assert zero == 0.0


def test_run_id_from_file_name(spark):
    df = spark.createDataFrame(
        [("part-00000-7b75031d-2ada-4122-9420-12e5f00020ad-c000.snappy.parquet",), ("country_sales.parquet",)], "n string"
    )
    got = [r[0] for r in df.select(C.run_id_from_file_name("n")).collect()]
    assert got == ["7b75031d-2ada-4122-9420-12e5f00020ad", "country_sales"]


def test_audit_path():
    assert audit_path("s3://b/out/cleaned/", "cleaned", "cleaning_job") == "s3://b/out/debug_counts_cleaning_job/"
    assert audit_path("/data/x", "cleaned", "cleaning_job") == "/data/x_debug_cleaning_job/"


def test_in_year_is_a_range(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2010, 12, 31, 23, 59),), (dt.datetime(2011, 1, 1),), (dt.datetime(2011, 12, 31, 23, 59),), (dt.datetime(2012, 1, 1),)],
        "d timestamp_ntz",
    )
    assert df.filter(C.in_year("d", 2011)).count() == 2
