"""Reference SQL for every registered query, runnable by DuckDB over the
driver's tables (pre-registered as views named like the Parquet files).

These statements spell out each operator in its plain row-level form (for
example the supplier join without the pre-aggregation the Spark plan uses), so
agreement checks the optimised plan against the naive semantics.
"""

from __future__ import annotations

from tillroll.plans.params import (
    BEST_PRODUCT_COUNTRY,
    CHART_TOP_N,
    MARKET_COUNTRY,
    MARKET_YEAR,
)

LINES = """
lines AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_discount, l.l_tax,
         l.l_returnflag, l.l_linestatus, o.o_custkey, o.o_orderdate, p.p_name, p.p_retailprice, n.n_name
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

RETAIL = """
retail AS (
  SELECT CASE WHEN l_returnflag = 'R' THEN 'C' || CAST(l_orderkey AS VARCHAR)
              ELSE CAST(l_orderkey AS VARCHAR) END AS InvoiceNo,
         CAST(l_partkey AS VARCHAR) AS StockCode,
         p_name AS Description,
         CAST(trunc(l_quantity) AS INTEGER) AS Quantity,
         o_orderdate AS InvoiceDate,
         p_retailprice AS UnitPrice,
         o_custkey AS CustomerID,
         n_name AS Country
  FROM lines
)"""

DIRTY = """
dirty_base AS (
  SELECT *, l_linenumber AS ln,
         CAST(round(l_tax * 100) AS INTEGER) AS tx,
         CAST(round(l_discount * 100) AS INTEGER) AS dc,
         CAST(trunc(l_quantity) AS INTEGER) AS qty,
         l_linenumber + 8 AS hh,
         CAST(round(l_tax * 100) AS INTEGER) * 5 AS mm,
         CAST(year(o_orderdate) AS VARCHAR) AS y,
         CAST(month(o_orderdate) AS VARCHAR) AS m,
         CAST(day(o_orderdate) AS VARCHAR) AS d,
         lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0') AS m2,
         lpad(CAST(day(o_orderdate) AS VARCHAR), 2, '0') AS d2,
         CASE WHEN l_returnflag = 'R'
              THEN (CASE WHEN l_linestatus = 'O' THEN 'c' ELSE 'C' END) || CAST(l_orderkey AS VARCHAR)
              ELSE CAST(l_orderkey AS VARCHAR) END AS inv,
         printf('%.2f', p_retailprice) AS price_text
  FROM lines
),
dirty_rows AS (
  SELECT ln, dc,
    CASE WHEN ln = 3 THEN ' ' || inv || ' ' ELSE inv END AS InvoiceNo,
    CAST(l_partkey AS VARCHAR) AS StockCode,
    CASE WHEN ln = 7 AND tx = 0 THEN NULL
         WHEN ln = 7 AND tx = 1 THEN ''
         WHEN ln = 2 THEN '  ' || p_name || ' '
         ELSE p_name END AS Description,
    CASE WHEN dc = 10 THEN CAST(qty * 1000 AS VARCHAR)
         WHEN ln = 4 THEN CAST(qty AS VARCHAR) || ',0'
         WHEN ln = 5 THEN CAST(qty AS VARCHAR) || '.0'
         WHEN ln = 1 AND tx = 8 THEN NULL
         ELSE CAST(qty AS VARCHAR) END AS Quantity,
    CASE WHEN ln = 2 THEN m2 || '/' || d2 || '/' || y || ' ' || lpad(CAST(hh AS VARCHAR), 2, '0') || ':' || lpad(CAST(mm AS VARCHAR), 2, '0')
         WHEN ln = 3 THEN m || '/' || d || '/' || y || ' ' || CAST(hh AS VARCHAR) || ':' || lpad(CAST(mm AS VARCHAR), 2, '0') || ':00'
         WHEN ln = 4 THEN y || '-' || m2 || '-' || d2 || ' ' || lpad(CAST(hh AS VARCHAR), 2, '0') || ':' || lpad(CAST(mm AS VARCHAR), 2, '0') || ':00'
         WHEN ln = 5 THEN d || '/' || m || '/' || y || ' ' || CAST(hh AS VARCHAR) || ':' || lpad(CAST(mm AS VARCHAR), 2, '0')
         WHEN ln = 6 THEN 'not a date'
         ELSE m || '/' || d || '/' || y || ' ' || CAST(hh AS VARCHAR) || ':' || lpad(CAST(mm AS VARCHAR), 2, '0') END AS InvoiceDate,
    CASE WHEN dc = 0 THEN '0'
         WHEN ln = 5 THEN replace(price_text, '.', ',')
         ELSE price_text END AS UnitPrice,
    CASE WHEN tx = 1 THEN NULL
         WHEN ln = 2 THEN CAST(o_custkey AS VARCHAR) || '.0'
         ELSE CAST(o_custkey AS VARCHAR) END AS CustomerID,
    CASE WHEN ln = 3 THEN ' ' || n_name || '  '
         WHEN ln = 4 AND tx = 2 THEN chr(9) || n_name
         WHEN ln = 1 AND dc = 5 THEN ''
         ELSE n_name END AS Country
  FROM dirty_base
),
dirty AS (
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM dirty_rows
  UNION ALL
  SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country FROM dirty_rows
  WHERE ln = 1 AND dc <= 2
)"""

MAPPING = """
mapping AS (
  SELECT n.n_name AS Country, r.r_name AS Continent
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE r.r_name <> 'MIDDLE EAST'
)"""

BRIDGE = """
bridge AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNo, CAST(min(l_suppkey) AS VARCHAR) AS SupplierID
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey
)"""

BRIDGE_FANOUT = """
bridge_fanout AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS InvoiceNo, CAST(l_suppkey AS VARCHAR) AS SupplierID FROM lineitem
)"""

# Text -> typed, same rules as normalize_types.
_QTY = "TRY_CAST(trunc(TRY_CAST(replace({c}, ',', '.') AS DOUBLE)) AS INTEGER)"
_PRICE = "TRY_CAST(replace({c}, ',', '.') AS DOUBLE)"
_CUST = "TRY_CAST(trunc(TRY_CAST({c} AS DOUBLE)) AS BIGINT)"
_DATE = (
    "COALESCE(try_strptime({c}, '%m/%d/%Y %H:%M'), try_strptime({c}, '%m/%d/%Y %H:%M:%S'), "
    "TRY_CAST({c} AS TIMESTAMP))"
)
_DATE_LENIENT = (
    "COALESCE(TRY_CAST({c} AS TIMESTAMP), try_strptime({c}, '%m/%d/%Y %H:%M'), "
    "try_strptime({c}, '%m/%d/%Y %H:%M:%S'))"
)
_STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"

NORM_DIRTY = f"""
norm AS (
  SELECT trim(InvoiceNo) AS InvoiceNo, trim(StockCode) AS StockCode, trim(Description) AS Description,
         {_QTY.format(c='Quantity')} AS Quantity,
         {_DATE.format(c='InvoiceDate')} AS InvoiceDate,
         {_PRICE.format(c='UnitPrice')} AS UnitPrice,
         {_CUST.format(c='CustomerID')} AS CustomerID,
         trim(Country) AS Country
  FROM dirty
)"""

NORM_RETAIL = """
norm_retail AS (
  SELECT trim(InvoiceNo) AS InvoiceNo, trim(StockCode) AS StockCode, trim(Description) AS Description,
         Quantity, InvoiceDate, UnitPrice, CustomerID, trim(Country) AS Country
  FROM retail
)"""

_COLS = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, CustomerID, Country"
_COLS_FILLED = "InvoiceNo, StockCode, Description, Quantity, InvoiceDate, UnitPrice, COALESCE(CustomerID, -1) AS CustomerID, Country"
_MISSING_OK = (
    "Description IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL AND Country IS NOT NULL "
    "AND InvoiceDate IS NOT NULL AND Description <> '' AND Country <> ''"
)
_VALID = "NOT starts_with(upper(InvoiceNo), 'C')"
_BOUNDS = "Quantity BETWEEN 1 AND 10000 AND UnitPrice BETWEEN 0.01 AND 10000.0"


def _clean_standard(src: str, name: str) -> str:
    return f"""
{name} AS (
  SELECT {_COLS_FILLED} FROM (SELECT DISTINCT {_COLS} FROM {src})
  WHERE {_MISSING_OK} AND {_VALID} AND {_BOUNDS}
)"""


ENRICHED = _clean_standard("norm_retail", "cleaned") + """,
enriched AS (
  SELECT *, round(Quantity * UnitPrice, 2) AS TotalAmount FROM cleaned
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


ENRICHED_CTES = (LINES, RETAIL, NORM_RETAIL, ENRICHED)
DIRTY_CTES = (LINES, DIRTY, NORM_DIRTY)

_COUNTRY_SALES = """
SELECT Country, round(sum(TotalAmount), 2) AS TotalAmount, count(DISTINCT InvoiceNo) AS TransactionCount
FROM enriched GROUP BY Country ORDER BY TotalAmount DESC, TransactionCount DESC"""

_SUPPLIER_SALES = """
SELECT b.SupplierID AS SupplierID, round(sum(e.TotalAmount), 2) AS TotalAmount
FROM {src} e LEFT JOIN {bridge} b ON e.InvoiceNo = b.InvoiceNo
GROUP BY b.SupplierID ORDER BY TotalAmount DESC"""

_MARKET = f"SELECT * FROM enriched WHERE Country = '{MARKET_COUNTRY}' AND year(InvoiceDate) = {MARKET_YEAR}"

_CANCELLATIONS = """
SELECT m.Continent AS Continent, count(DISTINCT r.InvoiceNo) AS CancelledOperations
FROM (SELECT InvoiceNo, trim(Country) AS Country FROM dirty) r
LEFT JOIN mapping m ON r.Country = m.Country
WHERE starts_with(upper(r.InvoiceNo), 'C')
GROUP BY m.Continent ORDER BY CancelledOperations DESC"""

_BY_HOUR = """
SELECT CAST(hour(InvoiceDate) AS INTEGER) AS InvoiceHour, count(DISTINCT InvoiceNo) AS InvoiceNo
FROM cleaned GROUP BY 1 ORDER BY InvoiceNo DESC, InvoiceHour"""


def _nice(v: str) -> str:
    return (
        f"CASE WHEN {v} IS NULL THEN NULL "
        f"WHEN abs({v}) >= 1000000 THEN printf('%.1fM', {v} / 1000000) "
        f"WHEN abs({v}) >= 1000 THEN printf('%.1fK', {v} / 1000) "
        f"WHEN {v} = floor({v}) THEN CAST(CAST({v} AS BIGINT) AS VARCHAR) "
        f"ELSE printf('%.2f', {v}) END"
    )


# Spark's simple type names of the enriched columns.
_ENRICHED_TYPES = (
    ("InvoiceNo", "string"), ("StockCode", "string"), ("Description", "string"),
    ("Quantity", "int"), ("InvoiceDate", "timestamp_ntz"), ("UnitPrice", "double"),
    ("CustomerID", "bigint"), ("Country", "string"), ("TotalAmount", "double"),
)


def oracle_sql() -> dict[str, str]:
    e = _with(*ENRICHED_CTES)
    em = _with(*ENRICHED_CTES, MAPPING)
    eb = _with(*ENRICHED_CTES, BRIDGE)
    ebf = _with(*ENRICHED_CTES, BRIDGE_FANOUT)
    dm = _with(LINES, DIRTY, MAPPING)
    d = _with(*DIRTY_CTES)
    dc = _with(*DIRTY_CTES, _clean_standard("norm", "cleaned"))

    q: dict[str, str] = {}
    q["country_sales"] = e + _COUNTRY_SALES
    q["country_sales_sum_only"] = e + """
SELECT Country, sum(TotalAmount) AS TotalAmount FROM enriched
WHERE Country IS NOT NULL GROUP BY Country ORDER BY TotalAmount DESC"""
    q["monthly_sales"] = e + """
SELECT strftime(InvoiceDate, '%Y-%m') AS InvoiceMonth, round(sum(TotalAmount), 2) AS TotalSales,
       count(DISTINCT InvoiceNo) AS TransactionCount
FROM enriched GROUP BY 1 ORDER BY InvoiceMonth"""
    q["supplier_sales"] = eb + _SUPPLIER_SALES.format(src="enriched", bridge="bridge")
    q["supplier_sales_fanout"] = ebf + _SUPPLIER_SALES.format(src="enriched", bridge="bridge_fanout")
    q["supplier_sales_matched_only"] = eb + """
SELECT b.SupplierID AS SupplierID, sum(e.TotalAmount) AS TotalAmount
FROM enriched e JOIN bridge b ON e.InvoiceNo = b.InvoiceNo
WHERE b.SupplierID IS NOT NULL GROUP BY b.SupplierID ORDER BY TotalAmount DESC"""
    q["supplier_sales_country_year"] = eb + _SUPPLIER_SALES.format(src=f"({_MARKET})", bridge="bridge")
    q["monthly_sales_unrounded"] = e + """
SELECT strftime(InvoiceDate, '%Y-%m') AS InvoiceMonth, sum(TotalAmount) AS TotalSales,
       count(DISTINCT InvoiceNo) AS TransactionCount
FROM enriched GROUP BY 1 ORDER BY InvoiceMonth"""
    q["continent_sales_mapped_only"] = em + """
SELECT m.Continent AS Continent, sum(e.TotalAmount) AS TotalAmount
FROM enriched e JOIN mapping m ON e.Country = m.Country
WHERE m.Continent IS NOT NULL GROUP BY m.Continent ORDER BY TotalAmount DESC"""
    q["cancellations_case_sensitive"] = dm + f"""
SELECT m.Continent AS Continent, count(DISTINCT r.InvoiceNo) AS CancelledOperations
FROM (SELECT InvoiceNo, {_STRIP.format(c='Country')} AS Country FROM dirty) r
JOIN mapping m ON r.Country = m.Country
WHERE starts_with(r.InvoiceNo, 'C') AND m.Continent IS NOT NULL
GROUP BY m.Continent ORDER BY CancelledOperations DESC"""
    q["continent_sales"] = em + """
SELECT m.Continent AS Continent, round(sum(e.TotalAmount), 2) AS TotalAmount
FROM enriched e LEFT JOIN mapping m ON e.Country = m.Country
GROUP BY m.Continent ORDER BY TotalAmount DESC"""
    q["cancellations_by_continent"] = dm + _CANCELLATIONS
    q["top_cancelled_continent"] = dm + f"""
, c AS ({_CANCELLATIONS})
SELECT (SELECT Continent FROM c WHERE Continent IS NOT NULL
        ORDER BY CancelledOperations DESC, Continent LIMIT 1) AS top_cancelled_continent"""
    q["best_product_in_country"] = e + f"""
, p AS (SELECT Description, sum(TotalAmount) AS sales FROM enriched
        WHERE lower(Country) = lower('{BEST_PRODUCT_COUNTRY}') AND Description IS NOT NULL GROUP BY Description)
SELECT (SELECT Description FROM p WHERE sales IS NOT NULL ORDER BY sales DESC, Description LIMIT 1) AS best_product"""
    q["best_product_raw_sums"] = e + """
, p AS (SELECT Description, sum(CASE WHEN StockCode LIKE '%7' THEN NULL ELSE Quantity / 4096.0 END) AS sales FROM enriched
        WHERE Quantity <> 1 AND Description IS NOT NULL GROUP BY Description)
SELECT (SELECT Description FROM p WHERE sales IS NOT NULL ORDER BY sales DESC, Description LIMIT 1) AS best_product"""
    q["transactions_by_hour"] = dc + _BY_HOUR
    q["peak_hour"] = dc + f"""
, h AS ({_BY_HOUR})
SELECT (SELECT InvoiceHour FROM h ORDER BY InvoiceNo DESC, InvoiceHour LIMIT 1) AS peak_hour"""
    q["lines_with_continent"] = em + """
SELECT e.*, m.Continent AS Continent FROM enriched e LEFT JOIN mapping m ON e.Country = m.Country"""
    q["total_amount"] = e + "SELECT * FROM enriched"
    q["total_amount_unrounded"] = _with(LINES, RETAIL) + "SELECT *, Quantity * UnitPrice AS TotalAmount FROM retail"

    q["normalize_types"] = d + "SELECT * FROM norm"
    q["parse_decimal_comma"] = d + f"""
SELECT Quantity AS QuantityText, {_QTY.format(c='Quantity')} AS Quantity,
       UnitPrice AS UnitPriceText, {_PRICE.format(c='UnitPrice')} AS UnitPrice
FROM dirty"""
    q["parse_dates_multi_format"] = d + f"""
SELECT InvoiceDate AS InvoiceDateText, {_DATE.format(c='InvoiceDate')} AS InvoiceDate,
       {_DATE_LENIENT.format(c='InvoiceDate')} AS InvoiceDateLenient
FROM dirty"""
    q["remove_duplicates"] = d + "SELECT DISTINCT * FROM dirty"
    q["handle_missing_values"] = d + f"SELECT {_COLS_FILLED} FROM norm WHERE {_MISSING_OK}"
    q["price_quantity_positive"] = d + "SELECT * FROM norm WHERE UnitPrice > 0 AND Quantity <> 0"
    q["valid_transactions"] = d + f"SELECT * FROM norm WHERE {_VALID}"
    q["outlier_filter"] = d + f"SELECT * FROM norm WHERE {_BOUNDS}"
    q["clean_standard"] = _with(*DIRTY_CTES, _clean_standard("norm", "cleaned")) + "SELECT * FROM cleaned"
    q["clean_lenient"] = d + f"""
, typed AS (
  SELECT InvoiceNo, StockCode, Description, {_QTY.format(c='Quantity')} AS Quantity, InvoiceDate,
         {_PRICE.format(c='UnitPrice')} AS UnitPrice, {_CUST.format(c='CustomerID')} AS CustomerID, Country
  FROM dirty
), kept AS (
  SELECT {_COLS_FILLED} FROM (SELECT DISTINCT * FROM typed)
  WHERE Description IS NOT NULL AND Quantity IS NOT NULL AND UnitPrice IS NOT NULL
    AND Country IS NOT NULL AND InvoiceDate IS NOT NULL AND UnitPrice > 0 AND Quantity <> 0
    AND NOT COALESCE(starts_with(InvoiceNo, 'C'), false)
)
SELECT InvoiceNo, StockCode, {_STRIP.format(c='Description')} AS Description, Quantity,
       {_DATE_LENIENT.format(c='InvoiceDate')} AS InvoiceDate, UnitPrice, CustomerID,
       {_STRIP.format(c='Country')} AS Country
FROM kept WHERE {_DATE_LENIENT.format(c='InvoiceDate')} IS NOT NULL"""

    steps = [
        ("raw_retail", "count(*)", "norm"),
        ("initial dataset", "count(*)", "norm"),
        ("after normalize_types", "count(*)", "norm"),
        ("after remove_duplicates", "count(*)", "dd"),
        ("missing_Description", "count(*) FILTER (WHERE Description IS NULL)", "dd"),
        ("missing_Quantity", "count(*) FILTER (WHERE Quantity IS NULL)", "dd"),
        ("missing_UnitPrice", "count(*) FILTER (WHERE UnitPrice IS NULL)", "dd"),
        ("missing_Country", "count(*) FILTER (WHERE Country IS NULL)", "dd"),
        ("missing_InvoiceDate", "count(*) FILTER (WHERE InvoiceDate IS NULL)", "dd"),
        ("after handle_missing_values", f"count(*) FILTER (WHERE {_MISSING_OK})", "dd"),
        ("after filter_valid_transactions", f"count(*) FILTER (WHERE {_MISSING_OK} AND {_VALID})", "dd"),
        ("after filter_outliers", f"count(*) FILTER (WHERE {_MISSING_OK} AND {_VALID} AND {_BOUNDS})", "dd"),
        ("cleaned", f"count(*) FILTER (WHERE {_MISSING_OK} AND {_VALID} AND {_BOUNDS})", "dd"),
    ]
    union = "\nUNION ALL ".join(f"SELECT '{s}' AS step, {expr} AS row_count FROM {src}" for s, expr, src in steps)
    q["cleaning_waterfall"] = d + f", dd AS (SELECT DISTINCT * FROM norm)\n{union}"

    market = f"(SELECT * FROM enriched WHERE Country = '{MARKET_COUNTRY}' AND year(InvoiceDate) = {MARKET_YEAR})"
    volumes = [
        ("enriched_input", "SELECT count(*) FROM enriched"),
        ("raw_retail", "SELECT count(*) FROM retail"),
        ("supplier", "SELECT count(*) FROM bridge"),
        ("mapping", "SELECT count(*) FROM mapping"),
        ("country_sales", "SELECT count(*) FROM (SELECT Country FROM enriched GROUP BY 1)"),
        ("monthly_stats", "SELECT count(*) FROM (SELECT strftime(InvoiceDate, '%Y-%m') FROM enriched GROUP BY 1)"),
        ("supplier_sales", "SELECT count(*) FROM (SELECT b.SupplierID FROM enriched e LEFT JOIN bridge b ON e.InvoiceNo = b.InvoiceNo GROUP BY 1)"),
        ("supplier_uk_2011", f"SELECT count(*) FROM (SELECT b.SupplierID FROM {market} e LEFT JOIN bridge b ON e.InvoiceNo = b.InvoiceNo GROUP BY 1)"),
        ("continent_sales", "SELECT count(*) FROM (SELECT m.Continent FROM enriched e LEFT JOIN mapping m ON e.Country = m.Country GROUP BY 1)"),
        ("cancellations_by_continent", "SELECT count(*) FROM (SELECT m.Continent FROM retail r LEFT JOIN mapping m ON trim(r.Country) = m.Country WHERE starts_with(upper(r.InvoiceNo), 'C') GROUP BY 1)"),
    ]
    union = "\nUNION ALL ".join(f"SELECT '{s}' AS step, ({sql}) AS row_count" for s, sql in volumes)
    q["result_volumes"] = _with(*ENRICHED_CTES, MAPPING, BRIDGE) + union

    profile = "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, {i} AS ordinal, "
        f"(SELECT count(*) FROM enriched) AS row_count, {len(_ENRICHED_TYPES)} AS column_count"
        for i, (c, t) in enumerate(_ENRICHED_TYPES, start=1)
    )
    q["dataset_profile"] = e + profile

    def chart(ctes: str, rows: str, label: str, value: str) -> str:
        return ctes + f"""
, src AS ({rows})
, top AS (SELECT {label}, {value} FROM src WHERE {label} IS NOT NULL AND {value} IS NOT NULL
          ORDER BY {value} DESC, {label} LIMIT {CHART_TOP_N})
SELECT CAST(row_number() OVER (ORDER BY {value} DESC, {label}) AS INTEGER) AS position,
       {label}, {value}, {_nice(f'CAST({value} AS DOUBLE)')} AS value_label,
       {value} / COALESCE(NULLIF(max(CAST({value} AS DOUBLE)) OVER (), 0), 1) AS share
FROM top"""

    continents = "SELECT m.Continent AS Continent, round(sum(e.TotalAmount), 2) AS TotalAmount FROM enriched e LEFT JOIN mapping m ON e.Country = m.Country GROUP BY m.Continent"
    q["chart_top_countries"] = chart(e, _COUNTRY_SALES, "Country", "TotalAmount")
    q["chart_top_suppliers"] = chart(eb, _SUPPLIER_SALES.format(src="enriched", bridge="bridge"), "SupplierID", "TotalAmount")
    q["chart_market_suppliers"] = chart(eb, _SUPPLIER_SALES.format(src=f"({_MARKET})", bridge="bridge"), "SupplierID", "TotalAmount")
    q["chart_continents"] = chart(em, continents, "Continent", "TotalAmount")
    q["chart_cancellations"] = chart(dm, _CANCELLATIONS, "Continent", "CancelledOperations")
    q["chart_monthly_line"] = e + f"""
, m AS (SELECT strftime(InvoiceDate, '%Y-%m') AS InvoiceMonth, round(sum(TotalAmount), 2) AS TotalSales FROM enriched GROUP BY 1)
SELECT InvoiceMonth, TotalSales, {_nice('TotalSales')} AS value_label,
       TotalSales / COALESCE(NULLIF((SELECT max(TotalSales) FROM m), 0), 1) AS share
FROM m WHERE InvoiceMonth IS NOT NULL AND TotalSales IS NOT NULL ORDER BY InvoiceMonth"""
    q["number_labels"] = f"""
WITH v AS (SELECT l_quantity * 50 AS value FROM lineitem UNION SELECT l_quantity / 8 FROM lineitem
           UNION SELECT l_quantity * 50000 + 1000000 FROM lineitem)
SELECT value, {_nice('value')} AS label FROM v"""
    q["lines_with_supplier"] = ebf + """
SELECT e.*, b.SupplierID AS SupplierID FROM enriched e LEFT JOIN bridge_fanout b ON e.InvoiceNo = b.InvoiceNo"""
    q["csv_reordered_header"] = q["country_sales"]
    q["catalog_table_scan"] = q["country_sales"]
    q["result_dir_scan"] = q["monthly_sales"]
    q["monthly_preview"] = q["monthly_sales"] + " LIMIT 10"
    q["csv_preview_roundtrip"] = q["monthly_preview"]
    q["optional_sources"] = "SELECT 'orders' AS step, count(*) AS row_count FROM orders UNION ALL SELECT 'absent', 0"
    q["cleaning_job_audit"] = q["cleaning_waterfall"]
    q["enrich_job"] = dc + "SELECT *, round(Quantity * UnitPrice, 2) AS TotalAmount FROM cleaned"
    q["aggregation_job_audit"] = q["result_volumes"]
    q["single_machine_save"] = q["clean_lenient"].replace("\nSELECT InvoiceNo, StockCode, ", "\n, lenient AS (SELECT InvoiceNo, StockCode, ") + (
        ") SELECT *, Quantity * UnitPrice AS TotalAmount FROM lenient")
    q["all_in_one_answers"] = em + """
, p AS (SELECT Description, sum(TotalAmount) AS sales FROM enriched WHERE lower(Country) = lower('__BEST__') GROUP BY Description)
, h AS (SELECT CAST(hour(InvoiceDate) AS INTEGER) AS hr, count(DISTINCT InvoiceNo) AS n FROM enriched GROUP BY 1)
, c AS (SELECT m.Continent AS Continent, count(DISTINCT r.InvoiceNo) AS n FROM retail r LEFT JOIN mapping m ON trim(r.Country) = m.Country
        WHERE starts_with(upper(r.InvoiceNo), 'C') GROUP BY 1)
SELECT (SELECT Description FROM p ORDER BY sales DESC, Description LIMIT 1) AS best_product,
       (SELECT hr FROM h ORDER BY n DESC, hr LIMIT 1) AS peak_hour,
       (SELECT Continent FROM c WHERE Continent IS NOT NULL ORDER BY n DESC, Continent LIMIT 1) AS top_cancelled_continent""".replace("__BEST__", BEST_PRODUCT_COUNTRY)
    q["world_bundle"] = _with(*ENRICHED_CTES, DIRTY, MAPPING) + f"""
, c AS ({_CANCELLATIONS})
SELECT 'sales' AS result, Continent, TotalAmount AS value FROM ({continents})
UNION ALL SELECT 'cancellations', Continent, CAST(CancelledOperations AS DOUBLE) FROM c
UNION ALL SELECT 'lines', m.Continent, CAST(count(*) AS DOUBLE) FROM enriched e LEFT JOIN mapping m ON e.Country = m.Country GROUP BY m.Continent
UNION ALL SELECT 'top', (SELECT Continent FROM c WHERE Continent IS NOT NULL ORDER BY CancelledOperations DESC, Continent LIMIT 1), 1.0"""

    def profile_of(name: str, src: str, columns: list[tuple[str, str]]) -> str:
        order = ", ".join(f"{c} ASC NULLS FIRST" for c, _ in columns)
        return "\nUNION ALL ".join(
            f"SELECT '{name}' AS dataset, '{c}' AS column_name, '{t}' AS data_type, {i} AS ordinal, "
            f"(SELECT string_agg(coalesce(CAST({c} AS VARCHAR), 'null'), '|' ORDER BY {order}) FROM (SELECT * FROM {src} ORDER BY {order} LIMIT 5)) AS preview, "
            f"(SELECT count(*) FROM {src}) AS row_count, {len(columns)} AS column_count"
            for i, (c, t) in enumerate(columns, start=1)
        )

    q["folder_profile"] = _with(*DIRTY_CTES, _clean_standard("norm", "cleaned"), MAPPING) + f"""
, cancels AS ({_CANCELLATIONS}), hours AS ({_BY_HOUR})
""" + "\nUNION ALL ".join([
        profile_of("cancellations_by_continent", "cancels", [("Continent", "string"), ("CancelledOperations", "bigint")]),
        profile_of("mapping", "mapping", [("country", "string"), ("continent", "string")]),
        profile_of("transactions_by_hour", "hours", [("InvoiceHour", "int"), ("InvoiceNo", "bigint")]),
    ])
    q["parquet_roundtrip"] = q["country_sales"]
    q["csv_header_roundtrip"] = q["monthly_sales"]
    q["json_counts_roundtrip"] = q["cleaning_waterfall"]
    q["csv_quoted_roundtrip"] = _with(LINES, RETAIL) + """
SELECT InvoiceNo, StockCode,
       CASE Quantity % 5 WHEN 0 THEN 'SIGN "' || Description || '", LARGE'
                         WHEN 1 THEN Description || chr(10) || 'second line, with a comma'
                         WHEN 2 THEN '"' || Description || '"'
                         WHEN 3 THEN Description || ' ' || chr(92) || '" '
                         ELSE Description END AS Description,
       Quantity, UnitPrice, CustomerID, Country FROM retail"""
    q["csv_accepted_rows"] = _with(LINES, RETAIL) + """
SELECT InvoiceNo, StockCode,
       CASE WHEN Quantity % 10 = 1 THEN Description || ', "A1"' || chr(10) || 'second line' ELSE Description END AS Description,
       Quantity, InvoiceDate, UnitPrice, CustomerID, Country
FROM retail WHERE Quantity % 10 NOT IN (0, 2, 3, 4)"""
    q["csv_rejected_records"] = _with(LINES, RETAIL) + """
, t AS (SELECT *, Quantity % 10 AS q, strftime(InvoiceDate, '%Y-%m-%d %H:%M:%S') AS d FROM retail WHERE Quantity % 10 IN (0, 2, 3, 4))
SELECT CASE q WHEN 0 THEN 'not 8 fields' WHEN 2 THEN 'Quantity is no int: two' WHEN 3 THEN 'UnitPrice is no double: 12,50'
              ELSE 'InvoiceDate is no timestamp_ntz: not a date; UnitPrice is no double: 12,50' END AS reject_reason,
       concat_ws(',', InvoiceNo, StockCode, CASE WHEN q = 0 THEN Description || ', LARGE' ELSE Description END,
                 CASE WHEN q = 2 THEN 'two' ELSE CAST(Quantity AS VARCHAR) END, CASE WHEN q = 4 THEN 'not a date' ELSE d END,
                 CASE WHEN q IN (3, 4) THEN '"12,50"' ELSE CAST(UnitPrice AS VARCHAR) END, CAST(CustomerID AS VARCHAR), Country) AS reject_record
FROM t"""
    q["supplier_sales_by_month_layout"] = q["supplier_sales_country_year"]
    q["sales_of_listed_months"] = e + """
SELECT Country, round(sum(TotalAmount), 2) AS TotalAmount, count(DISTINCT InvoiceNo) AS TransactionCount
FROM enriched WHERE strftime(InvoiceDate, '%Y-%m') IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_totalprice >= 480000)
GROUP BY Country"""
    q["clustered_market_lines"] = e + f"{_MARKET} AND Quantity BETWEEN 1 AND 30 AND UnitPrice BETWEEN 950 AND 1500"
    q["supplier_sales_colocated"] = q["supplier_sales_fanout"]
    q["stored_invoice_counts"] = dc + """
SELECT 'country' AS dimension, Country AS value, count(DISTINCT InvoiceNo) AS invoices FROM cleaned GROUP BY Country
UNION ALL SELECT 'month', strftime(InvoiceDate, '%Y-%m'), count(DISTINCT InvoiceNo) FROM cleaned GROUP BY 2
UNION ALL SELECT 'hour', CAST(hour(InvoiceDate) AS VARCHAR), count(DISTINCT InvoiceNo) FROM cleaned GROUP BY 2"""
    q["incremental_distinct_lines"] = d + "SELECT DISTINCT * FROM norm WHERE InvoiceNo IS NOT NULL"
    q["published_results"] = _with(*ENRICHED_CTES, MAPPING, BRIDGE) + f"""
SELECT 'country_sales' AS result, Country AS key, round(sum(TotalAmount), 2) AS value FROM enriched GROUP BY Country
UNION ALL SELECT 'monthly_stats', strftime(InvoiceDate, '%Y-%m'), round(sum(TotalAmount), 2) FROM enriched GROUP BY 2
UNION ALL SELECT 'supplier_sales', SupplierID, TotalAmount FROM ({_SUPPLIER_SALES.format(src="enriched", bridge="bridge")})
UNION ALL SELECT 'supplier_uk_2011', SupplierID, TotalAmount FROM ({_SUPPLIER_SALES.format(src=f"({_MARKET})", bridge="bridge")})
UNION ALL SELECT 'continent_sales', Continent, TotalAmount FROM ({continents})
UNION ALL SELECT 'cancellations_by_continent', m.Continent, CAST(count(DISTINCT r.InvoiceNo) AS DOUBLE)
  FROM retail r LEFT JOIN mapping m ON trim(r.Country) = m.Country WHERE starts_with(upper(r.InvoiceNo), 'C') GROUP BY m.Continent"""
    q["run_manifest_classified"] = _with(*ENRICHED_CTES, MAPPING, BRIDGE) + f"""
SELECT 'enriched' AS destination,
       'InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country,TotalAmount' AS columns,
       (SELECT count(*) FROM enriched) AS total_rows
UNION ALL
SELECT 'country_sales', 'Country,TotalAmount,TransactionCount',
       (SELECT count(*) FROM (SELECT Country FROM enriched GROUP BY 1))
UNION ALL
SELECT 'monthly_sales', 'InvoiceMonth,TotalSales,TransactionCount',
       (SELECT count(*) FROM (SELECT strftime(InvoiceDate, '%Y-%m') FROM enriched GROUP BY 1))
UNION ALL
SELECT 'continent_sales', 'Continent,TotalAmount',
       (SELECT count(*) FROM (SELECT m.Continent FROM enriched e LEFT JOIN mapping m ON e.Country = m.Country GROUP BY 1))
UNION ALL
SELECT CASE rank WHEN 1 THEN 'supplier_sales' WHEN 2 THEN 'supplier_sales_uk_2011' ELSE 'legacy_supplier_extra' END, 'SupplierID,TotalAmount', n
FROM (SELECT n, row_number() OVER (ORDER BY n DESC) AS rank FROM (
  SELECT count(*) AS n FROM (SELECT b.SupplierID FROM enriched e LEFT JOIN bridge b ON e.InvoiceNo = b.InvoiceNo GROUP BY 1)
  UNION ALL SELECT count(*) FROM (SELECT b.SupplierID FROM enriched e JOIN bridge b ON e.InvoiceNo = b.InvoiceNo GROUP BY 1)
  UNION ALL SELECT count(*) FROM (SELECT b.SupplierID FROM {market} e LEFT JOIN bridge b ON e.InvoiceNo = b.InvoiceNo GROUP BY 1)))
UNION ALL
SELECT 'legacy_empty', 'InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country', 0
UNION ALL
SELECT 'unknown_schema', 'country,continent', (SELECT count(*) FROM mapping)"""
    return q
