"""Declared schemas. Sources are read with these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the retail table, fixed by the reference's dataset signatures.
RETAIL_COLUMNS = (
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
)

RETAIL = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampNTZType()),
        T.StructField("UnitPrice", T.DoubleType()),
        T.StructField("CustomerID", T.LongType()),
        T.StructField("Country", T.StringType()),
    ]
)

# Raw text form: what a CSV or a crawler without type hints hands over.
RETAIL_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in RETAIL_COLUMNS])

ENRICHED = T.StructType(RETAIL.fields + [T.StructField("TotalAmount", T.DoubleType())])

SUPPLIER = T.StructType(
    [T.StructField("InvoiceNo", T.StringType()), T.StructField("Fournisseur", T.StringType())]
)

MAPPING = T.StructType(
    [T.StructField("Country", T.StringType()), T.StructField("Continent", T.StringType())]
)

AUDIT = T.StructType(
    [T.StructField("step", T.StringType()), T.StructField("row_count", T.LongType())]
)

COUNTRY_SALES = T.StructType(
    [
        T.StructField("Country", T.StringType()),
        T.StructField("TotalAmount", T.DoubleType()),
        T.StructField("TransactionCount", T.LongType(), False),
    ]
)

MONTHLY_SALES = T.StructType(
    [
        T.StructField("InvoiceMonth", T.StringType()),
        T.StructField("TotalSales", T.DoubleType()),
        T.StructField("TransactionCount", T.LongType()),
    ]
)

CONTINENT_SALES = T.StructType(
    [T.StructField("Continent", T.StringType()), T.StructField("TotalAmount", T.DoubleType())]
)

CANCELLATIONS = T.StructType(
    [T.StructField("Continent", T.StringType()), T.StructField("CancelledOperations", T.LongType())]
)

SUPPLIER_SALES = T.StructType(
    [T.StructField("SupplierID", T.StringType()), T.StructField("TotalAmount", T.DoubleType())]
)

# The name of each result dataset, by its ordered columns.
DATASET_SIGNATURES = {
    RETAIL_COLUMNS: "cleaned",
    tuple(ENRICHED.names): "enriched",
    tuple(COUNTRY_SALES.names): "country_sales",
    tuple(MONTHLY_SALES.names): "monthly_sales",
    tuple(CONTINENT_SALES.names): "continent_sales",
    tuple(CANCELLATIONS.names): "cancellations_by_continent",
    tuple(SUPPLIER_SALES.names): "supplier_sales_family",
}
