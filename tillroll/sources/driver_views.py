"""Retail-shaped views over the driver's TPC-H-style tables.

The driver ships ``lineitem orders part customer nation region events`` (and
more) as Parquet. These views give them the shape the reference works on:

* ``retail``        invoice lines (8 typed columns); returned lines become
                    cancelled invoices (``C`` + order number)
* ``dirty``         the same lines as raw text with the faults a real export
                    has (mixed date patterns, decimal commas, padding, blanks,
                    nulls, a lower-case cancel prefix, zero prices, repeats)
* ``bridge``        invoice -> supplier, listing only invoices with shipped
                    lines, so some invoices have no supplier
* ``bridge_fanout`` one row per line: several suppliers per invoice and
                    repeated pairs (fan-out)
* ``mapping``       country -> continent with lower-case headers; countries of
                    one region are missing, so a null continent exists

``bridge`` lists one supplier per invoice, ``bridge_fanout`` one row per line.

Every view is a lazy plan over the whole tables. Dimension joins are left to
the planner: Spark broadcasts a side only when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and adaptive execution re-checks the
real size at run time; large sides are sort-merge joined.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import compiled_only

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# Declared schemas of the driver's tables: reading with them skips footer
# inference on the driver and fails loudly if a file changes type.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = compiled_only(spark).read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _lines(spark: SparkSession, sf_dir: str, line_cols: list[str]) -> DataFrame:
    """lineitem joined to its order, part, customer and nation.

    Join order keeps the wide fact table to two shuffles: the customer's
    country is attached to orders first (orders-sized shuffle), then lines
    meet orders on the order key and part on the part key.
    """
    li = table(spark, sf_dir, "lineitem").select(*line_cols)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    cust_country = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name")
    order_country = orders.join(cust_country, orders.o_custkey == cust_country.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderdate", "n_name"
    )
    return li.join(order_country, li.l_orderkey == order_country.o_orderkey).join(
        part, li.l_partkey == part.p_partkey
    )


def _invoice_no(orderkey: Column, returnflag: Column) -> Column:
    key = orderkey.cast("string")
    return F.when(returnflag == "R", F.concat(F.lit("C"), key)).otherwise(key)


def retail(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir, ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag"])
    return lines.select(
        _invoice_no(F.col("l_orderkey"), F.col("l_returnflag")).alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.col("p_retailprice").alias("UnitPrice"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


def _text(c: Column) -> Column:
    return c.cast("string")


def _two(c: Column) -> Column:
    return F.lpad(c.cast("string"), 2, "0")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-text lines with faults chosen by line number, tax and discount."""
    lines = _lines(
        spark,
        sf_dir,
        ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"],
    )
    ln = F.col("l_linenumber")
    tx = F.round(F.col("l_tax") * 100).cast("int")
    dc = F.round(F.col("l_discount") * 100).cast("int")
    qty = F.col("l_quantity").cast("int")
    d = F.col("o_orderdate")
    hh, mm = ln + 8, tx * 5
    y, m, day = _text(F.year(d)), _text(F.month(d)), _text(F.dayofmonth(d))

    key = _text(F.col("l_orderkey"))
    prefix = F.when(F.col("l_linestatus") == "O", F.lit("c")).otherwise(F.lit("C"))
    invoice = F.when(F.col("l_returnflag") == "R", F.concat(prefix, key)).otherwise(key)
    invoice = F.when(ln == 3, F.concat(F.lit(" "), invoice, F.lit(" "))).otherwise(invoice)

    desc = (
        F.when((ln == 7) & (tx == 0), F.lit(None).cast("string"))
        .when((ln == 7) & (tx == 1), F.lit(""))
        .when(ln == 2, F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
        .otherwise(F.col("p_name"))
    )
    quantity = (
        F.when(dc == 10, _text(qty * 1000))
        .when(ln == 4, F.concat(_text(qty), F.lit(",0")))
        .when(ln == 5, F.concat(_text(qty), F.lit(".0")))
        .when((ln == 1) & (tx == 8), F.lit(None).cast("string"))
        .otherwise(_text(qty))
    )
    price_text = F.format_string("%.2f", F.col("p_retailprice"))
    price = (
        F.when(dc == 0, F.lit("0"))
        .when(ln == 5, F.regexp_replace(price_text, r"\.", ","))
        .otherwise(price_text)
    )
    time_hm = F.concat(_text(hh), F.lit(":"), _two(mm))
    date = (
        F.when(ln == 2, F.concat(_two(F.month(d)), F.lit("/"), _two(F.dayofmonth(d)), F.lit("/"), y, F.lit(" "), _two(hh), F.lit(":"), _two(mm)))
        .when(ln == 3, F.concat(m, F.lit("/"), day, F.lit("/"), y, F.lit(" "), time_hm, F.lit(":00")))
        .when(ln == 4, F.concat(y, F.lit("-"), _two(F.month(d)), F.lit("-"), _two(F.dayofmonth(d)), F.lit(" "), _two(hh), F.lit(":"), _two(mm), F.lit(":00")))
        .when(ln == 5, F.concat(day, F.lit("/"), m, F.lit("/"), y, F.lit(" "), time_hm))
        .when(ln == 6, F.lit("not a date"))
        .otherwise(F.concat(m, F.lit("/"), day, F.lit("/"), y, F.lit(" "), time_hm))
    )
    cust = _text(F.col("o_custkey"))
    customer = (
        F.when(tx == 1, F.lit(None).cast("string"))
        .when(ln == 2, F.concat(cust, F.lit(".0")))
        .otherwise(cust)
    )
    country = (
        F.when(ln == 3, F.concat(F.lit(" "), F.col("n_name"), F.lit("  ")))
        .when((ln == 4) & (tx == 2), F.concat(F.lit("\t"), F.col("n_name")))
        .when((ln == 1) & (dc == 5), F.lit(""))
        .otherwise(F.col("n_name"))
    )
    rows = lines.select(
        invoice.alias("InvoiceNo"),
        _text(F.col("l_partkey")).alias("StockCode"),
        desc.alias("Description"),
        quantity.alias("Quantity"),
        date.alias("InvoiceDate"),
        price.alias("UnitPrice"),
        customer.alias("CustomerID"),
        country.alias("Country"),
        # Some lines are exported twice: a generator, so the plan is one pass.
        F.explode(F.when((ln == 1) & (dc <= 2), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy"),
    )
    return rows.drop("_copy")


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice -> main supplier (smallest supplier key among shipped lines)."""
    li = table(spark, sf_dir, "lineitem")
    return (
        li.filter(F.col("l_linestatus") == "F")
        .groupBy("l_orderkey")
        .agg(F.min("l_suppkey").alias("s"))
        .select(_text(F.col("l_orderkey")).alias("InvoiceNo"), _text(F.col("s")).alias("Fournisseur"))
    )


def bridge_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bridge row per line: many suppliers per invoice, repeated pairs."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(_text(F.col("l_orderkey")).alias("InvoiceNo"), _text(F.col("l_suppkey")).alias("Fournisseur"))


def mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """country -> continent (lower-case headers, as a crawler reports them)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return (
        nation.join(region, nation.n_regionkey == region.r_regionkey)
        .filter(F.col("r_name") != "MIDDLE EAST")
        .select(F.col("n_name").alias("country"), F.col("r_name").alias("continent"))
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")
