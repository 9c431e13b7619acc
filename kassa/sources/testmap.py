"""Staging data derived from the driver's star-schema tables.

The reference's input is a 23-column all-string staging table of retail
transactions. The test tables are a TPC-H-like star schema, so this module
maps them onto the staging layout with Spark joins (every row of
``lineitem`` becomes one staged transaction line) and derives the three
small dimension tables from ``nation``.

Mapping (one line item = one transaction line):
  InvoiceNo <- l_orderkey, InvoiceDateTime <- o_orderdate text + ' 00:00:00',
  StoreNo / StorePos <- l_suppkey / l_linenumber,
  Region / StoreCountry <- supplier's region name + ' ' / nation name,
  StockCode <- l_partkey padded to 6, Description <- p_name,
  Quantity <- l_quantity as integer text, UnitPrice / SalePrice <- '$' +
  p_retailprice / l_extendedprice with two decimals, CustomerID <- o_custkey,
  FirstName <- c_name, other customer fields NULL, DiscountCode <- 'DISC' +
  two-digit discount percent, SourceTimestamp <- l_shipdate text + ' 00:00:00'.

Join plan: orders meets customer first (a quarter of lineitem's rows), then
lineitem meets that on the order key; part, supplier and the geography
follow as lookups on the fact side. Nothing is
hinted: Spark broadcasts a side only when its size estimate is under the
broadcast threshold (AQE re-checks with run-time sizes), else it shuffles.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from kassa.schemas import STAGING_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _date_text(c: str):
    return F.concat(F.col(c).cast("date").cast("string"), F.lit(" 00:00:00"))


def _money_text(c: str):
    return F.concat(F.lit("$"), F.col(c).cast("decimal(12,2)").cast("string"))


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation key -> nation name, region name (25 rows)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left") \
        .select("n_nationkey", "n_name", "r_name")


def star_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with the order, customer, part and supplier fields the
    staging layout needs (left joins: every line item is kept)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    geo = geography(spark, sf_dir)
    oc = o.join(c, o.o_custkey == c.c_custkey, "left")
    # Supplier and geography are joined onto the fact side one by one: the
    # planner's size estimate of a join is the product of its inputs, so a
    # pre-joined supplier-geography frame would look too big to broadcast
    # and force a shuffle of the widest table.
    return (li.join(oc, li.l_orderkey == oc.o_orderkey, "left")
            .join(p, li.l_partkey == p.p_partkey, "left")
            .join(s, li.l_suppkey == s.s_suppkey, "left")
            .join(geo, F.col("s_nationkey") == geo.n_nationkey, "left"))


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 23-column all-string staging table."""
    x = star_lines(spark, sf_dir)
    none = F.lit(None).cast("string")
    cols = {
        "RetailTxnData_InvoiceNo": F.col("l_orderkey").cast("string"),
        "RetailTxnData_InvoiceDateTime": _date_text("o_orderdate"),
        "RetailTxnData_StoreNo": F.col("l_suppkey").cast("string"),
        "RetailTxnData_StorePos": F.col("l_linenumber").cast("string"),
        "RetailTxnData_Region": F.concat(F.col("r_name"), F.lit(" ")),
        "RetailTxnData_StoreCountry": F.col("n_name"),
        "RetailTxnData_LineItem_StockCode": F.lpad(F.col("l_partkey").cast("string"), 6, "0"),
        "RetailTxnData_LineItem_Description": F.col("p_name"),
        "RetailTxnData_LineItem_Quantity": F.col("l_quantity").cast("int").cast("string"),
        "RetailTxnData_LineItem_UnitPrice": _money_text("p_retailprice"),
        "RetailTxnData_LineItem_SalePrice": _money_text("l_extendedprice"),
        "RetailTxnData_Customer_CustomerID": F.col("o_custkey").cast("string"),
        "RetailTxnData_Customer_EmailId": none,
        "RetailTxnData_Customer_ContactNo": none,
        "RetailTxnData_Customer_FirstName": F.col("c_name"),
        "RetailTxnData_Customer_MiddleName": none,
        "RetailTxnData_Customer_LastName": none,
        "RetailTxnData_Customer_Address": none,
        "RetailTxnData_Customer_State": none,
        "RetailTxnData_Customer_Country": none,
        "RetailTxnData_Customer_ZipCode": none,
        "RetailTxnData_Discount_DiscountCode": F.concat(
            F.lit("DISC"), F.lpad(F.round(F.col("l_discount") * 100).cast("int").cast("string"), 2, "0")),
        "RetailTxnData_SourceTimestamp": _date_text("l_shipdate"),
    }
    return x.select(*[cols[c].alias(c) for c in STAGING_COLUMNS])


# Fixed values of the test dimensions: a few rates and discounts with blanks
# and mixed case around the keys, and codes that deliberately miss.
CONVERSION_ROWS = [("cur0 ", 1.0), ("cur1", 0.5), ("cur2", 1.25), ("cur3", 83.1)]
DISCOUNT_ROWS = [("disc00", 0.0), ("disc05 ", 10.0), ("disc10", 15.0)]


def currency_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """country ' <nation name lower case>' -> 'CUR<key mod 5>', for nations
    whose key is not a multiple of 4 (the others miss, default USD)."""
    n = table(spark, sf_dir, "nation")
    return n.filter(F.col("n_nationkey") % 4 != 0).select(
        F.concat(F.lit(" "), F.lower("n_name")).alias("country"),
        F.concat(F.lit("CUR"), (F.col("n_nationkey") % 5).cast("string")).alias("currency_cd"))


def conversion_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(CONVERSION_ROWS, "source_currency string, conversion_rate double")


def discount_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DISCOUNT_ROWS, "discount_cd string, discount_per double")


def dims(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return currency_dim(spark, sf_dir), conversion_dim(spark), discount_dim(spark)


# ---------------------------------------------------------------------------
# Nested documents and stream envelopes built from the staged rows.
# ---------------------------------------------------------------------------

def record_id(staged: DataFrame):
    return F.concat_ws("-", "RetailTxnData_InvoiceNo", "RetailTxnData_StorePos",
                       "RetailTxnData_LineItem_StockCode", "RetailTxnData_StoreNo")


def nested_documents(staged: DataFrame) -> DataFrame:
    """One raw transaction document per staged row: ``RetailTxnData`` struct
    with ``LineItem``, ``Customer`` and ``Discount`` sub-structs."""
    from kassa.operators.nested import nest_staging
    return nest_staging(staged)


def _item(prefix: str = "RetailTxnData_LineItem_", unit: bool = False):
    def f(n):
        return F.col(prefix + n)
    if not unit:
        return F.struct(*[f(n).alias(n) for n in
                          ("StockCode", "Description", "Quantity", "UnitPrice", "SalePrice")])
    # The same article bought once: quantity 1, sale price = unit price.
    return F.struct(f("StockCode").alias("StockCode"), f("Description").alias("Description"),
                    F.lit("1").alias("Quantity"), f("UnitPrice").alias("UnitPrice"),
                    f("UnitPrice").alias("SalePrice"))


def documents_with_item_arrays(staged: DataFrame) -> DataFrame:
    """Documents whose ``LineItem`` is an array. Its length follows the line
    position: position 1 has no array, 2 an empty one, 3-4 the line itself,
    5 and later the line plus a single-unit line of the same article."""
    pos = F.col("RetailTxnData_StorePos").cast("int")
    items = (F.when(pos <= 1, F.lit(None))
             .when(pos == 2, F.array().cast("array<struct<StockCode:string,Description:string,"
                                            "Quantity:string,UnitPrice:string,SalePrice:string>>"))
             .when(pos <= 4, F.array(_item()))
             .otherwise(F.array(_item(), _item(unit=True))))
    t = "RetailTxnData_"
    cust = [c for c in staged.columns if c.startswith(t + "Customer_")]
    doc = F.struct(
        *[F.col(t + n).alias(n) for n in ("InvoiceNo", "InvoiceDateTime", "StoreNo",
                                          "StorePos", "Region", "StoreCountry")],
        items.alias("LineItem"),
        F.struct(*[F.col(c).alias(c[len(t + "Customer_"):]) for c in cust]).alias("Customer"),
        F.struct(F.col(t + "Discount_DiscountCode").alias("DiscountCode")).alias("Discount"),
        F.col(t + "SourceTimestamp").alias("SourceTimestamp"))
    return staged.select(doc.alias("RetailTxnData"))


def envelopes(staged: DataFrame) -> DataFrame:
    """Stream records: ``recordId``, the ``arrival`` time (the source
    timestamp text) and ``data``, the base64 of the JSON document."""
    from kassa.operators.nested import base64_text, nest_staging
    docs = nest_staging(staged.select(record_id(staged).alias("recordId"),
                                      F.col("RetailTxnData_SourceTimestamp").alias("arrival"),
                                      *staged.columns))
    text = F.to_json(F.struct("RetailTxnData"))
    return docs.select("recordId", "arrival", base64_text(text).alias("data"))
