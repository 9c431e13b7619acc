"""Schemas of the data model: nested transaction, staging, clean, dimensions."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The 23 staging column names, in table order. They must equal
# the staging table definition for the flattened records to land in it.
# ---------------------------------------------------------------------------
STAGING_COLUMNS = [
    "RetailTxnData_InvoiceNo",
    "RetailTxnData_InvoiceDateTime",
    "RetailTxnData_StoreNo",
    "RetailTxnData_StorePos",
    "RetailTxnData_Region",
    "RetailTxnData_StoreCountry",
    "RetailTxnData_LineItem_StockCode",
    "RetailTxnData_LineItem_Description",
    "RetailTxnData_LineItem_Quantity",
    "RetailTxnData_LineItem_UnitPrice",
    "RetailTxnData_LineItem_SalePrice",
    "RetailTxnData_Customer_CustomerID",
    "RetailTxnData_Customer_EmailId",
    "RetailTxnData_Customer_ContactNo",
    "RetailTxnData_Customer_FirstName",
    "RetailTxnData_Customer_MiddleName",
    "RetailTxnData_Customer_LastName",
    "RetailTxnData_Customer_Address",
    "RetailTxnData_Customer_State",
    "RetailTxnData_Customer_Country",
    "RetailTxnData_Customer_ZipCode",
    "RetailTxnData_Discount_DiscountCode",
    "RetailTxnData_SourceTimestamp",
]

STAGING_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in STAGING_COLUMNS])

_S = T.StringType()

LINE_ITEM = T.StructType([
    T.StructField("StockCode", _S), T.StructField("Description", _S),
    T.StructField("Quantity", _S), T.StructField("UnitPrice", _S),
    T.StructField("SalePrice", _S),
])
CUSTOMER = T.StructType([
    T.StructField(n, _S) for n in (
        "CustomerID", "EmailId", "ContactNo", "FirstName", "MiddleName",
        "LastName", "Address", "State", "Country", "ZipCode")
])
DISCOUNT = T.StructType([T.StructField("DiscountCode", _S)])


def transaction_schema(line_items_as_array: bool = False, line_items: T.DataType | None = None) -> T.StructType:
    """Schema of one raw transaction document ``{"RetailTxnData": {...}}``.

    Leaves are read as strings: the staging table is all-string and the
    typing happens once, in ``type_conversion``.
    """
    li = line_items or (T.ArrayType(LINE_ITEM) if line_items_as_array else LINE_ITEM)
    txn = T.StructType([
        T.StructField("InvoiceNo", _S), T.StructField("InvoiceDateTime", _S),
        T.StructField("StoreNo", _S), T.StructField("StorePos", _S),
        T.StructField("Region", _S), T.StructField("StoreCountry", _S),
        T.StructField("LineItem", li), T.StructField("Customer", CUSTOMER),
        T.StructField("Discount", DISCOUNT), T.StructField("SourceTimestamp", _S),
    ])
    return T.StructType([T.StructField("RetailTxnData", txn)])


# Without these a record has no place in the archive and is no transaction.
REQUIRED_FIELDS = ["RetailTxnData.InvoiceNo", "RetailTxnData.StoreNo", "RetailTxnData.InvoiceDateTime", "RetailTxnData.Region"]

# Stream envelope: base64 payload plus an optional record id.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("recordId", _S), T.StructField("data", _S),
])

CURRENCY_SCHEMA = T.StructType([
    T.StructField("country", _S), T.StructField("currency_cd", _S)])
CONVERSION_SCHEMA = T.StructType([
    T.StructField("source_currency", _S), T.StructField("conversion_rate", T.DoubleType())])
DISCOUNT_DIM_SCHEMA = T.StructType([
    T.StructField("discount_cd", _S), T.StructField("discount_per", T.DoubleType())])

# Keys of the reference jobs (batch job first, notebook second).
DEDUP_KEYS = ["region", "storepos", "storeno", "invoicets", "invoiceno"]
DEDUP_KEYS_DAILY = ["region", "storepos", "storeno", "invoicedate", "invoiceno"]
MERGE_KEYS = ["invoiceno", "storeno", "lineitem_stockcode", "invoicedate", "region"]
MERGE_KEYS_NOTEBOOK = ["invoiceno", "storeno", "lineitem_stockcode", "invoicedate", "storecountry"]
PARTITION_COLS = ["region", "invoice_year"]
PARTITION_COLS_NOTEBOOK = ["region", "invoicedate"]
MONTHLY_KEYS = ["region", "storeno", "invoice_year", "invoice_month"]
