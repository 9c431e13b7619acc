"""Typing, null fills and derived columns of the staged transactions.

``type_conversion`` turns the 23 all-string staging columns into the 26 typed
clean columns, ``fill_nulls`` applies the placeholder policy and
``derive_columns`` adds the four helper columns. ``null_handling`` is the two
together, as the load job runs them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


from kassa.functions import casts, derive

# Clean column <- staging column, with the target kind, in the
# order of the clean table.
CLEAN_SPEC = [
    ("invoiceno", "RetailTxnData_InvoiceNo", "long"),
    ("invoicets", "RetailTxnData_InvoiceDateTime", "timestamp"),
    ("invoicedate", None, "date"),
    ("invoice_year", None, "year"),
    ("invoice_month", None, "month"),
    ("storeno", "RetailTxnData_StoreNo", "string"),
    ("storepos", "RetailTxnData_StorePos", "string"),
    ("storecountry", "RetailTxnData_StoreCountry", "string"),
    ("lineitem_stockcode", "RetailTxnData_LineItem_StockCode", "string"),
    ("lineitem_description", "RetailTxnData_LineItem_Description", "string"),
    ("lineitem_quantity", "RetailTxnData_LineItem_Quantity", "double"),
    ("lineitem_unitprice", "RetailTxnData_LineItem_UnitPrice", "money"),
    ("lineitem_saleprice", "RetailTxnData_LineItem_SalePrice", "money"),
    ("customer_customerid", "RetailTxnData_Customer_CustomerID", "long"),
    ("customer_emailid", "RetailTxnData_Customer_EmailId", "string"),
    ("customer_contactno", "RetailTxnData_Customer_ContactNo", "string"),
    ("customer_firstname", "RetailTxnData_Customer_FirstName", "string"),
    ("customer_middlename", "RetailTxnData_Customer_MiddleName", "string"),
    ("customer_lastname", "RetailTxnData_Customer_LastName", "string"),
    ("customer_address", "RetailTxnData_Customer_Address", "string"),
    ("customer_state", "RetailTxnData_Customer_State", "string"),
    ("customer_country", "RetailTxnData_Customer_Country", "string"),
    ("customer_zipcode", "RetailTxnData_Customer_ZipCode", "string"),
    ("discountcode", "RetailTxnData_Discount_DiscountCode", "string"),
    ("region", "RetailTxnData_Region", "string"),
    ("sourcets", "RetailTxnData_SourceTimestamp", "timestamp"),
]

CLEAN_COLUMNS = [name for name, _, _ in CLEAN_SPEC]
DERIVED_COLUMNS = ["processing_delay", "customer_status", "local_stockcode", "standard_stockcode"]

# Placeholder policy (fixed values of the load job).
LONG_FILL = {"invoiceno": -1, "customer_customerid": -1}
FLOAT_FILL_COLUMNS = ["lineitem_quantity", "lineitem_unitprice", "lineitem_saleprice"]
TIMESTAMP_FILL = "1900-01-01 00:00:00"
TIMESTAMP_FILL_COLUMNS = ["invoicets", "sourcets"]
STRING_FILL = "NaN"


def _typed(kind: str, src: str, money: str) -> Column:
    if kind == "long":
        return casts.lenient_long(src)
    if kind == "double":
        return casts.lenient_double(src)
    if kind == "money":
        return casts.money(src, money)
    if kind == "timestamp":
        return casts.lenient_timestamp(src)
    return F.trim(F.col(src))


def type_conversion(df: DataFrame, money: str = "float") -> DataFrame:
    """23 staged strings -> 26 typed, renamed columns; every value trimmed.

    The invoice time is parsed once; date, year and month derive from it.
    Unparseable values become NULL in both ANSI modes.
    """
    typed = df.select(*[
        _typed(kind, src, money).alias(name)
        for name, src, kind in CLEAN_SPEC if src is not None
    ])
    ts = F.col("invoicets")
    return typed.select(
        "invoiceno", "invoicets",
        F.to_date(ts).alias("invoicedate"),
        F.year(ts).alias("invoice_year"),
        F.month(ts).alias("invoice_month"),
        *CLEAN_COLUMNS[5:],
    )


def fill_nulls(df: DataFrame, fill_numeric: bool = True) -> DataFrame:
    """Placeholder fills of the load job, in its order.

    Strings -> 'NaN' (only string columns; date and int stay NULL), the two
    ids -> -1, quantity and prices -> NaN, the two timestamps -> 1900-01-01.
    Decimal prices (exact money mode) have no NaN and stay NULL.
    ``fill_numeric=False`` leaves numeric NULLs alone so sums skip them.
    """
    types = dict(df.dtypes)
    out = []
    for name in df.columns:
        c = F.col(name)
        dt = types[name]
        if dt == "string":
            c = F.coalesce(c, F.lit(STRING_FILL))
        elif fill_numeric and name in LONG_FILL:
            c = F.coalesce(c, F.lit(LONG_FILL[name]).cast(dt))
        elif fill_numeric and name in FLOAT_FILL_COLUMNS and dt in ("float", "double"):
            c = F.coalesce(c, F.lit(float("nan")).cast(dt))
        elif name in TIMESTAMP_FILL_COLUMNS and dt.startswith("timestamp"):
            c = F.coalesce(c, F.lit(TIMESTAMP_FILL).cast(dt))
        else:
            out.append(c)
            continue
        out.append(c.alias(name))
    return df.select(*out)


def derive_columns(df: DataFrame, as_of: Column | str | None = None,
                   unknown_id: int | None = None) -> DataFrame:
    """Add ``processing_delay``, ``customer_status``, ``local_stockcode`` and
    ``standard_stockcode``."""
    return df.withColumns({
        "processing_delay": derive.processing_delay("sourcets", as_of),
        "customer_status": derive.customer_status("customer_customerid", unknown_id),
        "local_stockcode": derive.local_stockcode("lineitem_stockcode"),
        "standard_stockcode": derive.standard_stockcode("lineitem_stockcode"),
    })


def null_handling(df: DataFrame, as_of: Column | str | None = None,
                  fill_numeric: bool = True, unknown_id: int | None = None) -> DataFrame:
    """Fills followed by the derived columns (the load job's null step)."""
    return derive_columns(fill_nulls(df, fill_numeric), as_of, unknown_id)


__all__ = ["type_conversion", "fill_nulls", "derive_columns", "null_handling",
           "CLEAN_SPEC", "CLEAN_COLUMNS", "DERIVED_COLUMNS"]

