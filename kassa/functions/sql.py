"""The load as SQL: functions and table functions for a session.

``register`` declares temporary SQL functions over the column expressions of
the load (typing, fills, derived columns, lookups, the summary), so that a user
works from SQL text alone over catalog tables or views. They are SQL functions:
the optimizer inlines their bodies, and no Python runs per row.

Scalar: ``kassa_long``, ``kassa_double``, ``kassa_timestamp``, ``kassa_money``,
``kassa_final_price``, ``kassa_stockcode``, ``kassa_change``. Table functions
read the views or tables named ``staging``, ``currency``, ``conversion`` and
``discount`` of the session: ``kassa_clean()``, ``kassa_curated()``,
``kassa_monthly()``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SCALAR = {
    # text -> long: sign and digits, a fraction is dropped, else NULL
    "kassa_long(x STRING) RETURNS BIGINT": """coalesce(try_cast(trim(x) AS BIGINT),
        CASE WHEN trim(x) RLIKE '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]*)$'
             THEN try_cast(regexp_replace(regexp_replace(trim(x), '[.].*$', ''), '^([+-]?)$', '$10') AS BIGINT) END)""",
    "kassa_double(x STRING) RETURNS DOUBLE": "try_cast(trim(x) AS DOUBLE)",
    "kassa_timestamp(x STRING) RETURNS TIMESTAMP": "try_cast(trim(x) AS TIMESTAMP)",
    "kassa_money(x STRING) RETURNS DECIMAL(12,2)": "try_cast(trim(replace(x, '$', '')) AS DECIMAL(12,2))",
    "kassa_final_price(sale DECIMAL(12,2), discount DECIMAL(7,4), rate DECIMAL(10,4)) RETURNS DECIMAL(38,2)":
        "CAST(round((sale - sale * discount) * rate, 2) AS DECIMAL(38,2))",
    "kassa_stockcode(x STRING) RETURNS STRING": "lpad(x, 10, '0')",
    "kassa_change(now DOUBLE, before DOUBLE) RETURNS DOUBLE": "round(try_divide(now - before, before) * 100, 2)",
}

# The staging columns that stay texts, by their clean names.
TEXTS = {"StoreNo": "storeno", "StorePos": "storepos", "StoreCountry": "storecountry", "LineItem_StockCode": "lineitem_stockcode",
         "Discount_DiscountCode": "discountcode", "Region": "region"}
CLEAN = "invoiceno BIGINT, invoicets TIMESTAMP, lineitem_quantity DOUBLE, lineitem_saleprice DECIMAL(12,2), customer_customerid BIGINT, " + ", ".join(
    f"{c} STRING" for c in TEXTS.values())
P = "RetailTxnData_"

TABLE = {
    "kassa_clean()": (
        CLEAN + ", invoice_year INT, invoice_month INT, standard_stockcode STRING",
        f"""WITH typed AS (
          SELECT kassa_long({P}InvoiceNo) AS invoiceno, kassa_timestamp({P}InvoiceDateTime) AS invoicets,
                 kassa_double({P}LineItem_Quantity) AS lineitem_quantity, kassa_money({P}LineItem_SalePrice) AS lineitem_saleprice,
                 kassa_long({P}Customer_CustomerID) AS customer_customerid,
                 {', '.join(f'trim({P}{c}) AS {name}' for c, name in TEXTS.items())}
          FROM staging)
        SELECT coalesce(invoiceno, -1), coalesce(invoicets, TIMESTAMP '1900-01-01 00:00:00'), coalesce(lineitem_quantity, double('NaN')),
               lineitem_saleprice, coalesce(customer_customerid, -1), {', '.join(f"coalesce({c}, 'NaN')" for c in TEXTS.values())},
               year(invoicets), month(invoicets), kassa_stockcode(coalesce(lineitem_stockcode, 'NaN')) FROM typed"""),
    "kassa_curated()": (
        CLEAN + ", invoice_year INT, invoice_month INT, standard_stockcode STRING, currency_code STRING, lineitem_finalsaleprice DECIMAL(38,2)",
        """SELECT a.*, coalesce(b.currency_cd, 'USD'),
               kassa_final_price(a.lineitem_saleprice, CAST(coalesce(CAST(d.discount_per AS DECIMAL(7,4)), 5) / 100 AS DECIMAL(7,4)),
                                 coalesce(CAST(c.conversion_rate AS DECIMAL(10,4)), 1))
        FROM kassa_clean() a
        LEFT JOIN currency b ON lower(a.storecountry) = lower(trim(b.country))
        LEFT JOIN conversion c ON lower(trim(b.currency_cd)) = lower(trim(c.source_currency))
        LEFT JOIN discount d ON lower(a.discountcode) = lower(trim(d.discount_cd))"""),
    "kassa_monthly()": (
        "region STRING, storeno STRING, invoice_year INT, invoice_month INT, num_invoices BIGINT, stock_count BIGINT, "
        "total_quantity DOUBLE, total_sales DOUBLE",
        """SELECT region, storeno, invoice_year, invoice_month, count(DISTINCT invoiceno), count(DISTINCT lineitem_stockcode),
               sum(lineitem_quantity), CAST(sum(lineitem_finalsaleprice) AS DOUBLE)
        FROM kassa_curated() GROUP BY region, storeno, invoice_year, invoice_month"""),
}


def register(spark: SparkSession, tables: bool = True) -> None:
    """``tables``: the table functions too; the tables they read must be there."""
    for head, body in SCALAR.items():
        name, returns = head.split(" RETURNS ")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} RETURNS {returns} RETURN {body}")
    for name, (columns, body) in TABLE.items() if tables else ():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} RETURNS TABLE ({columns}) RETURN {body}")
