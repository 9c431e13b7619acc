"""DuckDB twins of the registered queries (the correctness oracle).

Written independently in SQL over the same parquet tables: the staging
mapping, the typing, fills, duplicate marks, lookups, aggregates, merge and
payload texts are re-stated here as plain SQL, so a mistake in a Spark
operator shows up as a mismatch. Cross-engine traps and how they are met:
Spark truncates '12.9' to a long where DuckDB rounds (so the long parse is a
regex here); DuckDB year()/month() are bigint (cast to int); NULL order
differs (always spelled out); dates/timestamps are compared as text, exact
money as double.
"""

from __future__ import annotations

from kassa.schemas import STAGING_COLUMNS

AS_OF = "2025-01-01 00:00:00"
P = "RetailTxnData_"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


STAGED = f"""
geo AS (SELECT n.n_nationkey, n.n_name, r.r_name
        FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
staged AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) AS {P}InvoiceNo,
         CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR) || ' 00:00:00' AS {P}InvoiceDateTime,
         CAST(l.l_suppkey AS VARCHAR) AS {P}StoreNo,
         CAST(l.l_linenumber AS VARCHAR) AS {P}StorePos,
         g.r_name || ' ' AS {P}Region,
         g.n_name AS {P}StoreCountry,
         lpad(CAST(l.l_partkey AS VARCHAR), 6, '0') AS {P}LineItem_StockCode,
         p.p_name AS {P}LineItem_Description,
         CAST(CAST(trunc(l.l_quantity) AS INTEGER) AS VARCHAR) AS {P}LineItem_Quantity,
         '$' || CAST(CAST(p.p_retailprice AS DECIMAL(12,2)) AS VARCHAR) AS {P}LineItem_UnitPrice,
         '$' || CAST(CAST(l.l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS {P}LineItem_SalePrice,
         CAST(o.o_custkey AS VARCHAR) AS {P}Customer_CustomerID,
         CAST(NULL AS VARCHAR) AS {P}Customer_EmailId,
         CAST(NULL AS VARCHAR) AS {P}Customer_ContactNo,
         c.c_name AS {P}Customer_FirstName,
         CAST(NULL AS VARCHAR) AS {P}Customer_MiddleName,
         CAST(NULL AS VARCHAR) AS {P}Customer_LastName,
         CAST(NULL AS VARCHAR) AS {P}Customer_Address,
         CAST(NULL AS VARCHAR) AS {P}Customer_State,
         CAST(NULL AS VARCHAR) AS {P}Customer_Country,
         CAST(NULL AS VARCHAR) AS {P}Customer_ZipCode,
         'DISC' || lpad(CAST(CAST(round(l.l_discount * 100) AS INTEGER) AS VARCHAR), 2, '0')
             AS {P}Discount_DiscountCode,
         CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) || ' 00:00:00' AS {P}SourceTimestamp
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN geo g ON s.s_nationkey = g.n_nationkey)"""


def long_of(x: str) -> str:
    """Non-ANSI text -> bigint: sign and integer digits, fraction dropped."""
    t = f"trim({x})"
    return (f"(CASE WHEN regexp_full_match({t}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]*)') "
            f"THEN TRY_CAST(regexp_extract({t}, '^([+-]?)', 1) || "
            f"CASE WHEN regexp_extract({t}, '^[+-]?([0-9]*)', 1) = '' THEN '0' "
            f"ELSE regexp_extract({t}, '^[+-]?([0-9]*)', 1) END AS BIGINT) END)")


def money_of(x: str, mode: str) -> str:
    t = "FLOAT" if mode == "float" else "DECIMAL(12,2)"
    return f"TRY_CAST(trim(replace({x}, '$', '')) AS {t})"


def clean_cte(money: str = "float", name: str = "clean") -> str:
    s = lambda c: f"trim({P}{c})"
    return f"""
{name}_ts AS (
  SELECT {long_of(P + 'InvoiceNo')} AS invoiceno,
         TRY_CAST(trim({P}InvoiceDateTime) AS TIMESTAMP) AS invoicets,
         {s('StoreNo')} AS storeno, {s('StorePos')} AS storepos,
         {s('StoreCountry')} AS storecountry,
         {s('LineItem_StockCode')} AS lineitem_stockcode,
         {s('LineItem_Description')} AS lineitem_description,
         TRY_CAST(trim({P}LineItem_Quantity) AS DOUBLE) AS lineitem_quantity,
         {money_of(P + 'LineItem_UnitPrice', money)} AS lineitem_unitprice,
         {money_of(P + 'LineItem_SalePrice', money)} AS lineitem_saleprice,
         {long_of(P + 'Customer_CustomerID')} AS customer_customerid,
         {s('Customer_EmailId')} AS customer_emailid,
         {s('Customer_ContactNo')} AS customer_contactno,
         {s('Customer_FirstName')} AS customer_firstname,
         {s('Customer_MiddleName')} AS customer_middlename,
         {s('Customer_LastName')} AS customer_lastname,
         {s('Customer_Address')} AS customer_address,
         {s('Customer_State')} AS customer_state,
         {s('Customer_Country')} AS customer_country,
         {s('Customer_ZipCode')} AS customer_zipcode,
         {s('Discount_DiscountCode')} AS discountcode,
         {s('Region')} AS region,
         TRY_CAST(trim({P}SourceTimestamp) AS TIMESTAMP) AS sourcets
  FROM staged),
{name} AS (
  SELECT invoiceno, invoicets, CAST(invoicets AS DATE) AS invoicedate,
         CAST(year(invoicets) AS INTEGER) AS invoice_year,
         CAST(month(invoicets) AS INTEGER) AS invoice_month,
         storeno, storepos, storecountry, lineitem_stockcode, lineitem_description,
         lineitem_quantity, lineitem_unitprice, lineitem_saleprice, customer_customerid,
         customer_emailid, customer_contactno, customer_firstname, customer_middlename,
         customer_lastname, customer_address, customer_state, customer_country,
         customer_zipcode, discountcode, region, sourcets
  FROM {name}_ts)"""


# The clean layer's column names, in order, and which are texts.
CLEAN_COLS = ["invoiceno", "invoicets", "invoicedate", "invoice_year", "invoice_month",
              "storeno", "storepos", "storecountry", "lineitem_stockcode",
              "lineitem_description", "lineitem_quantity", "lineitem_unitprice",
              "lineitem_saleprice", "customer_customerid", "customer_emailid",
              "customer_contactno", "customer_firstname", "customer_middlename",
              "customer_lastname", "customer_address", "customer_state", "customer_country",
              "customer_zipcode", "discountcode", "region", "sourcets"]
STRING_COLS = ["storeno", "storepos", "storecountry", "lineitem_stockcode",
               "lineitem_description", "customer_emailid", "customer_contactno",
               "customer_firstname", "customer_middlename", "customer_lastname",
               "customer_address", "customer_state", "customer_country", "customer_zipcode",
               "discountcode", "region"]
DERIVED = ["processing_delay", "customer_status", "local_stockcode", "standard_stockcode"]


def filled_cte(money: str, src: str = "clean", name: str = "filled") -> str:
    cols = []
    for c in CLEAN_COLS:
        if c in STRING_COLS:
            cols.append(f"coalesce({c}, 'NaN') AS {c}")
        elif c in ("invoiceno", "customer_customerid"):
            cols.append(f"coalesce({c}, -1) AS {c}")
        elif c == "lineitem_quantity" or (money == "float" and c in (
                "lineitem_unitprice", "lineitem_saleprice")):
            t = "DOUBLE" if c == "lineitem_quantity" else "FLOAT"
            cols.append(f"coalesce({c}, CAST('NaN' AS {t})) AS {c}")
        elif c in ("invoicets", "sourcets"):
            cols.append(f"coalesce({c}, TIMESTAMP '1900-01-01 00:00:00') AS {c}")
        else:
            cols.append(c)
    return f"{name} AS (SELECT {', '.join(cols)} FROM {src})"


def prepared_cte(money: str, name: str = "prepared") -> str:
    return (clean_cte(money) + ",\n" + filled_cte(money) + f""",
{name} AS (
  SELECT *, CAST(date_diff('day', CAST(sourcets AS DATE), DATE '{AS_OF[:10]}') AS INTEGER)
              AS processing_delay,
         customer_customerid IS NOT NULL AS customer_status,
         substring(lineitem_stockcode, 1, 3) AS local_stockcode,
         lpad(lineitem_stockcode, 10, '0') AS standard_stockcode
  FROM filled)""")


PREPARED_COLS = CLEAN_COLS + DERIVED


def text_of(cols: list[str], alias: str = "") -> str:
    """Select list with dates/timestamps as text, decimals as double."""
    a = f"{alias}." if alias else ""
    out = []
    for c in cols:
        if c in ("invoicets", "sourcets", "create_ts", "update_ts"):
            out.append(f"strftime({a}{c}, '%Y-%m-%d %H:%M:%S') AS {c}")
        elif c == "invoicedate":
            out.append(f"CAST({a}{c} AS VARCHAR) AS {c}")
        elif c in ("lineitem_unitprice_d", "lineitem_saleprice_d"):
            out.append(f"CAST({a}{c} AS DOUBLE) AS {c}")
        else:
            out.append(f"{a}{c}")
    return ", ".join(out)


def dedup_cte(keys: list[str], src_cols: list[str], src: str = "prepared",
              name: str = "marked") -> str:
    order = ["sourcets DESC NULLS LAST"] + [f"{c} ASC NULLS FIRST" for c in src_cols
                                            if c not in keys and c != "sourcets"]
    return (f"{name} AS (SELECT *, CAST(row_number() OVER (PARTITION BY {', '.join(keys)} "
            f"ORDER BY {', '.join(order)}) AS INTEGER) AS rownumber FROM {src})")


DEDUP_KEYS = ["region", "storepos", "storeno", "invoicets", "invoiceno"]
DEDUP_KEYS_DAILY = ["region", "storepos", "storeno", "invoicedate", "invoiceno"]

DIMS = """
currency AS (SELECT ' ' || lower(n_name) AS country,
                    'CUR' || CAST(n_nationkey % 5 AS VARCHAR) AS currency_cd
             FROM nation WHERE n_nationkey % 4 <> 0),
conversion AS (SELECT * FROM (VALUES ('cur0 ', 1.0), ('cur1', 0.5), ('cur2', 1.25),
                                     ('cur3', 83.1)) v(source_currency, conversion_rate)),
discount AS (SELECT * FROM (VALUES ('disc00', 0.0), ('disc05 ', 10.0), ('disc10', 15.0))
             v(discount_cd, discount_per))"""


def enriched_cte(src: str, money: str, name: str = "enriched") -> str:
    if money == "decimal":
        rate = "COALESCE(CAST(c.conversion_rate AS DECIMAL(10,4)), CAST(1 AS DECIMAL(10,4)))"
        disc = ("CAST(COALESCE(CAST(d.discount_per AS DECIMAL(7,4)), CAST(5 AS DECIMAL(7,4))) "
                "/ 100 AS DECIMAL(7,4))")
    else:
        rate = "COALESCE(CAST(c.conversion_rate AS DOUBLE), 1.0)"
        disc = "COALESCE(CAST(d.discount_per AS DOUBLE), 5.0) / 100"
    return f"""
{name}_l AS (
  SELECT a.*, COALESCE(b.currency_cd, 'USD') AS currency_code, {rate} AS conversion_rate,
         {disc} AS discount_value
  FROM {src} a
  LEFT JOIN currency b ON lower(a.storecountry) = lower(trim(b.country))
  LEFT JOIN conversion c ON lower(trim(b.currency_cd)) = lower(trim(c.source_currency))
  LEFT JOIN discount d ON lower(a.discountcode) = lower(trim(d.discount_cd))),
{name} AS (
  SELECT *, round((lineitem_saleprice - lineitem_saleprice * discount_value)
                  * conversion_rate, 2) AS lineitem_finalsaleprice
  FROM {name}_l)"""


CURATED_COLS = PREPARED_COLS + ["rownumber", "currency_code", "conversion_rate",
                                "discount_value", "lineitem_finalsaleprice"]


def _dbl(cols: list[str], dec: set[str]) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" if c in dec else c for c in cols)


def curated_sql_cte() -> str:
    """staged -> prepared (decimal money) -> marked -> enriched."""
    return _with(STAGED, prepared_cte("decimal"), dedup_cte(DEDUP_KEYS, PREPARED_COLS),
                 DIMS, enriched_cte("marked", "decimal"))


DEC = {"lineitem_unitprice", "lineitem_saleprice", "conversion_rate", "discount_value",
       "lineitem_finalsaleprice"}


def curated_text() -> str:
    cols = []
    for c in CURATED_COLS:
        if c in DEC:
            cols.append(f"CAST({c} AS DOUBLE) AS {c}")
        else:
            cols.append(text_of([c]))
    return ", ".join(cols)


MONTHLY = """
monthly AS (
  SELECT region, storeno, invoice_year, invoice_month,
         count(DISTINCT invoiceno) AS num_invoices,
         count(DISTINCT lineitem_stockcode) AS stock_count,
         sum(lineitem_quantity) AS total_quantity,
         CAST(sum(lineitem_finalsaleprice) AS DOUBLE) AS total_sales
  FROM enriched GROUP BY region, storeno, invoice_year, invoice_month)"""


def monthly_sql(select: str) -> str:
    return curated_sql_cte()[:-1] + ",\n" + MONTHLY + "\n" + select


# -- per-query SQL ------------------------------------------------------------

def sql_scan_parquet():
    return _with(STAGED) + f"SELECT {', '.join(STAGING_COLUMNS)} FROM staged"


def sql_type_conversion():
    return _with(STAGED, clean_cte("float")) + f"SELECT {text_of(CLEAN_COLS)} FROM clean"


def sql_cast_numeric():
    price = "CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR)"
    texts = (f"SELECT l_orderkey, l_linenumber, {price} AS t_price, "
             f"' -' || {price} || ' ' AS t_negative, "
             f"CAST(l_linenumber AS VARCHAR) || 'e1' AS t_exponent, "
             f"'.' || CAST(l_linenumber AS VARCHAR) AS t_fraction, l_returnflag AS t_text "
             f"FROM lineitem")
    cols = []
    for c in ("t_price", "t_negative", "t_exponent", "t_fraction", "t_text"):
        cols += [f"CAST({long_of(c)} AS VARCHAR) AS {c}_long",
                 f"TRY_CAST(trim({c}) AS DOUBLE) AS {c}_double"]
    return f"WITH texts AS ({texts}) SELECT l_orderkey, l_linenumber, {', '.join(cols)} FROM texts"


def sql_currency_parse():
    u, s = P + "LineItem_UnitPrice", P + "LineItem_SalePrice"
    grouped = f"'$' || format('{{:,.2f}}', CAST(substring({s}, 2) AS DECIMAL(12,2)))"
    return _with(STAGED) + (
        f"SELECT {u}, {s}, {money_of(u, 'float')} AS unit_float, "
        f"{money_of(s, 'float')} AS sale_float, "
        f"CAST({money_of(u, 'decimal')} AS DOUBLE) AS unit_decimal, "
        f"CAST({money_of(s, 'decimal')} AS DOUBLE) AS sale_decimal, "
        f"{money_of(grouped, 'float')} AS grouped_float FROM staged")


def sql_date_parts():
    return _with(STAGED, clean_cte("float")) + (
        f"SELECT {text_of(['invoicets', 'invoicedate', 'invoice_year', 'invoice_month', 'sourcets'])}"
        f" FROM clean")


def sql_null_fill():
    return _with(STAGED, clean_cte("float"), filled_cte("float")) + \
        f"SELECT {text_of(CLEAN_COLS)} FROM filled"


def sql_processing_delay():
    return _with(STAGED, prepared_cte("float")) + \
        f"SELECT invoiceno, {text_of(['sourcets'])}, processing_delay FROM prepared"


def sql_customer_status():
    return _with(STAGED, clean_cte("float"), filled_cte("float")) + (
        "SELECT invoiceno, customer_customerid, customer_customerid IS NOT NULL AS customer_status,"
        " (customer_customerid IS NOT NULL AND customer_customerid <> -1) AS customer_known "
        "FROM filled")


def sql_stockcode_derive():
    return _with(STAGED, prepared_cte("float")) + \
        "SELECT lineitem_stockcode, local_stockcode, standard_stockcode FROM prepared"


def sql_dedup_mark():
    return _with(STAGED, prepared_cte("float"), dedup_cte(DEDUP_KEYS, PREPARED_COLS)) + \
        f"SELECT {text_of(PREPARED_COLS + ['rownumber'])} FROM marked"


def sql_dedup_mark_daily():
    return _with(STAGED, prepared_cte("float"), dedup_cte(DEDUP_KEYS_DAILY, PREPARED_COLS)) + \
        f"SELECT {text_of(PREPARED_COLS + ['rownumber'])} FROM marked"


def sql_dedup_latest():
    return _with(STAGED, prepared_cte("float"), dedup_cte(DEDUP_KEYS, PREPARED_COLS)) + \
        f"SELECT {text_of(PREPARED_COLS + ['rownumber'])} FROM marked WHERE rownumber = 1"


def sql_enrich_currency():
    return _with(STAGED, prepared_cte("float"), DIMS) + (
        f"SELECT {text_of(PREPARED_COLS, 'a')}, COALESCE(b.currency_cd, 'USD') AS currency_code "
        "FROM prepared a LEFT JOIN currency b ON lower(a.storecountry) = lower(trim(b.country))")


def sql_enrich_conversion():
    return _with(STAGED, prepared_cte("float"), DIMS) + (
        f"SELECT {text_of(PREPARED_COLS, 'a')}, COALESCE(b.currency_cd, 'USD') AS currency_code, "
        "COALESCE(CAST(c.conversion_rate AS DOUBLE), 1.0) AS conversion_rate "
        "FROM prepared a LEFT JOIN currency b ON lower(a.storecountry) = lower(trim(b.country)) "
        "LEFT JOIN conversion c ON lower(trim(b.currency_cd)) = lower(trim(c.source_currency))")


def sql_enrich_discount():
    return _with(STAGED, prepared_cte("float"), DIMS) + (
        f"SELECT {text_of(PREPARED_COLS, 'a')}, "
        "COALESCE(CAST(d.discount_per AS DOUBLE), 5.0) / 100 AS discount_value "
        "FROM prepared a LEFT JOIN discount d ON lower(a.discountcode) = lower(trim(d.discount_cd))")


def sql_enrich_full():
    return curated_sql_cte() + f"SELECT {curated_text()} FROM enriched"


def sql_final_sale_price():
    return curated_sql_cte() + (
        "SELECT invoiceno, storeno, lineitem_stockcode, "
        + _dbl(["lineitem_saleprice", "discount_value", "conversion_rate",
                "lineitem_finalsaleprice"], DEC) + " FROM enriched")


def sql_monthly_store_sales():
    return monthly_sql("SELECT * FROM monthly")


def sql_monthly_sales_sorted():
    return monthly_sql("SELECT * FROM monthly ORDER BY region ASC NULLS FIRST, "
                       "storeno ASC NULLS FIRST, invoice_year DESC NULLS LAST, "
                       "invoice_month DESC NULLS LAST")


def sql_sales_lead_lag():
    w = ("OVER (PARTITION BY region, storeno ORDER BY invoice_year DESC NULLS LAST, "
         "invoice_month DESC NULLS LAST)")
    return monthly_sql(
        f"SELECT *, {spark_round('(total_sales - prev_sales) / nullif(prev_sales, 0) * 100', 2)}"
        f" AS change_pct "
        f"FROM (SELECT *, CAST(row_number() {w} AS INTEGER) AS rownumber, "
        f"lead(total_sales, 1) {w} AS next_sales, lag(total_sales, 1) {w} AS prev_sales "
        f"FROM monthly) x")


def spark_round(x: str, d: int) -> str:
    """Spark's ROUND on a double: half-up on the shortest decimal text."""
    return (f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,20)), {d}) AS DOUBLE)")


def sql_preview_limit():
    return monthly_sql("SELECT * FROM monthly ORDER BY region ASC NULLS FIRST, "
                       "storeno ASC NULLS FIRST, invoice_year DESC NULLS LAST, "
                       "invoice_month DESC NULLS LAST LIMIT 10")


# The merge key of the batch job.
MERGE_KEYS = ["invoiceno", "storeno", "lineitem_stockcode", "invoicedate", "region"]


def _merge_sql(target_regions: list[str], update_regions: list[str]) -> str:
    q = lambda rs: ", ".join(f"'{r}'" for r in rs)
    upd_cols = ", ".join("lineitem_quantity + 1 AS lineitem_quantity" if c == "lineitem_quantity"
                         else c for c in CURATED_COLS)
    on = " AND ".join(f"t.{k} = u.{k}" for k in MERGE_KEYS)
    newest = ", ".join(["sourcets DESC NULLS LAST"] + [f"{c} ASC NULLS FIRST" for c in CURATED_COLS
                                                       if c not in MERGE_KEYS and c != "sourcets"])
    return curated_sql_cte()[:-1] + f""",
cur0 AS (SELECT {curated_text()} FROM enriched),
cur AS (SELECT * FROM cur0 QUALIFY row_number() OVER (PARTITION BY {', '.join(MERGE_KEYS)} ORDER BY {newest}) = 1),
target AS (SELECT * FROM cur WHERE region IN ({q(target_regions)})),
updates AS (SELECT {upd_cols} FROM cur WHERE region IN ({q(update_regions)}))
SELECT t.* FROM target t WHERE NOT EXISTS (SELECT 1 FROM updates u WHERE {on})
UNION ALL SELECT * FROM updates"""


def sql_merge_upsert():
    return _merge_sql(["AFRICA", "AMERICA", "ASIA"], ["ASIA", "EUROPE", "MIDDLE EAST"])


def sql_merge_insert_only():
    return _merge_sql(["AFRICA", "AMERICA"], ["ASIA", "EUROPE", "MIDDLE EAST"])


def sql_merge_matched_only():
    return _merge_sql(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"], ["EUROPE"])


LINES = """lines AS (
  SELECT l_orderkey, l_linenumber, max(l_quantity)::DOUBLE AS quantity,
         CASE l_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN '01' WHEN 3 THEN '1' ELSE max(l_returnflag) END AS region,
         CASE WHEN l_linenumber <> 3 THEN max(year(l_shipdate))::VARCHAR END AS invoice_year
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


def sql_upsert_on_disk():
    return _with(LINES) + ("SELECT l_orderkey, l_linenumber, quantity + CASE WHEN l_linenumber >= 3 THEN 100 ELSE 0 END AS quantity, "
                           "region, invoice_year FROM lines")


def sql_merge_moving_partition():
    return _with(LINES) + ("SELECT l_orderkey, l_linenumber, quantity, CASE WHEN l_linenumber <= 2 THEN 'moved ' || l_linenumber "
                           "ELSE region END AS region, invoice_year FROM lines")


def sql_merge_bucketed():
    return sql_upsert_on_disk()


def sql_dedup_mark_observed():
    return _with(STAGED, prepared_cte("float"), dedup_cte(["region", "storepos"], PREPARED_COLS)) + \
        f"SELECT {text_of(PREPARED_COLS + ['rownumber'])} FROM marked"


def sql_flatten_variant():
    """Row by row as each shape of document flattens; nothing is parsed."""
    key = "SELECT l_orderkey, l_linenumber, CAST({bad} AS VARCHAR) AS _corrupt_record, '{items}' AS items, {path} AS path, CAST({value} AS VARCHAR) AS value, {type} AS type FROM lineitem WHERE l_linenumber = {pos}"
    out = []

    def rows(pos, items, *fields):
        for path, value, type_ in fields:
            out.append(key.format(bad="NULL", items=items, path=f"'{path}'", value=value, type=f"'{type_}'", pos=pos))
    number = ("Txn_No", "l_orderkey", "STRING")
    for i, tag in enumerate("ab"):
        rows(1, i, number, ("Txn_Loyalty_Tier", "3", "BIGINT"), ("Txn_Loyalty_Tags", f"'{tag}'", "STRING"))
    rows(2, "0,0", number, ("Txn_Item_Code", "l_partkey", "BIGINT"))
    rows(2, "0,1", number, ("Txn_Item_Code", "'x'", "STRING"))
    rows(2, "1,-1", number, ("Txn_Item", "NULL", "VOID"))
    rows(3, "", ("Txn_No", "l_orderkey", "BIGINT"), ("Txn_Item", "'none'", "STRING"), ("Txn_Open", "'true'", "BOOLEAN"))
    for i, a in enumerate((("A", "1", "BIGINT"), ("A", "'two'", "STRING"))):
        rows(4, f"{i},0", a, ("B", "NULL", "VOID"))
        rows(4, f"{i},1", a, ("B_C", "l_partkey", "BIGINT"))
    rows(5, "", ("", "NULL", "VOID"))
    out.append(key.format(bad="""'{"Txn":{"No":"' || l_orderkey""", items="", path="NULL", value="NULL", type="NULL", pos=6))
    rows(7, "0", ("", "l_orderkey", "BIGINT"))
    rows(7, "1", ("k_deep_er", "'1.5'", "DECIMAL(2,1)"))
    return " UNION ALL ".join(out)


def sql_load_summary():
    return monthly_sql("SELECT * FROM monthly").replace("FROM enriched GROUP BY", "FROM enriched WHERE invoicets >= TIMESTAMP '1998-01-01' GROUP BY")


def sql_dedup_mark_hot():
    return _with(STAGED, prepared_cte("float"), dedup_cte(["region"], PREPARED_COLS)) + \
        f"SELECT {text_of(PREPARED_COLS + ['rownumber'])} FROM marked"


def dirty_cte() -> str:
    """STAGED with values spoilt by the rules of ``queries.dirty``."""
    o, pos = f"CAST({P}InvoiceNo AS BIGINT)", f"CAST({P}StorePos AS INTEGER)"
    spoil = {
        "InvoiceNo": f"CASE {o} % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '99999999999999999999' ELSE {P}InvoiceNo END",
        "InvoiceDateTime": f"CASE {o} % 7 WHEN 0 THEN NULL WHEN 1 THEN '1995-02-30 10:00:00' WHEN 2 THEN 'soon' ELSE {P}InvoiceDateTime END",
        "Region": f"CASE {o} % 13 WHEN 0 THEN '  ' WHEN 1 THEN NULL ELSE {P}Region END",
        "StoreNo": f"CASE WHEN {pos} = 1 THEN NULL ELSE {P}StoreNo END",
        "LineItem_Quantity": f"CASE {pos} WHEN 2 THEN NULL WHEN 3 THEN 'many' ELSE {P}LineItem_Quantity END",
        "LineItem_UnitPrice": f"CASE {pos} WHEN 4 THEN '$1,234.50' WHEN 5 THEN '' ELSE {P}LineItem_UnitPrice END",
        "LineItem_SalePrice": f"CASE {pos} WHEN 6 THEN NULL WHEN 7 THEN '$' ELSE {P}LineItem_SalePrice END",
        "Customer_CustomerID": f"CASE WHEN {o} % 5 = 0 THEN NULL ELSE {P}Customer_CustomerID END",
        "SourceTimestamp": f"CASE WHEN {o} % 3 = 0 THEN NULL ELSE {P}SourceTimestamp END"}
    cols = ", ".join(f"{spoil.get(c[len(P):], c)} AS {c}" for c in STAGING_COLUMNS)
    return STAGED.replace("staged AS (", "whole AS (") + f",\nstaged AS (SELECT {cols} FROM whole)"


def sql_type_conversion_dirty():
    cols = [f"CAST({c} AS VARCHAR) AS {c}" if c in ("invoiceno", "customer_customerid", "invoice_year", "invoice_month")
            else "CAST(invoicedate AS VARCHAR) AS invoicedate" if c == "invoicedate"
            else text_of([c]) for c in CLEAN_COLS]
    return _with(dirty_cte(), clean_cte("float")) + f"SELECT {', '.join(cols)} FROM clean"


def sql_null_fill_dirty():
    cols = [f"CAST({c} AS VARCHAR) AS {c}" if c in ("invoice_year", "invoice_month") else text_of([c]) for c in CLEAN_COLS]
    return _with(dirty_cte(), clean_cte("float"), filled_cte("float")) + f"SELECT {', '.join(cols)} FROM filled"


def sql_monthly_sales_nan():
    return _with(dirty_cte(), clean_cte("float"), filled_cte("float")) + (
        "SELECT region, storepos, count(DISTINCT invoiceno) AS num_invoices, count(DISTINCT lineitem_stockcode) AS stock_count, "
        "sum(lineitem_quantity) AS total_quantity, round(sum(lineitem_saleprice::DOUBLE), 1) AS total_sales FROM filled GROUP BY ALL")


def sql_merge_null_key():
    return _with(dirty_cte(), f"""r AS (SELECT {long_of(P + 'InvoiceNo')} AS invoiceno, {P}StorePos AS storepos,
    {P}LineItem_StockCode AS stock FROM staged),
u AS (SELECT * FROM r WHERE storepos IN ('1', '2')),
m AS (SELECT invoiceno, storepos, 'new' AS state FROM u UNION ALL
      SELECT invoiceno, storepos, 'old' FROM r WHERE invoiceno IS NULL OR storepos NOT IN ('1', '2'))""") + \
        "SELECT invoiceno IS NULL AS no_invoice, storepos, state, count(*) AS n FROM m GROUP BY ALL"


def sql_files_round_trip():
    return sql_final_sale_price()


def sql_staging_discovered():
    return sql_scan_parquet()


def sql_inferred_dimension():
    return """SELECT CAST(p_partkey AS INTEGER) AS tax_cd, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS tax_name,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS tax_per,
       'int' AS tax_cd_type, 'string' AS tax_name_type, 'double' AS tax_per_type FROM part"""


def sql_curate_audit():
    return f"SELECT *, TRUE AS stamps_equal, TRUE AS stamped_by_run FROM ({sql_final_sale_price()}) AS curated"


def sql_flatten_nested():
    return sql_scan_parquet()


ITEM = ["StockCode", "Description", "Quantity", "UnitPrice", "SalePrice"]


def sql_explode_items():
    other = [c for c in STAGING_COLUMNS if "_LineItem_" not in c]
    head = [c for c in other if not c.startswith(P + "Customer") and not c.startswith(P + "Disc")
            and c != P + "SourceTimestamp"]
    tail = [c for c in other if c not in head]
    li = lambda exprs: ", ".join(f"{e} AS {P}LineItem_{n}" for e, n in zip(exprs, ITEM))  # noqa
    none = li(["CAST(NULL AS VARCHAR)"] * 5)
    item = li([f"{P}LineItem_{n}" for n in ITEM])
    unit = li([f"{P}LineItem_StockCode", f"{P}LineItem_Description", "'1'",
               f"{P}LineItem_UnitPrice", f"{P}LineItem_UnitPrice"])
    pos = f"CAST({P}StorePos AS INTEGER)"
    h, t = ", ".join(head), ", ".join(tail)
    return _with(STAGED) + (
        f"SELECT {h}, {none}, {t} FROM staged WHERE {pos} <= 2 "
        f"UNION ALL SELECT {h}, {item}, {t} FROM staged WHERE {pos} > 2 "
        f"UNION ALL SELECT {h}, {unit}, {t} FROM staged WHERE {pos} > 4")


def _json_obj(pairs: list[tuple[str, str]], nulls: bool = False) -> str:
    """JSON object text with Spark's layout: no blanks, NULL fields left out
    or written."""
    parts = []
    for i, (k, v) in enumerate(pairs):
        if nulls:
            parts.append(f"'\"{k}\":' || coalesce(CAST(to_json({v}) AS VARCHAR), 'null') || ','")
            continue
        parts.append(f"CASE WHEN {v} IS NULL THEN '' ELSE '\"{k}\":' || CAST(to_json({v}) AS VARCHAR)"
                     f" || ',' END")
    body = " || ".join(parts)
    return f"'{{' || rtrim({body}, ',') || '}}'"


def _doc_text() -> str:
    sub = lambda grp, names: _json_obj([(n, f"{P}{grp}_{n}") for n in names])
    cust = [c[len(P + "Customer_"):] for c in STAGING_COLUMNS if c.startswith(P + "Customer_")]
    inner_pairs = [(n, f"{P}{n}") for n in ("InvoiceNo", "InvoiceDateTime", "StoreNo", "StorePos",
                                           "Region", "StoreCountry")]
    inner = " || ".join(f"'\"{k}\":' || CAST(to_json({v}) AS VARCHAR) || ','" for k, v in inner_pairs)
    inner += (f" || '\"LineItem\":' || {sub('LineItem', ITEM)} || ','"
              f" || '\"Customer\":' || {sub('Customer', cust)} || ','"
              f" || '\"Discount\":' || {sub('Discount', ['DiscountCode'])} || ','"
              f" || '\"SourceTimestamp\":' || CAST(to_json({P}SourceTimestamp) AS VARCHAR)")
    return "'{\"RetailTxnData\":{' || " + inner + " || '}}'"


RECORD_ID = (f"concat_ws('-', {P}InvoiceNo, {P}StorePos, {P}LineItem_StockCode, {P}StoreNo)")


def sql_decode_payload():
    return _with(STAGED) + f"SELECT {RECORD_ID} AS recordId, {_doc_text()} AS payload FROM staged"


def sql_parse_json():
    return _with(STAGED) + f"SELECT {RECORD_ID} AS recordId, {', '.join(STAGING_COLUMNS)} FROM staged"


def sql_parse_json_props():
    return "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"


def sql_flatten_to_json():
    flat = _json_obj([(c, c) for c in STAGING_COLUMNS], nulls=True)
    return _with(STAGED) + (f"SELECT {RECORD_ID} AS recordId, 'Ok' AS result, "
                            f"to_base64(encode({flat})) AS data FROM staged")


def _archive_cte() -> str:
    region = f"replace({P}Region, ' ', '')"
    date = f"substring({P}InvoiceDateTime, 1, 10)"
    key = (f"'raw/Region=' || {region} || '/StoreNo=' || {P}StoreNo || '/invoiceprocess_date=' || "
           f"{date} || '/retail-dataset-' || {region} || '-' || {P}StoreNo || '-' || {P}InvoiceNo "
           f"|| '.json'")
    return _with(STAGED, f"""archive AS (
  SELECT {RECORD_ID} AS recordId, {P}SourceTimestamp AS arrival, {_doc_text()} AS payload,
         {region} AS Region, {P}StoreNo AS StoreNo, {date} AS invoiceprocess_date,
         {P}InvoiceNo AS InvoiceNo, {key} AS archive_key
  FROM staged)""")


def sql_raw_archive_keys():
    return _archive_cte() + "SELECT recordId, archive_key FROM archive"


def sql_raw_archive_latest():
    return _archive_cte() + (
        "SELECT archive_key, arrival, payload FROM (SELECT *, row_number() OVER ("
        "PARTITION BY Region, StoreNo, invoiceprocess_date, InvoiceNo "
        "ORDER BY arrival DESC NULLS LAST, payload DESC NULLS LAST) AS rn FROM archive) x "
        "WHERE rn = 1")


def sql_archive_from_publish():
    return sql_raw_archive_latest()


def sql_load_incremental():
    return sql_monthly_store_sales()


def sql_sql_surface():
    return monthly_sql("SELECT m.*, round((total_sales - lead(total_sales) OVER w) / nullif(lead(total_sales) OVER w, 0) * 100, 2) AS change "
                       "FROM monthly m WINDOW w AS (PARTITION BY region, storeno ORDER BY invoice_year DESC, invoice_month DESC)")


def sql_sorted_on_disk():
    return monthly_sql("SELECT *, row_number() OVER (ORDER BY region NULLS FIRST, storeno NULLS FIRST, invoice_year DESC NULLS LAST, "
                       "invoice_month DESC NULLS LAST) - 1 AS position FROM monthly")


def sql_ingest_native_sink():
    return sql_scan_parquet()


def sql_json_array_split():
    return sql_scan_parquet()


def sql_archive_compacted():
    return sql_raw_archive_latest()


def sql_ingest_quarantined():
    pos = f"CAST({P}StorePos AS INTEGER)"
    return _with(STAGED) + (
        f"SELECT 'bad' AS recordId, 'record' AS reason, CAST(NULL AS VARCHAR) AS item FROM staged WHERE {pos} = 7 "
        f"UNION ALL SELECT 'shape 2', 'line item', '7' FROM staged WHERE {pos} = 2 "
        f"UNION ALL SELECT 'shape ' || {pos}, 'record', NULL FROM staged WHERE {pos} BETWEEN 3 AND 6")


def sql_ingest_staged():
    pos = f"CAST({P}StorePos AS INTEGER)"
    unit = {P + "LineItem_Quantity": "'1'", P + "LineItem_SalePrice": P + "LineItem_UnitPrice"}
    single = ", ".join(f"{unit[c]} AS {c}" if c in unit else c for c in STAGING_COLUMNS)
    every = ", ".join(STAGING_COLUMNS)
    return _with(STAGED) + (f"SELECT {every} FROM staged WHERE {pos} <= 6 UNION ALL SELECT {every} FROM staged WHERE {pos} <= 2 "
                            f"UNION ALL SELECT {single} FROM staged WHERE {pos} = 6")


ORACLE: dict[str, str] = {
    name[4:]: fn() for name, fn in sorted(globals().items())
    if name.startswith("sql_") and callable(fn)
}
