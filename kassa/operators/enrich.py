"""Dimension enrichment: currency, conversion rate, discount, final price.

Reference semantics (left joins, defaults USD / rate 1 / 5 % discount):

* currency:   lower(storecountry) = lower(trim(country))
* conversion: lower(trim(currency_cd)) = lower(trim(source_currency)), keyed
  on the looked-up code, not the defaulted one, so an unknown country gets
  rate 1 even if a 'USD' rate exists
* discount:   lower(discountcode) = lower(trim(discount_cd))

Plan: the dimensions are normalised once on their own side and currency is
joined to conversion *before* meeting the fact table (exactly equivalent for
left joins whose second condition only reads the first dimension), so the
fact side sees two joins. Each dimension is broadcast only after a bounded
row count proves it small; otherwise the join shuffles and AQE handles skew.
Duplicate dimension keys fan rows out, as in the reference;
``unique_dims=True`` raises instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kassa.functions.derive import final_sale_price
from kassa.plans.sizing import broadcast_if_bounded

DEFAULT_CURRENCY = "USD"
DEFAULT_RATE = 1
DEFAULT_DISCOUNT_PERCENT = 5

MONEY_TYPES = {"decimal": {"rate": "decimal(10,4)", "discount": "decimal(7,4)"}}


def _norm(c: str):
    return F.lower(F.trim(F.col(c)))


def _check_unique(dim: DataFrame, key: str, what: str) -> None:
    dup = dim.groupBy(key).count().filter("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"{what} dimension has duplicate key {dup[0][key]!r}")


def currency_lookup(currency: DataFrame, conversion: DataFrame | None,
                    money: str = "float", max_dim_rows: int = 1_000_000,
                    unique_dims: bool = False) -> DataFrame:
    """(``_country_key``, ``currency_code``, ``conversion_rate``) per country,
    with the rate already resolved; one small frame for one fact-side join."""
    cur = currency.select(_norm("country").alias("_country_key"),
                          F.col("currency_cd").alias("_currency_cd"))
    if unique_dims:
        _check_unique(cur, "_country_key", "currency")
    if conversion is None:
        return cur
    conv = conversion.select(_norm("source_currency").alias("_conv_key"),
                             F.col("conversion_rate").alias("_rate"))
    if unique_dims:
        _check_unique(conv, "_conv_key", "conversion")
    conv = broadcast_if_bounded(conv, max_dim_rows)
    joined = cur.join(conv, F.lower(F.trim(cur["_currency_cd"])) == conv["_conv_key"], "left")
    return joined.select("_country_key", "_currency_cd", "_rate")


def _rate_type(money: str) -> str:
    return MONEY_TYPES["decimal"]["rate"] if money == "decimal" else "double"


def _discount_type(money: str) -> str:
    return MONEY_TYPES["decimal"]["discount"] if money == "decimal" else "double"


def enrich_currency(df: DataFrame, currency: DataFrame, max_dim_rows: int = 1_000_000,
                    unique_dims: bool = False) -> DataFrame:
    """Add ``currency_code`` (default 'USD')."""
    look = broadcast_if_bounded(currency_lookup(currency, None, unique_dims=unique_dims),
                                max_dim_rows)
    out = df.join(look, F.lower(df["storecountry"]) == look["_country_key"], "left")
    return out.select(*[df[c] for c in df.columns],
                      F.coalesce(F.col("_currency_cd"), F.lit(DEFAULT_CURRENCY)).alias("currency_code"))


def enrich_conversion(df: DataFrame, currency: DataFrame, conversion: DataFrame,
                      money: str = "float", max_dim_rows: int = 1_000_000,
                      unique_dims: bool = False) -> DataFrame:
    """Add ``currency_code`` and ``conversion_rate`` (default 1)."""
    look = broadcast_if_bounded(
        currency_lookup(currency, conversion, money, max_dim_rows, unique_dims), max_dim_rows)
    out = df.join(look, F.lower(df["storecountry"]) == look["_country_key"], "left")
    return out.select(
        *[df[c] for c in df.columns],
        F.coalesce(F.col("_currency_cd"), F.lit(DEFAULT_CURRENCY)).alias("currency_code"),
        F.coalesce(F.col("_rate").cast(_rate_type(money)),
                   F.lit(DEFAULT_RATE).cast(_rate_type(money))).alias("conversion_rate"))


def enrich_discount(df: DataFrame, discount: DataFrame, money: str = "float",
                    max_dim_rows: int = 1_000_000, unique_dims: bool = False) -> DataFrame:
    """Add ``discount_value`` = percent / 100 (default 5 %)."""
    disc = discount.select(_norm("discount_cd").alias("_disc_key"),
                           F.col("discount_per").alias("_disc_per"))
    if unique_dims:
        _check_unique(disc, "_disc_key", "discount")
    disc = broadcast_if_bounded(disc, max_dim_rows)
    out = df.join(disc, F.lower(df["discountcode"]) == disc["_disc_key"], "left")
    t = _discount_type(money)
    per = F.coalesce(F.col("_disc_per").cast(t), F.lit(DEFAULT_DISCOUNT_PERCENT).cast(t))
    value = (per / F.lit(100).cast(t)).cast(t) if money == "decimal" else per / 100
    return out.select(*[df[c] for c in df.columns], value.alias("discount_value"))


def enrich(df: DataFrame, currency: DataFrame, conversion: DataFrame, discount: DataFrame,
           money: str = "float", max_dim_rows: int = 1_000_000,
           unique_dims: bool = False) -> DataFrame:
    """All three lookups plus ``lineitem_finalsaleprice``
    = round((sale - sale * discount_value) * conversion_rate, 2)."""
    out = enrich_conversion(df, currency, conversion, money, max_dim_rows, unique_dims)
    out = enrich_discount(out, discount, money, max_dim_rows, unique_dims)
    return add_final_price(out)


def add_final_price(df: DataFrame) -> DataFrame:
    return df.withColumn("lineitem_finalsaleprice", final_sale_price(
        "lineitem_saleprice", "discount_value", "conversion_rate"))
