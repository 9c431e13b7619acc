"""Derived columns of the load job and the raw-archive key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def processing_delay(source_ts: ColumnOrName, as_of: Column | str | None = None) -> Column:
    """Whole days from the source time to ``as_of`` (default: now).

    ``as_of`` may be a Column or a timestamp literal text; a fixed value makes
    reruns reproducible.
    """
    end = F.current_timestamp() if as_of is None else (
        F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of)
    return F.datediff(end, _col(source_ts))


def customer_status(customer_id: ColumnOrName, unknown_id: int | None = None) -> Column:
    """Reference truth table: a known id is active (TRUE), NULL is FALSE.

    The reference compares a long id with '' which, without ANSI, is NULL for
    every non-null id, so only NULL reaches FALSE. ``unknown_id`` (e.g. the
    -1 fill placeholder) optionally counts as FALSE too.
    """
    c = _col(customer_id)
    known = c.isNotNull()
    if unknown_id is not None:
        known = known & (c != F.lit(unknown_id))
    return known


def local_stockcode(code: ColumnOrName) -> Column:
    """First three characters of the stock code."""
    return F.substring(_col(code), 1, 3)


def standard_stockcode(code: ColumnOrName, width: int = 10) -> Column:
    """Left-pad with '0' to ``width``; longer codes are cut to ``width``."""
    return F.lpad(_col(code), width, "0")


def final_sale_price(sale: ColumnOrName, discount: ColumnOrName,
                     rate: ColumnOrName) -> Column:
    """``ROUND((sale - sale * discount) * rate, 2)``; half-up."""
    s = _col(sale)
    return F.round((s - s * _col(discount)) * _col(rate), 2)


def percent_change(current: ColumnOrName, previous: ColumnOrName) -> Column:
    """``ROUND((current - previous) / previous * 100, 2)``; NULL when the
    previous value is NULL or zero."""
    cur, prev = _col(current), _col(previous)
    return F.round(F.try_divide(cur - prev, prev) * 100, 2)


def archive_region(region: ColumnOrName) -> Column:
    """Region with every blank removed ('North America ' -> 'NorthAmerica')."""
    return F.replace(_col(region), F.lit(" "), F.lit(""))


def archive_date(invoice_datetime_text: ColumnOrName) -> Column:
    """Processing date: the first ten characters of the invoice time text."""
    return F.substring(_col(invoice_datetime_text), 1, 10)


def archive_key(region: ColumnOrName, store: ColumnOrName, date: ColumnOrName,
                invoice: ColumnOrName, prefix: str = "raw", file_prefix: str = "retail-dataset") -> Column:
    """Object key of one archived raw record:
    ``<prefix>/Region=<r>/StoreNo=<s>/invoiceprocess_date=<d>/<file prefix>-<r>-<s>-<i>.json``."""
    r = archive_region(region)
    s = _col(store).cast("string")
    d = _col(date)
    i = _col(invoice).cast("string")
    return F.concat(
        F.lit(f"{prefix}/Region="), r, F.lit("/StoreNo="), s,
        F.lit("/invoiceprocess_date="), d, F.lit(f"/{file_prefix}-"),
        r, F.lit("-"), s, F.lit("-"), i, F.lit(".json"))
