"""Casts with the non-ANSI result under either ANSI setting.

The reference types its staging text with plain ``CAST`` and needs ANSI off
to finish (an ANSI cast raises on the first bad value). Spark 4 defaults to
ANSI on, so each cast here is written with ``try_cast`` plus the extra rules
non-ANSI parsing has, and gives the same value in both modes.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnOrName = Column | str

# Text a non-ANSI integral cast accepts: optional sign, digits, optional
# fraction (dropped, not rounded). No exponent. '.5' is 0, '5.' is 5, a lone
# '.' is 0 while a lone sign is NULL.
_INTEGRAL = r"^([+-]?)([0-9]*)(\.[0-9]*)?$"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _first_letter(t: Column) -> Column:
    """Texts from 'A' up to, not including, '{', in the order of their bytes."""
    return (t >= "A") & (t < "{")


def _number(t: Column, kind: str) -> Column:
    """``try_cast`` of a text to a floating or decimal type. A cast that fails
    raises and catches errors for each row, which takes longer than all the
    rest of the typing; texts that plainly are no number don't get that far:
    empty ones, those with a comma and those that begin with a letter other
    than that of NaN and Infinity."""
    word = _first_letter(t) & ~F.substring(t, 1, 1).isin("N", "n", "I", "i")
    return F.when(~((t == "") | word | F.contains(t, F.lit(","))), t.try_cast(kind))


def lenient_long(c: ColumnOrName) -> Column:
    """``CAST(x AS BIGINT)`` as non-ANSI Spark does it: '12.9' -> 12,
    '1e3' / 'abc' / '' / overflow -> NULL. As in ``_number``, texts that
    plainly give NULL aren't cast: empty ones, words, and whole numbers of 20
    digits or more that begin with none of 0."""
    t = F.trim(_col(c))
    # between a first and a last digit only digits or a point can be cast
    huge = ((F.length(t) >= 20) & (t >= "1") & (t < ":") & F.substring(t, -1, 1).between("0", "9")
            & ~F.contains(t, F.lit(".")))
    return F.when(~((t == "") | _first_letter(t) | huge), _long(t))


def _long(t: Column) -> Column:
    plain = t.try_cast("bigint")
    sign = F.regexp_extract(t, _INTEGRAL, 1)
    digits = F.regexp_extract(t, _INTEGRAL, 2)
    integral_text = t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]*)$")
    fractional = F.when(
        integral_text,
        F.concat(sign, F.when(digits == "", F.lit("0")).otherwise(digits)).try_cast("bigint"),
    )
    return F.coalesce(plain, fractional)


def lenient_double(c: ColumnOrName) -> Column:
    """``CAST(x AS DOUBLE)``; invalid text -> NULL, 'NaN' -> NaN."""
    return _number(F.trim(_col(c)), "double")


def lenient_float(c: ColumnOrName) -> Column:
    """``CAST(x AS FLOAT)`` (32-bit); invalid text -> NULL."""
    return _number(F.trim(_col(c)), "float")


def lenient_timestamp(c: ColumnOrName) -> Column:
    """``CAST(x AS TIMESTAMP)`` in the session time zone; invalid -> NULL."""
    return F.trim(_col(c)).try_cast("timestamp")


def strip_currency(c: ColumnOrName) -> Column:
    """Drop every '$' (then trim). Thousands separators are not handled,
    as in the reference: '$1,234.50' does not parse."""
    return F.trim(F.replace(_col(c), F.lit("$"), F.lit("")))


def money(c: ColumnOrName, mode: str = "float") -> Column:
    """Parse a price. ``mode='float'`` is the reference (32-bit float);
    ``mode='decimal'`` is exact ``decimal(12,2)``."""
    s = strip_currency(c)
    if mode == "float":
        return _number(s, "float")
    if mode == "decimal":
        return _number(s, "decimal(12,2)")
    raise ValueError(f"unknown money mode {mode!r}")
