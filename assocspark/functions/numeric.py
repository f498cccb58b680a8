"""Null-, NaN- and ANSI-safe numeric expressions.

Spark orders NaN above every number and treats ``NaN >= 0`` as true, so every range check in this
package goes through :func:`is_finite` first. Casts and divisions use the ``try_`` forms: a bad value
becomes NULL and then fails its check, instead of stopping the job.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c: Column | str) -> Column:
    """True for a real number; false (never NULL) for NULL, NaN and the infinities."""
    c = _col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(INFINITY))


def finite_or_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(is_finite(c), c)


def safe_div(a: Column | str, b: Column | str) -> Column:
    """Division giving NULL on a zero denominator."""
    return F.try_divide(_col(a), _col(b))


def is_missing(c: Column | str, tokens: Iterable[str]) -> Column:
    """NULL, or text equal to one of ``tokens`` after trimming."""
    c = _col(c)
    return c.isNull() | F.trim(c.cast("string")).isin(list(tokens))


def clean_string(c: Column | str, tokens: Iterable[str]) -> Column:
    c = _col(c)
    return F.when(~is_missing(c, tokens), c)


def to_double(c: Column | str, missing: Iterable[str] = ()) -> Column:
    """Non-strict conversion; missing tokens and other text become NULL."""
    c = _col(c)
    missing = list(missing)
    return (clean_string(c, missing) if missing else c).try_cast("double")


def to_whole_number(c: Column | str) -> Column:
    """Plain integer text to BIGINT; decimals, exponents and padding give NULL."""
    text = _col(c).cast("string")
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
