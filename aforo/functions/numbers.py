"""Tolerant number parsing: a bad value is NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column

from aforo.functions.text import STRIP_SQL, named, strip_blanks


def parse_decimal(c: Column | str, precision: int = 18, scale: int = 2) -> Column:
    """Plain or exponent notation, rounded half up to ``scale``.

    Comma decimals, digit grouping, NaN, infinities and values beyond the
    precision are NULL.
    """
    if isinstance(c, str):
        return named(f"try_cast({STRIP_SQL} AS decimal({precision},{scale}))", c)
    return strip_blanks(c).try_cast(f"decimal({precision},{scale})")


def parse_int(c: Column | str) -> Column:
    """Decimal text truncated toward zero."""
    return strip_blanks(c).try_cast("decimal(38,18)").try_cast("int")
