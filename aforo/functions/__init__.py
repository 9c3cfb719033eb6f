"""Column functions. All of them stay inside JVM code generation except
``fold_accents``, which is meant for distinct values only."""

from aforo.functions.dates import calendar_fields, first_valid_date, parse_date8
from aforo.functions.headers import clean_header, clean_header_column, clean_headers
from aforo.functions.numbers import parse_decimal, parse_int
from aforo.functions.tariff import hs_chapter, hs_levels
from aforo.functions.text import (
    clean_text,
    coalesce_drift,
    default_currency,
    fold_accents,
    fold_text,
    regime_code,
    resolve_or_fallback,
    sql_clean,
    surrogate_natural_key,
    upper_text,
)

__all__ = [
    "calendar_fields", "clean_header", "clean_header_column", "clean_headers", "clean_text",
    "coalesce_drift", "default_currency", "first_valid_date", "fold_accents", "fold_text",
    "hs_chapter", "hs_levels", "parse_date8", "parse_decimal", "parse_int", "regime_code",
    "resolve_or_fallback", "sql_clean", "surrogate_natural_key", "upper_text",
]
