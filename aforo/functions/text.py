"""Text cleaning and fall-back rules."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character that counts as blank at the ends of a text.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
DEFAULT_CURRENCY = "USD"
NAME_KEY_PREFIX = "NOMBRE:"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Texts that start and end with a visible ASCII character have nothing to strip;
# two cheap comparisons let them pass. One SQL text per rule keeps plans with a
# hundred columns quick to build.
_PLAIN = "{c} >= '!' AND {c} < '\x7f' AND substring({c}, -1, 1) >= '!' AND substring({c}, -1, 1) < '\x7f'"
STRIP_SQL = "CASE WHEN " + _PLAIN + " THEN {c} ELSE btrim({c}, '" + BLANKS + "') END"
CLEAN_SQL = "CASE WHEN " + _PLAIN + " THEN {c} ELSE nullif(btrim({c}, '" + BLANKS + "'), '') END"


def named(template: str, column: str) -> Column:
    """A SQL template applied to a column given by name."""
    return F.expr(template.format(c=f"`{column}`"))


def _plain_edges(c: Column) -> Column:
    last = F.substring(c, -1, 1)
    return (c >= "!") & (c < "\x7f") & (last >= "!") & (last < "\x7f")


def strip_blanks(c: Column | str) -> Column:
    """Strip all Unicode blanks."""
    if isinstance(c, str):
        return named(STRIP_SQL, c)
    return F.when(_plain_edges(c), c).otherwise(F.btrim(c, F.lit(BLANKS)))


def clean_text(c: Column | str) -> Column:
    """Strip all Unicode blanks; an empty text becomes NULL."""
    if isinstance(c, str):
        return named(CLEAN_SQL, c)
    return F.when(_plain_edges(c), c).otherwise(F.nullif(F.btrim(c, F.lit(BLANKS)), F.lit("")))


def sql_clean(c: Column | str) -> Column:
    """Strip spaces only (the SQL ``TRIM``); an empty text becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def upper_text(c: Column | str) -> Column:
    return F.upper(clean_text(c))


def coalesce_drift(*columns: Column | str) -> Column:
    """First non-empty value of columns that were renamed over the years."""
    return F.coalesce(*[clean_text(c) for c in columns])


def surrogate_natural_key(tax_id: Column | str, name: Column | str) -> Column:
    """The tax id, else a key made from the upper-case name, else NULL."""
    return F.coalesce(clean_text(tax_id), F.concat(F.lit(NAME_KEY_PREFIX), upper_text(name)))


def regime_code(code: Column | str, subcode: Column | str, name: Column | str | None = None) -> Column:
    """Catalogue name, else ``code-subcode`` when both exist, else NULL."""
    pair = F.concat(_col(code), F.lit("-"), _col(subcode))
    return pair if name is None else F.coalesce(F.nullif(_col(name), F.lit("")), pair)


def default_currency(c: Column | str | None = None) -> Column:
    """The source currency, else US dollars; without a source, always dollars."""
    return F.lit(DEFAULT_CURRENCY) if c is None else F.coalesce(clean_text(c), F.lit(DEFAULT_CURRENCY))


def resolve_or_fallback(name: Column | str, raw: Column | str | None, code: Column | str) -> Column:
    """Non-empty catalogue name, else the cleaned raw text, else the cleaned code."""
    options = [F.nullif(_col(name), F.lit(""))]
    if raw is not None:
        options.append(_col(raw))
    return F.coalesce(*options, _col(code))


def without_accents(text: str) -> str:
    split = unicodedata.normalize("NFKD", text)
    return "".join(ch for ch in split if not unicodedata.combining(ch))


def fold_text(text: str) -> str:
    """Accent-free, stripped, upper-case form of one text."""
    return without_accents(text).strip().upper()


@F.pandas_udf(T.StringType())
def _without_accents_batch(values: pd.Series) -> pd.Series:
    return values.map(without_accents, na_action="ignore")


@F.pandas_udf(T.StringType())
def _fold_batch(values: pd.Series) -> pd.Series:
    return values.map(fold_text, na_action="ignore")


def strip_accents(c: Column | str) -> Column:
    """Exact Unicode accent removal in Arrow batches. Apply it to distinct values."""
    return _without_accents_batch(_col(c))


def fold_accents(c: Column | str) -> Column:
    """Accent-free, stripped, upper case. Apply it to distinct values."""
    return _fold_batch(_col(c))
