"""Tariff code prefixes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HS_LEVELS = (2, 4, 6, 8)


def hs_chapter(code: Column | str) -> Column:
    """First two characters of a cleaned code of at least two, else NULL."""
    code = F.col(code) if isinstance(code, str) else code
    return F.when(F.length(code) >= 2, F.left(code, F.lit(2)))


def hs_levels(code: Column | str) -> dict[str, Column]:
    code = F.col(code) if isinstance(code, str) else code
    return {f"hs{n}": F.left(code, F.lit(n)) for n in HS_LEVELS}
