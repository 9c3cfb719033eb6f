"""Eight-digit dates and the calendar columns made from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aforo.functions.text import strip_blanks

# Spanish month names, in order.
MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)

DATE8 = "^(?!0000)[0-9]{8}$"


def parse_date8(c: Column | str) -> Column:
    """A valid ``YYYYMMDD`` after stripping, else NULL. Year 0000 is invalid."""
    text = strip_blanks(c)
    return F.when(text.rlike(DATE8), F.try_to_date(text, "yyyyMMdd"))


def first_valid_date(*columns: Column | str) -> Column:
    return F.coalesce(*[parse_date8(c) for c in columns])


def calendar_fields(date: Column | str) -> dict[str, Column]:
    """Year (0 when undated), quarter, month, month name and ``YYYY-MM``."""
    date = F.col(date) if isinstance(date, str) else date
    month = F.month(date)
    return {
        "anio": F.coalesce(F.year(date), F.lit(0)),
        "trimestre": F.quarter(date).cast("short"),
        "mes": month.cast("short"),
        "nombre_mes": F.when(
            month.isNotNull(), F.element_at(F.array(*[F.lit(m) for m in MONTHS]), month)
        ),
        "anio_mes": F.date_format(date, "yyyy-MM"),
    }
