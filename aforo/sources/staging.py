"""Rules for raw rows on their way into staging."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.contracts import FILE

# Fixed value: year and month name inside an archive name.
PERIOD = r"(\d{4})_([A-Za-z]+)"


def file_period(name: Column | str) -> dict[str, Column]:
    """Year and month name from an archive name, NULL when it has none."""
    name = F.col(name) if isinstance(name, str) else name
    year = F.nullif(F.regexp_extract(name, PERIOD, 1), F.lit(""))
    month = F.nullif(F.regexp_extract(name, PERIOD, 2), F.lit(""))
    return {"anio_proceso": year.try_cast("int"), "mes_proceso": month}


def stamp_lineage(df: DataFrame, loaded_at: datetime) -> DataFrame:
    """Add year, month and one load time; ``archivo_origen`` is already there."""
    return df.select(
        *[c for c in df.columns if c != FILE],
        *[c.alias(n) for n, c in file_period(FILE).items()],
        F.col(FILE), F.lit(loaded_at).cast("timestamp").alias("fecha_carga"),
    )


def finite(df: DataFrame) -> DataFrame:
    """NaN and infinities of floating-point columns become NULL."""
    def fix(field):
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            c = F.col(field.name)
            return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c).alias(field.name)
        return F.col(field.name)

    return df.select(*[fix(f) for f in df.schema])


def _falsy(field: T.StructField) -> Column:
    c = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return c.isNull() | (c == "")
    if isinstance(field.dataType, T.BooleanType):
        return c.isNull() | ~c
    if isinstance(field.dataType, T.NumericType):
        return c.isNull() | (c == 0)
    return c.isNull()


def drop_blank_rows(df: DataFrame, *columns: str) -> DataFrame:
    """Leave out rows whose cells are all NULL, empty, zero or false."""
    fields = [f for f in df.schema if not columns or f.name in columns]
    return df.filter(~reduce(lambda a, b: a & b, [_falsy(f) for f in fields]))
