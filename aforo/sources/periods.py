"""Which monthly archives should exist, and what happened to the attempts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aforo.contracts import FLOWS
from aforo.functions.dates import MONTHS

SUCCESS = "SUCCESS"
SAMPLED = ("NOT_FOUND", "SKIPPED")


def expected_periods(spark: SparkSession, start_year: int, as_of: date, limit_months: int | None = None) -> DataFrame:
    """Every month and flow from ``as_of`` back to January of ``start_year``."""
    first, last = f"date'{start_year}-01-01'", f"date'{as_of:%Y-%m-01}'"
    months = spark.range(1).select(
        F.explode(F.expr(f"sequence({last}, {first}, interval -1 month)")).alias("month")
    )
    if limit_months:
        months = months.orderBy(F.desc("month")).limit(limit_months)
    flows = F.array(*[F.struct(F.lit(f.name).alias("flow"), F.lit(f.word).alias("word")) for f in FLOWS])
    number = F.lpad(F.month("month").cast("string"), 2, "0")
    name = F.element_at(F.array(*[F.lit(m) for m in MONTHS]), F.month("month"))
    year = F.year("month")
    return months.withColumn("f", F.explode(flows)).select(
        year.alias("anio"), F.month("month").alias("mes"), name.alias("nombre_mes"),
        F.col("f.flow").alias("flujo"),
        F.concat_ws("_", number, F.col("f.word"), year.cast("string"), F.concat(name, F.lit(".zip"))).alias("archivo"),
    )


def period_gaps(
    ledger: DataFrame, start_year: int, as_of: date, limit_months: int | None = None
) -> DataFrame:
    """Expected archives without a SUCCESS in the ledger, newest first."""
    done = ledger.filter(F.col("status") == SUCCESS).select("archivo").distinct()
    expected = expected_periods(ledger.sparkSession, start_year, as_of, limit_months)
    return expected.join(done, "archivo", "left_anti").orderBy(F.desc("anio"), F.desc("mes"), F.desc("flujo"))


def ledger_latest(attempts: DataFrame, key: str, order: str) -> DataFrame:
    """The last attempt of every key; ``order`` tells the attempts of a key apart.

    The last one is found by a hash aggregation of ``order`` alone, and its
    other columns by a join back.
    """
    last = attempts.groupBy(F.col(key).alias("_key")).agg(F.max(order).alias("_order"))
    met = F.col(key).eqNullSafe(F.col("_key")) & F.col(order).eqNullSafe(F.col("_order"))
    return attempts.join(last, met, "left_semi").select(key, *[c for c in attempts.columns if c != key])


def run_summary(attempts: DataFrame, status: str = "status") -> DataFrame:
    return attempts.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def status_sample(
    attempts: DataFrame, *order: str, status: str = "status", groups: tuple[str, ...] = SAMPLED, n: int = 5
) -> DataFrame:
    """The last ``n`` attempts of the sampled states (a top-n report)."""
    newest = Window.partitionBy(status).orderBy(*[F.desc(c) for c in order])
    return (
        attempts.filter(F.col(status).isin(list(groups)))
        .withColumn("posicion", F.row_number().over(newest)).filter(F.col("posicion") <= n)
    )
