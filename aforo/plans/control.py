"""Load control: an append-only event log folded to the current state per key."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aforo.contracts import FILE, Flow

STARTED, SUCCESS, ERROR = "EN_PROCESO", "SUCCESS", "ERROR"
STATES = (STARTED, ERROR, SUCCESS)
DIMENSIONS_PHASE, FACTS_PHASE = "DIMENSIONES", "HECHOS"
CONTROL_KEY = ["tabla_origen", FILE, "fase"]
MAX_MESSAGE = 60_000
EVENT_SCHEMA = (
    f"tabla_origen string, {FILE} string, fase string, estado string, seq long, fecha timestamp, "
    "registros long, segundos decimal(10,2), mensaje string"
)


def _events(files: DataFrame, table: str, phase: str, state: str, seq: int, at: datetime, **values) -> DataFrame:
    null = {"registros": "long", "segundos": "decimal(10,2)", "mensaje": "string"}
    return files.select(
        F.lit(table).alias("tabla_origen"), F.col(FILE), F.lit(phase).alias("fase"),
        F.lit(state).alias("estado"), F.lit(seq).cast("long").alias("seq"),
        F.lit(at).cast("timestamp").alias("fecha"),
        *[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in null.items()],
    )


def control_start(files: DataFrame, table: str, phase: str, seq: int, at: datetime) -> DataFrame:
    return _events(files, table, phase, STARTED, seq, at)


def control_success(
    files: DataFrame, table: str, phase: str, seq: int, at: datetime, rows: Column, seconds: float
) -> DataFrame:
    return _events(files, table, phase, SUCCESS, seq, at, registros=rows, segundos=F.lit(round(seconds, 2)))


def control_error(files: DataFrame, table: str, phase: str, seq: int, at: datetime, message: str) -> DataFrame:
    return _events(files, table, phase, ERROR, seq, at, mensaje=F.left(F.lit(message), F.lit(MAX_MESSAGE)))


def control_state(events: DataFrame) -> DataFrame:
    """Current row per (table, file, phase).

    A start clears end time and message and keeps the old row count and
    seconds; a success or an error before any start changes nothing.

    The log is folded by hash aggregations of numbers and moments; texts are
    fetched by a join back for the few events that count. ``seq`` tells the
    events of a key apart; of equal ones the later in the order of states counts.
    """
    code = F.element_at(F.create_map(*[x for k, s in enumerate(STATES) for x in (F.lit(s), F.lit(k))]), F.col("estado"))

    def last(state: str | None = None) -> Column:
        return F.max(F.when(F.col("estado") == state, F.col("seq")) if state else F.col("seq"))

    ended = F.max(F.when(F.col("estado") != STARTED, F.col("seq")))
    folded = events.groupBy(*CONTROL_KEY).agg(
        F.min(F.when(F.col("estado") == STARTED, F.col("seq"))).alias("_first"), last(STARTED).alias("_start"), ended.alias("_end"),
        last(SUCCESS).alias("_success"), last(ERROR).alias("_error"), last().alias("_last"),
    ).where("_first IS NOT NULL")
    keys = {k: f"_k_{k}" for k in CONTROL_KEY}
    marks = folded.select(*[F.col(k).alias(n) for k, n in keys.items()], *[c for c in folded.columns if c not in CONTROL_KEY])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in keys.items()])
    counts = F.col("seq").isin(*[F.col(c) for c in ("_start", "_end", "_success", "_error", "_last")])
    told = events.join(marks, same & counts)

    def at(mark: str, column: str | Column, when: Column | None = None) -> Column:
        return F.max(F.when((F.col("seq") == F.col(mark)) & (F.lit(True) if when is None else when), column))

    is_success, is_error = F.col("estado") == SUCCESS, F.col("estado") == ERROR
    values = told.groupBy(*CONTROL_KEY).agg(
        at("_last", code).alias("_code"), at("_start", F.col("fecha"), F.col("estado") == STARTED).alias("_started"),
        at("_end", F.col("fecha"), F.col("estado") != STARTED).alias("_ended"),
        at("_success", F.col("registros"), is_success).alias("_rows"), at("_success", F.col("segundos"), is_success).alias("_seconds"),
        *[F.max(c).alias(c) for c in ("_first", "_start", "_end", "_success", "_error")],
    )
    messages = told.where(is_error & (F.col("seq") == F.col("_error"))).select(
        *[F.col(k).alias(n) for k, n in keys.items()], F.left("mensaje", F.lit(MAX_MESSAGE)).alias("_message"))
    counted = F.col("_success") > F.col("_first")
    return values.join(messages, same, "left").select(
        *CONTROL_KEY,
        F.element_at(F.array(*map(F.lit, STATES)), F.col("_code") + 1).alias("estado"),
        F.when(counted, F.col("_rows")).alias("registros_procesados"),
        F.col("_started").alias("fecha_inicio"),
        F.when(F.col("_end") > F.col("_start"), F.col("_ended")).alias("fecha_fin"),
        F.when(counted, F.col("_seconds")).alias("tiempo_ejecucion_seg"),
        F.when(F.col("_error") > F.col("_start"), F.col("_message")).alias("mensaje_error"),
    )


def pending_files(staged: DataFrame, state: DataFrame, table: str, phase: str = FACTS_PHASE) -> DataFrame:
    """Staged files without SUCCESS for this table and phase."""
    done = state.filter(
        (F.col("tabla_origen") == table) & (F.col("fase") == phase) & (F.col("estado") == SUCCESS)
    ).select(FILE)
    return staged.select(FILE).filter(F.col(FILE).isNotNull()).distinct().join(done, FILE, "left_anti")


def ordered_pending(staged: DataFrame, state: DataFrame, table: str, phase: str = FACTS_PHASE) -> DataFrame:
    return pending_files(staged, state, table, phase).orderBy(FILE)


def is_empty_probe(df: DataFrame) -> bool:
    return df.isEmpty()


def rows_per_file(df: DataFrame) -> DataFrame:
    return df.groupBy(FILE).agg(F.count(F.lit(1)).alias("registros"))


def predominant_year(facts: DataFrame) -> DataFrame:
    """Year with most rows in each file; 0 counts; a tie goes to the smaller year."""
    votes = facts.groupBy(FILE, "anio").agg(F.count(F.lit(1)).alias("n"))
    return votes.groupBy(FILE).agg(F.max_by("anio", F.struct(F.col("n"), -F.col("anio"))).alias("anio"))


def top1_by_count(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value; a tie goes to the smaller one."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column)).limit(1)
    )


# Fixed values of an outbox row.
COUNTRY_NAME, PENDING = "colombia", "PENDIENTE"


def outbox_rows(facts: DataFrame, flow: Flow, at: datetime) -> DataFrame:
    """One PENDIENTE row per file of ``facts``."""
    now = F.lit(at).cast("timestamp")
    return predominant_year(facts).select(
        F.lit(COUNTRY_NAME).alias("pais"),
        F.lit(flow.exchange_type).alias("tipo_intercambio"),
        F.lit(flow.extract).alias("procedimiento_almacenado"),
        F.col(FILE).alias("archivo"),
        F.col("anio"),
        F.lit(PENDING).alias("estado"),
        F.lit("").alias("detalle"),
        now.alias("fecha"),
        now.alias("fecha_actualizacion"),
    )


def empty_events(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], EVENT_SCHEMA)
