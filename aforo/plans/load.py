"""Loads: pending staged files to members, facts, control state and outbox.

Everything of one load runs in one pass over all its files. A load notes each
step when it is done, so one that broke off is finished by the next load, from
the step after its last note: the outcome is that of a load never disturbed.
"""

from __future__ import annotations

import hashlib
import json
import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aforo.contracts import FILE, FLOWS, Flow
from aforo.operators.members import insert_ignore
from aforo.plans.control import (
    DIMENSIONS_PHASE,
    ERROR,
    EVENT_SCHEMA,
    FACTS_PHASE,
    control_error,
    control_start,
    control_state,
    control_success,
    ordered_pending,
    outbox_rows,
    rows_per_file,
)
from aforo.plans.dimensions import MEMBER_SCHEMA, RULES, candidate_members, new_members, seed_members
from aforo.plans.extracts import by_file
from aforo.plans.facts import SINCE, Dictionaries, build_fact
from aforo.session import delete, release_shuffles
from aforo.sinks.tables import (
    append, assign_row_ids, drop_files, read_table, replace_by_file, stored_files, stored_parts, with_position,
)

LOG = logging.getLogger(__name__)
MARK_SCHEMA = "proceso string, ultimo_id_procesado long, registros_totales long, fecha_actualizacion timestamp"
OUTBOX_SCHEMA = (
    "pais string, tipo_intercambio string, procedimiento_almacenado string, archivo string, anio int, estado string, "
    "detalle string, fecha timestamp, fecha_actualizacion timestamp"
)
#: The steps of a load in order; PLANNED comes before them and ABANDONED ends a load that cannot go on.
PLANNED, FACTS, MEMBERS, OUTBOX, DONE, PURGED, ABANDONED = (
    "PLAN", "HECHOS", "MIEMBROS", "ANUNCIO", "SUCCESS", "PURGA", "ABANDONO")
JOURNAL_SCHEMA = (
    f"carga string, tabla_origen string, paso string, archivos array<string>, ultimo_id long, firma string, "
    "seq long, fecha timestamp"
)
#: Failed files that a batch tries again, and how often one may fail.
RETRIED_FILES, MOST_FAILURES = 20, 5


def _now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass
class Warehouse:
    """Table paths below one root folder."""

    spark: SparkSession
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def staging(self, flow: Flow) -> DataFrame:
        if not stored_files(self.spark, self.path(flow.staging)):
            return self.spark.createDataFrame([], T.StructType([T.StructField(FILE, T.StringType())]))
        return read_table(self.spark, self.path(flow.staging))

    def facts(self, flow: Flow) -> DataFrame:
        return read_table(self.spark, self.path(flow.fact), flow.stored_fact_schema)

    def members(self) -> DataFrame:
        return read_table(self.spark, self.path("miembros"), MEMBER_SCHEMA)

    def events(self) -> DataFrame:
        return read_table(self.spark, self.path("etl_control_carga"), EVENT_SCHEMA)

    def control(self) -> DataFrame:
        return control_state(self.events())

    def outbox(self) -> DataFrame:
        return read_table(self.spark, self.path("cola_indexacion"), OUTBOX_SCHEMA)

    def journal(self) -> DataFrame:
        return read_table(self.spark, self.path("etl_cargas"), JOURNAL_SCHEMA)

    def record(self, events: DataFrame) -> None:
        append(events, self.path("etl_control_carga"))

    def last_id(self, flow: Flow) -> int:
        marks = read_table(self.spark, self.path("etl_checkpoint"), MARK_SCHEMA)
        row = marks.filter(F.col("proceso") == flow.fact).agg(F.max("ultimo_id_procesado")).first()
        return row[0] or 0

    def pending(self, flow: Flow) -> list[str]:
        """Names of the staged files to load; one per month, so a short list."""
        frame = ordered_pending(self.staging(flow), self.control(), flow.staging)
        return [r[0] for r in frame.collect()]


def _seq() -> int:
    return time.time_ns()


def seeded_members(wh: Warehouse) -> DataFrame:
    """The stored members; the catch-all members go into an empty table first."""
    if wh.members().isEmpty():
        append(seed_members(wh.spark), wh.path("miembros"), "dim")
    return wh.members()


@dataclass
class Load:
    """A load as it was planned: its files as staged then, the id before its first row, its time."""

    name: str
    flow: Flow
    files: list[str]
    last_id: int
    signature: str
    at: datetime
    done: set[str] = field(default_factory=set)

    def members_path(self, wh: Warehouse) -> str:
        return wh.path(f"cargas/{self.name}")

    def is_staged(self, wh: Warehouse) -> bool:
        return staged_signature(wh, self.flow, self.files) == self.signature

    def note(self, wh: Warehouse, step: str) -> None:
        """Write down that ``step`` is done."""
        row = (self.name, self.flow.staging, step, self.files, self.last_id, self.signature, _seq(), self.at)
        append(wh.spark.createDataFrame([row], JOURNAL_SCHEMA), wh.path("etl_cargas"))
        self.done.add(step)


def staged_signature(wh: Warehouse, flow: Flow, files: list[str]) -> str:
    """Which part files hold these files; staging a file anew changes it."""
    parts = stored_parts(wh.spark, wh.path(flow.staging), files)
    return hashlib.sha256(json.dumps(parts, sort_keys=True).encode()).hexdigest()


def plan_load(wh: Warehouse, flow: Flow, files: list[str]) -> Load:
    """Start a load: its new members with their ids are stored before anything is changed."""
    load = Load(uuid.uuid4().hex, flow, sorted(files), wh.last_id(flow), staged_signature(wh, flow, files), _now())
    names = wh.spark.createDataFrame([(f,) for f in load.files], f"{FILE} string")
    for phase in (DIMENSIONS_PHASE, FACTS_PHASE):
        wh.record(control_start(names, flow.staging, phase, _seq(), load.at))
    candidates = candidate_members(by_file(wh.staging(flow), *load.files), first_file_wins=True)
    new_members(candidates, seeded_members(wh)).write.parquet(load.members_path(wh))
    release_shuffles(wh.spark)
    load.note(wh, PLANNED)
    return load


def _fresh_members(wh: Warehouse, load: Load) -> DataFrame:
    return wh.spark.read.schema(f"{MEMBER_SCHEMA}, {SINCE} string").parquet(load.members_path(wh))


def _write_facts(wh: Warehouse, load: Load) -> None:
    """The facts of the load's files in place of the stored ones; a file without rows loses its facts."""
    known = wh.members().withColumn(SINCE, F.lit("")).unionByName(_fresh_members(wh, load))
    # The planned id, so that writing again hands out the same numbers.
    numbered = assign_row_ids(with_position(by_file(wh.staging(load.flow), *load.files)), load.last_id)
    facts = build_fact(numbered, Dictionaries(known), load.flow, keep=("id",)).select(
        "id", *[n for n, _ in load.flow.fact_columns], F.lit(load.at).cast("timestamp").alias("fecha_carga_dw")
    )
    replace_by_file(facts, wh.path(load.flow.fact), files=load.files)


def _add_members(wh: Warehouse, load: Load) -> None:
    fresh = _fresh_members(wh, load).drop(SINCE)
    append(insert_ignore(fresh, wh.members()), wh.path("miembros"), "dim")


def _announce(wh: Warehouse, load: Load) -> None:
    """One outbox row per file; the load's time tells those it has already written."""
    rows = outbox_rows(by_file(wh.facts(load.flow), *load.files), load.flow, load.at)
    written = wh.outbox().select("archivo", "fecha", "tipo_intercambio")
    append(rows.join(written, ["archivo", "fecha", "tipo_intercambio"], "left_anti").select(rows.columns), wh.path("cola_indexacion"))


def _succeed(wh: Warehouse, load: Load) -> None:
    """High-water mark first, SUCCESS last: what is repeated after a stop in between changes no state."""
    names = wh.spark.createDataFrame([(f,) for f in load.files], f"{FILE} string")
    written = by_file(wh.facts(load.flow), *load.files)
    counts = names.join(rows_per_file(written), FILE, "left").withColumn(
        "registros", F.coalesce("registros", F.lit(0))
    ).checkpoint()
    _mark(wh, load, counts.agg(F.sum("registros")).first()[0] or 0)
    seconds = (_now() - load.at).total_seconds()
    wh.record(control_success(names, load.flow.staging, DIMENSIONS_PHASE, _seq(), _now(), F.lit(len(RULES)), seconds))
    wh.record(control_success(counts, load.flow.staging, FACTS_PHASE, _seq(), _now(), F.col("registros"), seconds))


def _mark(wh: Warehouse, load: Load, rows: int) -> None:
    append(wh.spark.createDataFrame([(load.flow.fact, load.last_id + rows, rows, _now())], MARK_SCHEMA), wh.path("etl_checkpoint"))


def _purge(wh: Warehouse, load: Load) -> None:
    """The raw rows go, unless the files have been staged anew meanwhile."""
    if load.is_staged(wh):
        drop_files(wh.spark, wh.path(load.flow.staging), load.files)
    delete(wh.spark, load.members_path(wh))


STEPS: dict[str, Callable[[Warehouse, Load], None]] = {
    FACTS: _write_facts, MEMBERS: _add_members, OUTBOX: _announce, DONE: _succeed, PURGED: _purge,
}


def run_load(wh: Warehouse, load: Load) -> None:
    """The steps of a load that are not done yet, each noted when it is."""
    for step, run in STEPS.items():
        if step not in load.done:
            run(wh, load)
            load.note(wh, step)


def abandon(wh: Warehouse, load: Load) -> None:
    """Give a load up. Its ids are not handed out again, since some of its facts may be stored."""
    if load.is_staged(wh):
        _mark(wh, load, by_file(wh.staging(load.flow), *load.files).count())
    delete(wh.spark, load.members_path(wh))
    load.note(wh, ABANDONED)


def open_loads(wh: Warehouse, flow: Flow) -> list[Load]:
    """Loads that broke off, oldest first; there is one at most for each broken run."""
    steps = wh.journal().where(F.col("tabla_origen") == flow.staging).groupBy("carga").agg(
        F.collect_set("paso").alias("pasos"), F.min("seq").alias("seq"), F.any_value("archivos").alias("archivos"),
        F.any_value("ultimo_id").alias("ultimo_id"), F.any_value("firma").alias("firma"), F.min("fecha").alias("fecha"))
    left = steps.where(~F.array_contains("pasos", PURGED) & ~F.array_contains("pasos", ABANDONED))
    # Seconds since 1970 carry the time over the driver's own time zone unchanged.
    rows = left.orderBy("seq").withColumn("t", F.unix_micros("fecha")).collect()
    return [
        Load(r.carga, flow, list(r.archivos), r.ultimo_id, r.firma, datetime.fromtimestamp(r.t / 1e6, timezone.utc), set(r.pasos))
        for r in rows
    ]


def resume(wh: Warehouse, flow: Flow) -> dict[str, str]:
    """Finish the loads that broke off; returns the state of their files.

    A load whose files were staged anew before its SUCCESS is given up: the
    files are pending and are loaded as they are now.
    """
    states: dict[str, str] = {}
    for load in open_loads(wh, flow):
        if DONE not in load.done and not load.is_staged(wh):
            abandon(wh, load)
            continue
        try:
            run_load(wh, load)
            states |= dict.fromkeys(load.files, "SUCCESS")
        except Exception:
            LOG.exception("finishing a load of %d files of %s failed, they are loaded anew", len(load.files), flow.staging)
            abandon(wh, load)
    return states


def load_files(wh: Warehouse, flow: Flow, files: list[str]) -> None:
    """Members, facts, control and outbox of the named staged files."""
    load = plan_load(wh, flow, files)
    try:
        run_load(wh, load)
    except Exception:
        abandon(wh, load)
        raise


def failed_files(wh: Warehouse, flow: Flow, most: int = RETRIED_FILES, failures: int = MOST_FAILURES) -> list[str]:
    """Staged files whose last load failed, those that wait longest first; one that fails too often waits for ``force``."""
    of_facts = (F.col("tabla_origen") == flow.staging) & (F.col("fase") == FACTS_PHASE)
    tries = wh.events().where(of_facts & (F.col("estado") == ERROR)).groupBy(FILE).agg(F.count(F.lit(1)).alias("n"))
    failed = wh.control().where(of_facts & (F.col("estado") == ERROR)).join(tries.where(F.col("n") < failures), FILE)
    staged = wh.spark.createDataFrame([(f,) for f in stored_files(wh.spark, wh.path(flow.staging))], f"{FILE} string")
    return [r[0] for r in failed.join(staged, FILE, "left_semi").orderBy("fecha_fin", FILE).limit(most).select(FILE).collect()]


def load_pending(wh: Warehouse, flow: Flow, force: list[str] = ()) -> dict[str, str]:
    """Load what is pending, plus ``force``; returns the state of each file.

    Loads that broke off are finished first. All other files go through one
    plan. If that fails, the cause is logged and each is loaded on its own, so
    that a bad file is marked ERROR and does not stop the others. Forced files
    must be staged.
    """
    if force:
        _check_staged(wh, flow, force)
    states = resume(wh, flow)
    files = sorted({*wh.pending(flow), *(f for f in force if f not in states)})
    return states | load_each(wh, flow, files)


def _check_staged(wh: Warehouse, flow: Flow, files: list[str]) -> None:
    unknown = sorted(set(files).difference(stored_files(wh.spark, wh.path(flow.staging))))
    if unknown:
        raise ValueError(f"not staged: {', '.join(unknown)}")


def load_each(wh: Warehouse, flow: Flow, files: list[str]) -> dict[str, str]:
    """Load these staged files and no others; returns the state of each. None of them may belong to a load that broke off."""
    if not files:
        return {}
    try:
        load_files(wh, flow, files)
        return dict.fromkeys(files, "SUCCESS")
    except Exception:
        LOG.exception("loading %d files of %s together failed, each is tried alone", len(files), flow.staging)
        states = {}
        for file in files:
            try:
                load_files(wh, flow, [file])
                states[file] = "SUCCESS"
            except Exception as problem:
                name = wh.spark.createDataFrame([(file,)], f"{FILE} string")
                for phase in (DIMENSIONS_PHASE, FACTS_PHASE):
                    wh.record(control_error(name, flow.staging, phase, _seq(), _now(), str(problem)))
                states[file] = "ERROR"
        return states


def load_all(wh: Warehouse) -> dict[str, str]:
    """Imports first, then exports, which use the members imports brought."""
    states: dict[str, str] = {}
    for flow in FLOWS:
        states |= load_pending(wh, flow)
    return states
