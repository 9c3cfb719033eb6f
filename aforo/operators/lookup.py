"""Dictionary lookups: left joins that never drop or multiply a row.

A dictionary is broadcast only when its measured size is within a bound. A
larger one is joined by shuffle, where rows without a key are dealt evenly and
adaptive execution splits the partitions of keys that hold many rows. Either
way the left side is read once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aforo.contracts import FILE

BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 256 * 1024 * 1024
ROW_OVERHEAD = 64
# Rows without a key go to so many places of a shuffle.
SPREAD = 4_096


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    @property
    def small(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES


def _width(columns: list[str]) -> Column:
    lengths = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in columns]
    return reduce(lambda a, b: a + b, lengths) + F.lit(ROW_OVERHEAD)


def measure(df: DataFrame) -> Size:
    """Rows and approximate bytes of one frame."""
    row = df.agg(F.count(F.lit(1)), F.sum(_width(df.columns))).first()
    return Size(row[0], row[1] or 0)


def measure_by(df: DataFrame, key: str) -> dict[str, Size]:
    """The same for every value of a key known to be few (dimension names)."""
    rows = (
        df.groupBy(key).agg(F.count(F.lit(1)), F.sum(_width(df.columns))).collect()
    )
    return {row[0]: Size(row[1], row[2]) for row in rows}


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def within_budget(sizes: dict[str, Size], uses: dict[str, int]) -> set[str]:
    """The dictionaries to broadcast: the smallest first, as long as all of them together stay within the bound.

    ``uses`` says how many lookups take each; every one is a broadcast of its own.
    """
    chosen, rows, size = set(), 0, 0
    for name in sorted(uses, key=lambda n: (sizes.get(n, Size(0, 0)).bytes * uses[n], n)):
        own = sizes.get(name, Size(0, 0))
        rows, size = rows + own.rows * uses[name], size + own.bytes * uses[name]
        if not Size(rows, size).small:
            break
        chosen.add(name)
    return chosen


def lookup(
    left: DataFrame,
    dictionary: DataFrame,
    keys: dict[str, str],
    value: str,
    as_: str,
    *,
    small: bool,
    since: str | None = None,
    file: str = FILE,
    collation: str | None = None,
) -> DataFrame:
    """Add ``as_``: the dictionary's ``value`` for the left key, or NULL.

    ``keys`` maps left column to dictionary column; the dictionary holds one
    row per key. With ``since``, a dictionary row counts only for left rows
    whose file name is not before it. Under ``collation`` keys meet that it
    holds equal, and the dictionary has one row for each of these.
    """
    def met(c: Column) -> Column:
        return F.collate(c, collation) if collation else c

    renamed = {right: f"_{as_}_{i}" for i, right in enumerate(keys.values())}
    picked = [F.col(right).alias(new) for right, new in renamed.items()]
    if since:
        picked.append(F.col(since).alias(f"_{as_}_since"))
    right = dictionary.select(*picked, F.col(value).alias(as_))
    helpers = [c for c in right.columns if c != as_]
    match = [met(left[lk]) == met(F.col(renamed[rk])) for lk, rk in keys.items()]
    if since:
        match.append(F.col(f"_{as_}_since") <= F.col(file))
    if small:
        return left.join(F.broadcast(right), _all(match), "left").drop(*helpers)
    # A missing key meets nothing anyway, so any text may stand for it that is no key.
    first = next(iter(keys))
    place = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*left.columns), F.lit(SPREAD)).cast("string"))
    dealt = left.withColumn(f"_{as_}_place", F.coalesce(F.col(first).cast("string"), place))
    match[0] = met(F.col(f"_{as_}_place")) == met(F.col(renamed[keys[first]]).cast("string"))
    match.append(F.col(first).isNotNull())
    return dealt.join(right, _all(match), "left").drop(*helpers, f"_{as_}_place")


def first_per_iso2(countries: DataFrame) -> DataFrame:
    """One geography row per ISO2 code: the one with the lowest id."""
    payload = [c for c in countries.columns if c not in ("ISO2", "Id_DimPais")]
    return (
        countries.filter(F.col("ISO2").isNotNull())
        .groupBy(F.upper("ISO2").alias("ISO2"))
        .agg(F.min_by(F.struct("Id_DimPais", *payload), F.col("Id_DimPais")).alias("row"))
        .select("ISO2", "row.*")
    )


GEOGRAPHY = {
    "Continente": "continente",
    "Subcontinente": "subcontinente",
    "BloqueEconomico": "bloque_economico",
    "Region": "region",
}


def geo_enrich(facts: DataFrame, countries: DataFrame, iso2: str, role: str) -> DataFrame:
    """Add continent, subcontinent, bloc and region of the fact's country.

    Codes of facts are two capital letters, so the geography side is cut to
    such codes and cannot exceed 26 x 26 rows.
    """
    geography = (
        first_per_iso2(countries)
        .filter(F.col("ISO2").rlike("^[A-Z]{2}$"))
        .select(
            F.col("ISO2").alias("_iso2"),
            *[F.col(c).alias(f"{short}_{role}") for c, short in GEOGRAPHY.items()],
        )
    )
    return facts.join(
        F.broadcast(geography), F.upper(facts[iso2]) == F.col("_iso2"), "left"
    ).drop("_iso2")


def country_lookup(names: DataFrame, column: str, catalog: DataFrame) -> DataFrame:
    """(nombre, iso2) for the distinct spellings of a column that are countries.

    Spellings are folded once each, not once per row. The catalogue has a few
    hundred rows.
    """
    from aforo.functions.text import clean_text, fold_accents

    spellings = names.select(clean_text(column).alias("nombre")).dropna().distinct()
    folded = spellings.withColumn("_folded", fold_accents("nombre"))
    return folded.join(
        F.broadcast(catalog.select(F.col("nombre").alias("_catalog"), "iso2")),
        F.col("_folded") == F.col("_catalog"),
    ).select("nombre", "iso2")
