"""Row and cell rules of the monitoring table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions.cells import present
from airloom.session import lookup_table

# How far coarse may exceed fine particles, and NOX the sum of its parts; empty
# cells a row may have.
PM_FACTOR = 10
NOX_FACTOR = 2
ALLOWED_EMPTY = 3


def measured_at(
    df: DataFrame,
    has: Sequence[str] = ("PM10",),
    lacks: Sequence[str] = ("PM2.5",),
    station: str = "station",
) -> DataFrame:
    """Rows of the stations that measure every pollutant in ``has`` and none in ``lacks``."""
    counts = [F.count(present(df, c)).alias(f"h{i}") for i, c in enumerate(has)]
    counts += [F.count(present(df, c)).alias(f"l{i}") for i, c in enumerate(lacks)]
    fits = F.lit(True)
    for i in range(len(has)):
        fits = fits & (F.col(f"h{i}") > 0)
    for i in range(len(lacks)):
        fits = fits & (F.col(f"l{i}") == 0)
    chosen = df.groupBy(station).agg(*counts).where(fits).select(station)
    return df.join(lookup_table(chosen, "chosen"), station, "left_semi")


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("all", subset=list(columns) if columns else None)


def drop_incomplete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(columns) if columns else None)


def keep_filled_rows(df: DataFrame, allowed_empty: int = ALLOWED_EMPTY) -> DataFrame:
    """Rows with at most ``allowed_empty`` empty cells."""
    return df.na.drop(thresh=len(df.columns) - allowed_empty)


def particles_agree(coarse: Column, fine: Column) -> Column:
    return (coarse >= fine) & (coarse <= fine * PM_FACTOR)


def nitrogen_agrees(no2: Column, no: Column, nox: Column) -> Column:
    return (no2 + no <= nox) & (nox <= (no2 + no) * NOX_FACTOR)


def drop_particle_conflicts(df: DataFrame, coarse: str, fine: str) -> DataFrame:
    """Rows whose fine particles exceed coarse ones, or fall below a tenth, are dropped, as
    are rows that lack one of the two."""
    return df.where(particles_agree(F.col(f"`{coarse}`"), F.col(f"`{fine}`")))


def drop_nitrogen_conflicts(df: DataFrame, no2: str, no: str, nox: str) -> DataFrame:
    """Rows whose NOX is below the sum of its parts or above twice that are dropped."""
    return df.where(nitrogen_agrees(F.col(no2), F.col(no), F.col(nox)))


def _blank_unless(df: DataFrame, agrees: Column, columns: Sequence[str]) -> DataFrame:
    """Columns nulled where the rule fails; a rule over missing cells cannot fail."""
    kept = F.coalesce(agrees, F.lit(True))
    blanked = {c: F.when(kept, F.col(f"`{c}`")) for c in columns}
    return df.select(
        *[blanked[c].alias(c) if c in blanked else F.col(f"`{c}`") for c in df.columns]
    )


def blank_particle_conflicts(df: DataFrame, coarse: str, fine: str) -> DataFrame:
    rule = particles_agree(F.col(f"`{coarse}`"), F.col(f"`{fine}`"))
    return _blank_unless(df, rule, [coarse, fine])


def blank_nitrogen_conflicts(df: DataFrame, no2: str, no: str, nox: str) -> DataFrame:
    rule = nitrogen_agrees(F.col(no2), F.col(no), F.col(nox))
    return _blank_unless(df, rule, [no2, no, nox])
