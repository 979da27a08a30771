"""Long to wide and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.functions.cells import present
from airloom.functions.names import pollutant_name
from airloom.session import lookup_table

# Variable names of the two gridded sources.
AEROSOL_VARIABLES = [
    "Aerosol_Optical_Thickness_550_Land_Mean",
    "Aerosol_Optical_Thickness_550_Ocean_Mean",
    "Aerosol_Optical_Thickness_550_Ocean_Standard_Deviation",
]
WEATHER_VARIABLES = [
    "10 metre U wind component",
    "10 metre V wind component",
    "2 metre temperature",
    "Surface pressure",
    "Total cloud cover",
    "Total precipitation",
    "2 metre dewpoint temperature",
    "Boundary layer height",
    "Forecast surface roughness",
]


def crosstab(
    df: DataFrame,
    keys: Sequence[str],
    variables: Sequence[str] | Mapping[str, str],
    variable: str = "variable",
    value: str = "value",
) -> DataFrame:
    """One column per listed variable, in list order; others ignored, absent ones null.

    A mapping gives output names. Of several values the largest is kept. One shuffle, with
    map-side partial aggregation.
    """
    names = dict(variables) if isinstance(variables, Mapping) else {v: v for v in variables}
    cells = [
        F.max(F.when(F.col(variable) == v, present(df, value))).alias(name)
        for v, name in names.items()
    ]
    return df.groupBy(*keys).agg(*cells)


def unpivot_stations(
    df: DataFrame,
    date: str = "date",
    separator: str = "|",
) -> DataFrame:
    """Monitoring matrix with ``station|pollutant`` columns to long rows.

    A column whose name has no separator belongs to the named header before it, as under a
    merged header cell; its own name is the pollutant.
    """
    owners, owner = {}, None
    for name in df.columns:
        if name == date:
            continue
        if separator in name:
            owner, pollutant = name.split(separator, 1)
        else:
            pollutant = name
        owners[name] = (owner, pollutant)
    # Names go along as literals, normalised once, so a row costs its cells and no lookups.
    cells = [
        F.struct(
            F.lit(station).cast("string").alias("station"),
            pollutant_name(F.lit(pollutant)).alias("pollutant"),
            F.col(f"`{c}`").cast("string").alias("value"),
        )
        for c, (station, pollutant) in owners.items()
    ]
    return df.select(date, F.inline(F.array(*cells))).select("station", date, "pollutant", "value")


def drop_flat_series(
    df: DataFrame, group: Sequence[str] = ("station", "pollutant"), value: str = "value"
) -> DataFrame:
    """Keep series with at least two distinct values, which also drops all-missing ones."""
    varied = (
        df.groupBy(*group)
        .agg(F.min(present(df, value)).alias("low"), F.max(present(df, value)).alias("high"))
        .where("low < high")
        .select(*group)
    )
    return df.join(lookup_table(varied, "varied"), list(group), "left_semi")


def melt(df: DataFrame, keys: Sequence[str], names: str = "Metric", values: str = "Value") -> DataFrame:
    """Every column but ``keys`` as a row of name and value."""
    rest = [c for c in df.columns if c not in keys]
    wide = df.select(*keys, *[F.col(f"`{c}`").cast(T.DoubleType()).alias(c) for c in rest])
    return wide.unpivot(list(keys), rest, names, values)
