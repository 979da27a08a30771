"""Joins and column layout of the station table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.functions.names import lookup_key
from airloom.session import lookup_table

# Columns dropped on the way, columns that lead the table, calendar columns.
OCEAN_COLUMNS = [
    "Aerosol_Optical_Thickness_550_Ocean_Mean",
    "Aerosol_Optical_Thickness_550_Ocean_Standard_Deviation",
]
OTHER_POLLUTANTS = ["O3", "SO2", "NOX", "NO", "NO2", "CO"]
DATE_COLUMNS = ["date", "Year", "Month", "Day"]
LEADING_POLLUTANTS = ["PM10"]
CALENDAR_COLUMNS = ["Year", "Month", "Day", "COVID - 19"]


def rename_if_present(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new) if old in df.columns else df


def drop_if_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in names if c in df.columns])


def order_columns(
    df: DataFrame,
    dates: Sequence[str] = DATE_COLUMNS,
    pollutants: Sequence[str] = LEADING_POLLUTANTS,
) -> DataFrame:
    """Date columns, then pollutants, then the rest; only those that exist."""
    leading = [c for c in [*dates, *pollutants] if c in df.columns]
    return df.select(*[f"`{c}`" for c in leading + [c for c in df.columns if c not in leading]])


def drop_calendar(df: DataFrame) -> DataFrame:
    """Calendar indicators never reach the models: made into dummies and dropped again."""
    return drop_if_present(df, CALENDAR_COLUMNS)


def feature_names(df: DataFrame, target: str, excluded: Sequence[str] = ("date",)) -> list[str]:
    return [c for c in df.columns if c != target and c not in excluded]


def _suffix_clashes(left: DataFrame, right: DataFrame, on: Sequence[str]):
    """Columns on both sides besides the keys get _x on the left and _y on the right."""
    clash = (set(left.columns) & set(right.columns)) - set(on)
    return (
        left.withColumnsRenamed({c: f"{c}_x" for c in clash}),
        right.withColumnsRenamed({c: f"{c}_y" for c in clash}),
    )


def left_merge(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join on equal keys; several matches on the right repeat the left row."""
    left, right = _suffix_clashes(left, right, on)
    return left.join(right, list(on), "left")


def in_every_source(df: DataFrame, *sources: DataFrame, key: str = "station") -> DataFrame:
    """Rows of the stations that occur in all sources."""
    for source in sources:
        df = df.join(lookup_table(source.select(key).distinct(), "stations"), key, "left_semi")
    return df


def merge_sources(
    monitoring: DataFrame,
    weather: DataFrame,
    aerosol: DataFrame,
    calendar: DataFrame,
    key: str = "station",
    date: str = "date",
) -> DataFrame:
    """Monitoring rows with weather, aerosol and calendar columns of their station and day.

    A station missing from weather or aerosol is left out whole. The three daily tables
    join on one key pair, so their shuffles line up.
    """
    kept = in_every_source(monitoring, aerosol, weather, key=key)
    merged = left_merge(kept, weather, [key, date])
    merged = left_merge(merged, aerosol, [key, date])
    merged, calendar = _suffix_clashes(merged, calendar, [date])
    return merged.join(lookup_table(calendar, "calendar"), [date], "left")


def dedup_dimension(
    df: DataFrame, keys: Sequence[str], order: str, keep: str = "first"
) -> DataFrame:
    """One row per key: the first or last by ``order``. Partially aggregated, no window."""
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by if keep == "first" else F.max_by
    return (
        df.groupBy(*keys)
        .agg(pick(F.struct(*rest), F.struct(order, *rest)).alias("__kept"))
        .select(*keys, "__kept.*")
    )


def add_coordinates(
    df: DataFrame, dimension: DataFrame, order: str, station: str = "station"
) -> DataFrame:
    """Longitude and Latitude by normalised name; unmatched stations are dropped.

    ``order`` says which dimension row is first where names repeat.
    """
    keyed = dimension.select(
        lookup_key(F.col("station")).alias("__key"), "longitude", "latitude", order
    )
    places = dedup_dimension(keyed, ["__key"], order).select(
        "__key", F.col("longitude").alias("Longitude"), F.col("latitude").alias("Latitude")
    )
    return df.join(
        lookup_table(places, "places"), df[station] == F.col("__key"), "inner"
    ).drop("__key")


def station_at_rounded(
    df: DataFrame,
    dimension: DataFrame,
    order: str,
    digits: int = 4,
    unmatched: str = "drop",
) -> DataFrame:
    """Station name by coordinates rounded half-even; first match wins.

    Rows without a match are dropped, or raise when ``unmatched="error"``.
    """
    places = dimension.select(
        F.bround("longitude", digits).alias("__lon"),
        F.bround("latitude", digits).alias("__lat"),
        F.col("station").alias("Station_Name"),
        F.col(order).alias("__order"),
    )
    places = dedup_dimension(places, ["__lon", "__lat"], "__order").drop("__order")
    placed = df.withColumn("__lon", F.bround("Longitude", digits)).withColumn(
        "__lat", F.bround("Latitude", digits)
    )
    how = "inner" if unmatched == "drop" else "left"
    out = placed.join(lookup_table(places, "places"), ["__lon", "__lat"], how).drop("__lon", "__lat")
    if unmatched == "error":
        named = F.when(F.col("Station_Name").isNotNull(), F.col("Station_Name"))
        out = out.withColumn(
            "Station_Name", F.coalesce(named, F.raise_error(F.lit("no station at coordinates")))
        )
    return out


def station_at_exact(df: DataFrame, dimension: DataFrame) -> DataFrame:
    """Station name by equal coordinates; rows without one keep a null."""
    places = dimension.select(
        F.col("longitude").alias("__lon"), F.col("latitude").alias("__lat"), "station"
    )
    match = (df["Longitude"] == F.col("__lon")) & (df["Latitude"] == F.col("__lat"))
    return df.join(lookup_table(places, "places"), match, "left").drop("__lon", "__lat")


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, missing ones null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
