"""Gridded sources as cell tables, and the station dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.functions.cells import nan_to_null
from airloom.functions.dates import granule_date
from airloom.functions.names import station_key
from airloom.operators.assemble import dedup_dimension
from airloom.operators.reshape import AEROSOL_VARIABLES

# Spellings of the coordinate columns, in order of preference.
LATITUDE_NAMES = ["lat_nc", "latitude", "Latitude", "lat", "Lat"]
LONGITUDE_NAMES = ["lon_nc", "longitude", "Longitude", "lon", "Lon"]


def with_coordinates(df: DataFrame) -> DataFrame | None:
    """First known spelling of each coordinate column renamed to ``lat`` and ``lon``.

    None if the table lacks one of them; such a source is skipped.
    """
    lat = next((c for c in LATITUDE_NAMES if c in df.columns), None)
    lon = next((c for c in LONGITUDE_NAMES if c in df.columns), None)
    if lat is None or lon is None:
        return None
    rest = [F.col(f"`{c}`") for c in df.columns if c not in (lat, lon, "lat", "lon")]
    return df.select(*rest, F.col(f"`{lat}`").alias("lat"), F.col(f"`{lon}`").alias("lon"))


def grid_observations(df: DataFrame) -> DataFrame:
    """Regular grid: every variable and time step, named by its long name if it has one."""
    name = F.coalesce("long_name", "variable")
    return nan_to_null(
        df.select("time", "cell_id", "lat", "lon", name.alias("variable"), "value")
    )


def granule_observations(
    df: DataFrame,
    path: Column,
    variables: Sequence[str] = AEROSOL_VARIABLES,
) -> DataFrame:
    """Granule grid: listed variables only, dated by the file path.

    Files without a date in their path and cells without coordinates are left out.
    """
    return (
        nan_to_null(df)
        .where(F.col("variable").isin(*variables))
        .where("lat is not null and lon is not null")
        .withColumn("date", granule_date(path))
        .where("date is not null")
    )


def read_stations(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """Station table by column name, whatever the column order of the file."""
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", True)
    found = nan_to_null(reader.load(path))
    return found.select(
        F.col("station").cast("string").alias("station"),
        F.col("latitude").cast("double").alias("latitude"),
        F.col("longitude").cast("double").alias("longitude"),
    )


def station_dimension(df: DataFrame, order: str) -> DataFrame:
    """One row per normalised station name; of repeated names the last by ``order`` counts."""
    keyed = df.select(station_key(F.col("station")).alias("station"), "latitude", "longitude", order)
    return dedup_dimension(keyed, ["station"], order, keep="last").select(
        "station", "latitude", "longitude"
    )
