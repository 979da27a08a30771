"""Flow 2: monitoring matrix and daily grid series to one clean, imputed feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.functions.cells import PRECIPITATION_SENTINEL, sentinel_to_null
from airloom.functions.dates import date_parts
from airloom.functions.names import drop_periods
from airloom.functions.weather import relative_humidity, wind_speed
from airloom.operators.assemble import (
    CALENDAR_COLUMNS,
    OTHER_POLLUTANTS,
    add_coordinates,
    drop_if_present,
    merge_sources,
    order_columns,
)
from airloom.operators.impute import BLOCK_ROWS, DONORS, imputable_columns, knn_impute
from airloom.operators.ordered import MAX_GROUP_ROWS, trim_null_runs
from airloom.operators.quality import measured_at
from airloom.operators.ranks import TAIL_SHARE, prune_tails
from airloom.operators.reshape import crosstab, drop_flat_series, unpivot_stations
from airloom.session import materialize

# Names of the columns read and made here.
U_WIND = "10 metre U wind component"
V_WIND = "10 metre V wind component"
TEMPERATURE = "2 metre temperature"
DEW_POINT = "2 metre dewpoint temperature"
PRECIPITATION = "Total precipitation"
WIND = "Wind Velocity"
HUMIDITY = "Relative Humidity"


def monitoring_long(matrix: DataFrame, date: str = "date") -> DataFrame:
    """Station matrix to dated long rows of series that vary, values still text without
    periods."""
    long = drop_flat_series(unpivot_stations(matrix, date)).where(F.col(date).isNotNull())
    return long.withColumn("value", drop_periods(F.col("value")))


def monitoring_wide(
    long: DataFrame, pollutants: Sequence[str] | Mapping[str, str], date: str = "date"
) -> DataFrame:
    numbers = long.withColumn("value", F.col("value").try_cast("double"))
    numbers = numbers.withColumn(date, F.col(date).cast("date"))
    return crosstab(numbers, ["station", date], pollutants, "pollutant", "value")


def add_features(df: DataFrame, kelvin: bool = False) -> DataFrame:
    """Date parts, wind speed and relative humidity."""
    return df.select(
        "*",
        *date_parts(F.col("date")),
        wind_speed(F.col(f"`{U_WIND}`"), F.col(f"`{V_WIND}`")).alias(WIND),
        relative_humidity(F.col(f"`{TEMPERATURE}`"), F.col(f"`{DEW_POINT}`"), kelvin).alias(
            HUMIDITY
        ),
    )


def select_and_trim(
    df: DataFrame,
    has: Sequence[str] = ("PM10",),
    lacks: Sequence[str] = ("PM2.5",),
    block_size: int = 10,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Chosen stations, other pollutants dropped, sentinel nulled, long gaps cut out."""
    chosen = drop_if_present(measured_at(df, has, lacks), OTHER_POLLUTANTS)
    if PRECIPITATION in chosen.columns:
        rain = sentinel_to_null(F.col(f"`{PRECIPITATION}`"), PRECIPITATION_SENTINEL)
        chosen = chosen.withColumn(PRECIPITATION, rain)
    return trim_null_runs(chosen, has[0], ["station"], ["date"], block_size, max_rows)


def feature_table(
    monitoring: DataFrame,
    weather: DataFrame,
    aerosol: DataFrame,
    calendar: DataFrame,
    stations: DataFrame,
    station_order: str,
    has: Sequence[str] = ("PM10",),
    lacks: Sequence[str] = ("PM2.5",),
    pruned: Sequence[str] = ("PM10", "PM2.5"),
    share: float = TAIL_SHARE,
    donors: int = DONORS,
    block_rows: int = BLOCK_ROWS,
    kelvin: bool = False,
) -> DataFrame:
    """The whole flow. Written to scratch before pruning and before imputing, because both
    need statistics of the finished table."""
    merged = merge_sources(monitoring, weather, aerosol, calendar)
    placed = add_coordinates(add_features(merged, kelvin), stations, station_order)
    placed = materialize(placed, "merged")
    trimmed = materialize(order_columns(select_and_trim(placed, has, lacks)), "trimmed")
    clean = materialize(prune_tails(trimmed, pruned, share), "pruned")
    columns = imputable_columns(clean, CALENDAR_COLUMNS)
    return knn_impute(clean, columns, ["date", "station"], donors, block_rows)
