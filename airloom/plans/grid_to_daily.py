"""Flow 1: gridded fields to daily local-time series per station."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.functions.dates import to_local
from airloom.operators.calendar import daily_mean, within_period
from airloom.operators.reshape import crosstab
from airloom.operators.spatial import interpolate, nearest_cells
from airloom.session import lookup_table


def station_series(
    cells: DataFrame,
    observations: DataFrame,
    stations: DataFrame,
    time: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Long series per station: ``station``, ``date``, ``variable``, ``value``.

    The neighbour table is computed once per grid and written, then reused for every time
    step and variable.
    """
    near = lookup_table(nearest_cells(cells, stations, by=by), "neighbours")
    series = interpolate(observations, near, [*by, time, "variable"], written=True)
    return series.select("station", F.col(time).alias("date"), "variable", "value")


def daily_station_table(
    series: DataFrame,
    variables: Sequence[str] | Mapping[str, str],
    start: str | None = None,
    end: str | None = None,
    inclusive_day: bool = False,
) -> DataFrame:
    """Wide daily means in local time, every calendar day of a station present.

    No zone is a day or more away from another, so rows further outside the period than that are
    filtered by the source's own time, which the scan can use.
    """
    if start and end:
        low, high = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
        day = F.expr("interval 1 day")
        series = series.where((F.col("date") >= low - day) & (F.col("date") < high + day + day))
    wide = crosstab(series, ["station", "date"], variables)
    wide = wide.withColumn("date", to_local(F.col("date")))
    if start and end:
        wide = within_period(wide, start, end, inclusive_day=inclusive_day)
    names = list(variables.values()) if isinstance(variables, Mapping) else list(variables)
    return daily_mean(wide, names)
