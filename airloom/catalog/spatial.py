"""Queries of the spatial join and interpolation."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.catalog.base import (
    CELL_SERIES_SQL,
    CELLS_SQL,
    NEAREST_SQL,
    STATIONS_SQL,
    cell_series,
    cells,
    query,
    r6,
    stations,
    table,
)
from airloom.functions.weather import squared_distance
from airloom.operators.spatial import interpolate, nearest_cells
from airloom.plans.grid_to_daily import station_series


@query(
    "nearest_cells",
    f"with {STATIONS_SQL}, {CELLS_SQL}, {NEAREST_SQL} "
    "select station, cell_id, rank, round(d2, 6) as d2 from nearest",
)
def q_nearest_cells(spark, sf):
    near = nearest_cells(cells(spark, sf), stations(spark, sf))
    return near.select("station", "cell_id", "rank", r6("d2").alias("d2"))


@query(
    "interpolate_grid",
    f"""with {STATIONS_SQL}, {CELLS_SQL}, {CELL_SERIES_SQL}, {NEAREST_SQL}
        select station, time as date, variable,
               round(case when count(value) = 4
                     then sum(value / sqrt(d2)) / sum(1 / sqrt(d2)) end, 6) as value
        from nearest join cell_series using (cell_id) group by all""",
)
def q_interpolate_grid(spark, sf):
    series = station_series(
        cells(spark, sf), cell_series(spark, sf), stations(spark, sf), "time"
    )
    return series.withColumn("value", r6("value"))


# Parts of one brand are the cells of one granule.
_GRANULES_SQL = f"""{STATIONS_SQL}, {CELLS_SQL},
    granules as (select p_brand as granule, cell_id, lat, lon, p_retailprice as value
                 from part join cells on p_partkey = cell_id),
    nearest as (
        select * from (
            select granule, station, cell_id, value, d2,
                   row_number() over (partition by granule, station order by d2, cell_id) as rank
            from (select granule, station, cell_id, value,
                         (s.latitude - g.lat) * (s.latitude - g.lat)
                         + (s.longitude - g.lon) * (s.longitude - g.lon) as d2
                  from stations s, granules g))
        where rank <= 4)"""


def _granules(spark, sf):
    brand = table(spark, sf, "part").select(
        F.col("p_partkey").alias("cell_id"), F.col("p_brand").alias("granule"),
        F.col("p_retailprice").alias("value"),
    )
    return cells(spark, sf).join(brand, "cell_id")


@query(
    "nearest_cells_per_granule",
    f"with {_GRANULES_SQL} select granule, station, cell_id, rank from nearest",
)
def q_nearest_cells_per_granule(spark, sf):
    granules = _granules(spark, sf)
    near = nearest_cells(granules, stations(spark, sf), by=["granule"])
    return near.select("granule", "station", "cell_id", "rank")


@query(
    "interpolate_granules",
    f"""with {_GRANULES_SQL}
        select station, granule,
               round(case when count(value) = 4
                     then sum(value / sqrt(d2)) / sum(1 / sqrt(d2)) end, 6) as value
        from nearest group by all""",
)
def q_interpolate_granules(spark, sf):
    granules = _granules(spark, sf)
    near = nearest_cells(granules, stations(spark, sf), by=["granule"])
    series = interpolate(granules.select("granule", "cell_id", "value"), near, ["granule"])
    return series.select("station", "granule", r6("value").alias("value"))


@query(
    "planar_distance",
    f"""with {STATIONS_SQL}
        select station, round(sqrt((latitude - 39::double) * (latitude - 39::double)
               + (longitude - 35::double) * (longitude - 35::double)), 6) as distance from stations""",
)
def q_planar_distance(spark, sf):
    d2 = squared_distance(F.col("latitude"), F.col("longitude"), F.lit(39.0), F.lit(35.0))
    return stations(spark, sf).select("station", r6(F.sqrt(d2)).alias("distance"))
