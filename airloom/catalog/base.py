"""Registry of queries over the test tables, and the frames several of them start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(c: Column | str) -> Column:
    """Compared to six decimals: engines add doubles in different orders."""
    return F.round(c, 6)


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """Events as long station observations."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("station"),
        F.col("ts").alias("date"),
        F.col("event_type").alias("variable"),
        "value",
        "event_id",
    )


def gappy(spark: SparkSession, folder: str) -> DataFrame:
    """Observations whose low readings are missing."""
    return observations(spark, folder).withColumn(
        "value", F.when(F.col("value") >= 30, F.col("value"))
    )


GAPPY_SQL = """gappy as (
    select user_id as station, ts as date, event_type as variable, event_id,
           case when value >= 30 then value end as value
    from events)"""


def stations(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as stations with coordinates off the grid."""
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        key.alias("station"),
        (F.lit(36.013) + F.pmod(key * 37, F.lit(900)) / 100.0).alias("latitude"),
        (F.lit(26.017) + F.pmod(key * 91, F.lit(1900)) / 100.0).alias("longitude"),
    )


STATIONS_SQL = """stations as (
    select s_suppkey as station,
           36.013::double + ((s_suppkey * 37) % 900) / 100.0::double as latitude,
           26.017::double + ((s_suppkey * 91) % 1900) / 100.0::double as longitude
    from supplier)"""


def cells(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as cells of a regular grid."""
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        key.alias("cell_id"),
        (F.lit(36.0) + F.floor(key / 50) * F.lit(0.25)).alias("lat"),
        (F.lit(26.0) + F.pmod(key, F.lit(50)) * F.lit(0.4)).alias("lon"),
    )


CELLS_SQL = """cells as (
    select p_partkey as cell_id,
           36.0::double + floor(p_partkey / 50) * 0.25::double as lat,
           26.0::double + (p_partkey % 50) * 0.4::double as lon
    from part)"""


def cell_series(spark: SparkSession, folder: str) -> DataFrame:
    """Mean line price of every cell, year and flag, as gridded observations."""
    lines = table(spark, folder, "lineitem")
    return lines.groupBy(
        F.col("l_partkey").alias("cell_id"),
        F.year("l_shipdate").alias("time"),
        F.col("l_returnflag").alias("variable"),
    ).agg(F.avg("l_extendedprice").alias("value"))


CELL_SERIES_SQL = """cell_series as (
    select l_partkey as cell_id, year(l_shipdate) as time, l_returnflag as variable,
           avg(l_extendedprice) as value
    from lineitem group by all)"""

NEAREST_SQL = """nearest as (
    select * from (
        select station, cell_id, d2,
               row_number() over (partition by station order by d2, cell_id) as rank
        from (select s.station, c.cell_id,
                     (s.latitude - c.lat) * (s.latitude - c.lat)
                     + (s.longitude - c.lon) * (s.longitude - c.lon) as d2
              from stations s, cells c))
    where rank <= 4)"""
