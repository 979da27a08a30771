"""Flows end to end: the weather grid to daily station series, and monitoring, weather and aerosol
rows to the feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.catalog.base import (
    CELLS_SQL,
    NEAREST_SQL,
    STATIONS_SQL,
    cells,
    observations,
    query,
    r6,
    stations,
    table,
)
from airloom.functions.cells import PRECIPITATION_SENTINEL
from airloom.operators.assemble import (
    OCEAN_COLUMNS,
    add_coordinates,
    drop_if_present,
    merge_sources,
    order_columns,
)
from airloom.operators.reshape import AEROSOL_VARIABLES, WEATHER_VARIABLES, crosstab
from airloom.plans.grid_to_daily import daily_station_table, station_series
from airloom.plans.station_table import (
    DEW_POINT,
    HUMIDITY,
    PRECIPITATION,
    TEMPERATURE,
    U_WIND,
    V_WIND,
    WIND,
    add_features,
    feature_table,
    monitoring_long,
    monitoring_wide,
    select_and_trim,
)

LAND = "Aerosol_Optical_Thickness_550_Land_Mean"


def _monitoring(spark, sf):
    """Orders as monitoring rows of the customer's nation; ten stations also measure PM2.5."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf, "orders").join(customer, F.col("o_custkey") == F.col("c_custkey"))
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return orders.groupBy(
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("station"),
        F.to_date("o_orderdate").alias("date"),
    ).agg(
        F.max(F.when(status != "P", price / 1000)).alias("PM10"),
        F.max(F.when((status == "F") & (F.col("c_nationkey") < 10), price / 2000)).alias("PM2.5"),
    )


def _lines(spark, sf):
    supplier = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, sf, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return lines.withColumn(
        "station", F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string"))
    ).withColumn("date", F.to_date("l_shipdate"))


def _weather(spark, sf):
    rain = F.when(F.col("l_tax") > 0.04, F.col("l_tax")).otherwise(F.lit(PRECIPITATION_SENTINEL))
    return _lines(spark, sf).groupBy("station", "date").agg(
        F.max("l_quantity").alias(U_WIND),
        F.max(F.col("l_linenumber").cast("double")).alias(V_WIND),
        F.max("l_quantity").alias(TEMPERATURE),
        (F.max("l_quantity") - 5).alias(DEW_POINT),
        F.max(rain).alias(PRECIPITATION),
    )


def _aerosol(spark, sf):
    lines = _lines(spark, sf).where("l_returnflag = 'A'")
    return lines.groupBy("station", "date").agg(F.max("l_discount").alias(LAND))


def _calendar(spark, sf):
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)
    return table(spark, sf, "orders").groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.max(urgent).alias("COVID - 19")
    )


def _dimension(spark, sf):
    """Nations with the coordinates of their first supplier."""
    nation = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    placed = stations(spark, sf).join(nation, F.col("station") == F.col("s_suppkey"))
    name = F.concat(F.lit("nation "), F.col("s_nationkey").cast("string"))
    return placed.select(name.alias("station"), "latitude", "longitude", "s_suppkey")


_STATION_TABLE_SQL = f"""with {STATIONS_SQL},
    m as (select 'nation_' || c_nationkey as station, o_orderdate::date as date,
                 max(case when o_orderstatus <> 'P' then o_totalprice / 1000 end) as pm10,
                 max(case when o_orderstatus = 'F' and c_nationkey < 10 then o_totalprice / 2000 end) as pm25
          from orders join customer on o_custkey = c_custkey group by all),
    l as (select 'nation_' || s_nationkey as station, l_shipdate::date as date, lineitem.*
          from lineitem join supplier on l_suppkey = s_suppkey),
    w as (select station, date, max(l_quantity) as u, max(l_linenumber)::double as v,
                 max(case when l_tax > 0.04 then l_tax end) as rain from l group by all),
    a as (select station, date, max(l_discount) as land from l where l_returnflag = 'A' group by all),
    c as (select o_orderdate::date as date, max((o_orderpriority = '1-URGENT')::int) as covid
          from orders group by 1),
    d as (select 'nation_' || s_nationkey as station, arg_min(longitude, s_suppkey) as lon,
                 arg_min(latitude, s_suppkey) as lat
          from supplier join stations on s_suppkey = station group by 1),
    t as (select m.station, m.date, pm10, pm25, u, v, rain, land, covid, lon, lat,
                 sum((pm10 is null)::int) over (partition by m.station order by m.date
                   rows between 1 preceding and current row) as missing
          from m left join w using (station, date) left join a using (station, date)
               left join c using (date) join d on d.station = m.station
          where m.station in (select station from w) and m.station in (select station from a)
            and m.station in (select station from m group by 1
                              having count(pm10) > 0 and count(pm25) = 0))
    select station, date, year(date) as "Year", month(date) as "Month", day(date) as "Day",
           pm10 as "PM10", pm25 as "PM2.5", u as "{U_WIND}", v as "{V_WIND}", u as "{TEMPERATURE}",
           u - 5 as "{DEW_POINT}", rain as "{PRECIPITATION}", land as "{LAND}", covid as "COVID - 19",
           round(sqrt(u * u + v * v), 6) as "{WIND}",
           round(100 * exp(17.625::double * (u - 5) / (243.04::double + u - 5))
                 / exp(17.625::double * u / (243.04::double + u)), 6) as "{HUMIDITY}",
           lon as "Longitude", lat as "Latitude"
    from t where missing < 2"""


@query("station_table", _STATION_TABLE_SQL)
def q_station_table(spark, sf):
    merged = merge_sources(
        _monitoring(spark, sf), _weather(spark, sf), _aerosol(spark, sf), _calendar(spark, sf)
    )
    placed = add_coordinates(add_features(merged), _dimension(spark, sf), "s_suppkey")
    out = order_columns(select_and_trim(placed, block_size=2))
    return out.withColumn(WIND, r6(WIND)).withColumn(HUMIDITY, r6(HUMIDITY))


@query("feature_table")
def q_feature_table(spark, sf):
    return feature_table(
        _monitoring(spark, sf),
        _weather(spark, sf),
        _aerosol(spark, sf),
        _calendar(spark, sf),
        _dimension(spark, sf),
        "s_suppkey",
    )


@query(
    "monitoring_matrix",
    """with l as (
         select 'kuzey' as station, o_orderdate::date as date, 'PM10' as pollutant, o_custkey::double as v from orders
         union all select 'kuzey', o_orderdate::date, 'NO2', o_orderkey from orders where o_orderstatus = 'F'
         union all select 'guney', o_orderdate::date, 'PM10', o_custkey + 1 from orders where o_orderstatus = 'O')
       select station, date, max(case when pollutant = 'PM10' then v end) as "PM10",
              max(case when pollutant = 'NO2' then v end) as "NO2"
       from (select station, date, pollutant, v from l
             union all select 'kuzey', o_orderdate::date, null, null from orders
             union all select 'guney', o_orderdate::date, null, null from orders) group by all""",
)
def q_monitoring_matrix(spark, sf):
    status = F.col("o_orderstatus")
    matrix = table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("date"),
        F.col("o_custkey").cast("string").alias("kuzey|PM10 ( µg/m3 )"),
        F.when(status == "F", F.col("o_orderkey").cast("string")).alias("NO2 ( ppb )"),
        F.lit("7").alias("SO2"),
        F.when(status == "O", (F.col("o_custkey") + 1).cast("string")).alias("guney|PM10"),
    )
    return monitoring_wide(monitoring_long(matrix), ["PM10", "NO2"])


_NINE = range(len(WEATHER_VARIABLES))


@query(
    "weather_flow",
    f"""with {STATIONS_SQL}, {CELLS_SQL}, {NEAREST_SQL},
    obs as (select l_partkey as cell_id, year(l_shipdate) as y, l_orderkey % 9 as v,
                   avg(l_extendedprice) as value from lineitem group by all),
    series as (select station, y, v, case when count(value) = 4
                      then sum(value / sqrt(d2)) / sum(1 / sqrt(d2)) end as value
               from nearest join obs using (cell_id) group by all),
    wide as (select station,
                    make_timestamp(y, 1, 1, 22, 0, 0) at time zone 'UTC' at time zone 'Europe/Istanbul' as ts,
                    {", ".join(f"max(case when v = {i} then value end) as v{i}" for i in _NINE)}
             from series group by station, y),
    daily as (select station, ts::date as date, {", ".join(f"avg(v{i}) as v{i}" for i in _NINE)}
              from wide where ts between timestamp '1993-01-01' and timestamp '1997-12-31' group by all),
    days as (select station, unnest(generate_series(min(date), max(date), interval 1 day))::date as date
             from daily group by station)
    select station, date, {", ".join(f'round(v{i}, 6) as "{v}"' for i, v in enumerate(WEATHER_VARIABLES))}
    from days left join daily using (station, date)""",
)
def q_weather_flow(spark, sf):
    """Grid cells onto stations, nine variables side by side, local days of a period."""
    year, kind = F.year("l_shipdate"), F.pmod("l_orderkey", F.lit(9)).cast("int") + 1
    grid = table(spark, sf, "lineitem").groupBy(
        F.col("l_partkey").alias("cell_id"),
        F.make_timestamp_ntz(year, F.lit(1), F.lit(1), F.lit(22), F.lit(0), F.lit(0)).alias("time"),
        F.element_at(F.array(*map(F.lit, WEATHER_VARIABLES)), kind).alias("variable"),
    ).agg(F.avg("l_extendedprice").alias("value"))
    series = station_series(cells(spark, sf), grid, stations(spark, sf), "time")
    daily = daily_station_table(series, WEATHER_VARIABLES, "1993-01-01", "1997-12-31")
    return daily.select("station", "date", *[r6(f"`{v}`").alias(v) for v in WEATHER_VARIABLES])


@query(
    "aerosol_layout",
    f"""select user_id as station, ts::date as date,
               max(case when event_id % 3 = 0 then value end) as "{LAND}"
        from events group by all""",
)
def q_aerosol_layout(spark, sf):
    """Three aerosol variables side by side; those over the ocean go."""
    kind = F.pmod("event_id", F.lit(3)).cast("int") + 1
    named = F.element_at(F.array(*map(F.lit, AEROSOL_VARIABLES)), kind)
    facts = observations(spark, sf).withColumns({"variable": named, "date": F.to_date("date")})
    return drop_if_present(crosstab(facts, ["station", "date"], AEROSOL_VARIABLES), OCEAN_COLUMNS)
