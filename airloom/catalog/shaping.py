"""Queries over reshaping, calendars, names, joins and column layout."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.catalog.base import EVENT_TYPES, STATIONS_SQL, observations, query, r6, stations, table
from airloom.functions.dates import (
    date_parts,
    date_text,
    granule_date,
    ordinal_date,
    season,
    to_local,
)
from airloom.functions.names import (
    clean_pollutant_columns,
    drop_periods,
    file_lookup_key,
    file_stem,
    lookup_key,
    parse_decimal,
    pollutant_name,
    sheet_key,
    space_columns,
    station_key,
    strip_columns,
)
from airloom.functions.weather import pm_ratio, relative_humidity, wind_speed
from airloom.operators.assemble import (
    add_coordinates,
    drop_calendar,
    drop_if_present,
    feature_names,
    in_every_source,
    left_merge,
    merge_sources,
    order_columns,
    rename_if_present,
    station_at_exact,
    station_at_rounded,
)
from airloom.operators.calendar import (
    date_order,
    daily_mean,
    first_dates,
    from_first_date,
    parse_dates,
    within_period,
)
from airloom.operators.ordered import with_positions
from airloom.operators.reshape import crosstab, drop_flat_series, melt, unpivot_stations
from airloom.plans.grid_to_daily import daily_station_table

_WIDE_SQL = ", ".join(
    f"max(case when event_type = '{v}' then value end) as {v}" for v in EVENT_TYPES
)


@query(
    "crosstab",
    f"select user_id as station, ts as date, {_WIDE_SQL} from events group by all",
)
def q_crosstab(spark, sf):
    return crosstab(observations(spark, sf), ["station", "date"], EVENT_TYPES)


@query(
    "crosstab_fixed_list",
    """select user_id as station, ts::date as date,
              max(case when event_type = 'click' then value end) as "Surface pressure",
              max(case when event_type = 'view' then value end) as "Total cloud cover",
              max(case when event_type = 'none' then value end) as "Total precipitation"
       from events group by all""",
)
def q_crosstab_fixed_list(spark, sf):
    names = {
        "click": "Surface pressure", "view": "Total cloud cover", "none": "Total precipitation"
    }
    daily = observations(spark, sf).withColumn("date", F.col("date").cast("date"))
    return crosstab(daily, ["station", "date"], names)


@query(
    "to_local_time",
    """select event_id, ts at time zone 'UTC' at time zone 'Europe/Istanbul' as local_ts from events""",
)
def q_to_local_time(spark, sf):
    return observations(spark, sf).select("event_id", to_local(F.col("date")).alias("local_ts"))


@query(
    "local_time_before_2016",
    """select o_orderkey, o_orderdate at time zone 'UTC' at time zone 'Europe/Istanbul' as local_ts
       from orders""",
)
def q_local_time_before_2016(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select("o_orderkey", to_local(F.col("o_orderdate")).alias("local_ts"))


_SPINE_SQL = """days as (
    select station, unnest(generate_series(min(date), max(date), interval 1 day))::date as date
    from daily group by station)"""


@query(
    "daily_mean",
    f"""with daily as (
          select user_id as station, ts::date as date, avg(value) as value from events group by all),
        {_SPINE_SQL}
        select station, date, round(value, 6) as value
        from days left join daily using (station, date)""",
)
def q_daily_mean(spark, sf):
    daily = daily_mean(observations(spark, sf), ["value"])
    return daily.withColumn("value", r6("value"))


_LOCAL_DAILY = ", ".join(f"round({v}, 6) as {v}" for v in EVENT_TYPES)


@query(
    "daily_station_table",
    f"""with wide as (
          select user_id as station,
                 ts at time zone 'UTC' at time zone 'Europe/Istanbul' as ts, {_WIDE_SQL}
          from events group by all),
        daily as (
          select station, ts::date as date, {", ".join(f"avg({v}) as {v}" for v in EVENT_TYPES)}
          from wide group by all),
        {_SPINE_SQL}
        select station, date, {_LOCAL_DAILY} from days left join daily using (station, date)""",
)
def q_daily_station_table(spark, sf):
    wide = daily_station_table(observations(spark, sf), EVENT_TYPES)
    return wide.select("station", "date", *[r6(v).alias(v) for v in EVENT_TYPES])


@query(
    "period_bounds",
    """select event_id, ts as date from events
       where ts >= timestamp '2024-01-05' and ts <= timestamp '2024-01-20'""",
)
def q_period_bounds(spark, sf):
    inside = within_period(observations(spark, sf), "2024-01-05", "2024-01-20")
    return inside.select("event_id", "date")


@query(
    "period_whole_days",
    """select event_id, ts as date from events
       where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-21'""",
)
def q_period_whole_days(spark, sf):
    inside = within_period(observations(spark, sf), "2024-01-05", "2024-01-20", inclusive_day=True)
    return inside.select("event_id", "date")


@query(
    "parse_dates",
    "select o_orderkey, o_orderdate as date from orders where o_orderstatus <> 'P'",
)
def q_parse_dates(spark, sf):
    d = F.col("o_orderdate")
    status = F.col("o_orderstatus")
    text = (
        F.when(status == "F", F.date_format(d, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(status == "O", F.date_format(d, "MM/dd/yyyy"))
        .otherwise(F.concat(F.lit("no date "), status))
    )
    return parse_dates(table(spark, sf, "orders").select("o_orderkey", text.alias("date")))


@query(
    "first_dates",
    """select o_custkey as station, min(case when o_totalprice > 200000 then o_orderdate end) as first_date
       from orders group by 1""",
)
def q_first_dates(spark, sf):
    dated = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("station"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_orderdate")).alias("date"),
    )
    return first_dates(dated, ["station"])


@query(
    "from_first_date",
    """select o_orderkey, o_orderdate as date from orders where o_totalprice > 200000""",
)
def q_from_first_date(spark, sf):
    dated = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_totalprice") > 200000, F.col("o_orderdate")).alias("date")
    )
    return from_first_date(dated)


@query(
    "drop_flat_series",
    """select o_custkey as station, o_orderstatus as pollutant, o_orderkey, o_orderpriority as value
       from orders semi join (
         select o_custkey, o_orderstatus from orders group by all
         having count(distinct o_orderpriority) >= 2) using (o_custkey, o_orderstatus)""",
)
def q_drop_flat_series(spark, sf):
    series = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("station"),
        F.col("o_orderstatus").alias("pollutant"),
        "o_orderkey",
        F.col("o_orderpriority").alias("value"),
    )
    return drop_flat_series(series)


@query(
    "unpivot_stations",
    """select 'kuzey' as station, l_shipdate as date, 'PM10' as pollutant, l_quantity::int as value from lineitem
       union all select 'kuzey', l_shipdate, 'NO2', l_linenumber from lineitem
       union all select 'guney', l_shipdate, 'SO2',
                        case when l_returnflag = 'A' then l_linenumber + 1 end from lineitem""",
)
def q_unpivot_stations(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("date"),
        F.col("l_quantity").cast("int").alias("kuzey|PM10 ( µg/m3 )"),
        F.col("l_linenumber").alias("NO2 ( ppb )"),
        F.when(F.col("l_returnflag") == "A", F.col("l_linenumber") + 1).alias("guney|SO2"),
    )
    return unpivot_stations(lines).withColumn("value", F.col("value").try_cast("int"))


@query(
    "melt_metrics",
    """select user_id as station, 'n' as "Metric", count(*)::double as "Value" from events group by 1
       union all select user_id, 'low', min(value) from events group by 1
       union all select user_id, 'high', max(value) from events group by 1""",
)
def q_melt_metrics(spark, sf):
    wide = observations(spark, sf).groupBy("station").agg(
        F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")
    )
    return melt(wide, ["station"])


@query(
    "granule_date",
    """select o_orderkey, case when o_orderstatus <> 'P' then o_orderdate::date end as date from orders""",
)
def q_granule_date(spark, sf):
    path = F.concat(F.lit("/grid/2020/MOD08.A"), F.date_format("o_orderdate", "yyyyDDD"), F.lit(".061.nc"))
    path = F.when(F.col("o_orderstatus") != "P", path).otherwise(F.lit("/grid/readme.nc"))
    return table(spark, sf, "orders").select("o_orderkey", granule_date(path).alias("date"))


@query(
    "ordinal_date",
    """select o_orderkey, (make_date(year(o_orderdate), 1, 1) + (o_custkey::int - 1))::date as date from orders""",
)
def q_ordinal_date(spark, sf):
    day = F.col("o_custkey").cast("int")
    return table(spark, sf, "orders").select(
        "o_orderkey", ordinal_date(F.year("o_orderdate"), day).alias("date")
    )


@query(
    "date_parts",
    """select o_orderkey, year(o_orderdate) as "Year", month(o_orderdate) as "Month",
              day(o_orderdate) as "Day" from orders""",
)
def q_date_parts(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", *date_parts(F.col("o_orderdate")))


@query(
    "season",
    """select o_orderkey, case when month(o_orderdate) in (12, 1, 2) then 'Winter'
              when month(o_orderdate) <= 5 then 'Spring' when month(o_orderdate) <= 8 then 'Summer'
              else 'Autumn' end as season from orders""",
)
def q_season(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", season(F.col("o_orderdate")).alias("season"))


@query(
    "date_text",
    "select event_id, strftime(ts, '%m/%d/%Y') as date, ts::date as day from events",
)
def q_date_text(spark, sf):
    return observations(spark, sf).select(
        "event_id", date_text(F.col("date")).alias("date"), F.to_date("date").alias("day")
    )


@query(
    "lexical_date_order",
    """select o_orderkey, row_number() over (order by strftime(o_orderdate, '%m/%d/%Y'), o_orderkey) as position
       from orders""",
)
def q_lexical_date_order(spark, sf):
    key = date_order("o_orderdate", lexical=True).alias("key")
    orders = table(spark, sf, "orders").select("o_orderkey", key)
    return with_positions(orders, [], ["key", "o_orderkey"], "position").drop("key")


@query(
    "chronological_order",
    """select event_id, row_number() over (partition by user_id order by ts, event_id) as position from events""",
)
def q_chronological_order(spark, sf):
    facts = observations(spark, sf).select("station", "date", "event_id")
    placed = with_positions(facts, ["station"], ["date", "event_id"], "position")
    return placed.select("event_id", "position")


_NAME = "'İSTANBUL  Çığlı-' || s_name || ' Şükrü'"


@query(
    "station_names",
    f"""select s_suppkey,
          'istanbul_cigli-' || lower(s_name) || '_sukru' as station_key,
          substr('istanbul_cigli_' || lower(replace(s_name, '#', '_')) || '_sukru', 1, 31) as sheet_key,
          replace('İSTANBUL_Çigli-' || s_name || '_Şukru', '__', '_') as lookup_key
        from supplier""",
)
def q_station_names(spark, sf):
    name = F.concat(F.lit("İSTANBUL  Çığlı-"), F.col("s_name"), F.lit(" Şükrü"))
    return table(spark, sf, "supplier").select(
        "s_suppkey",
        station_key(name).alias("station_key"),
        sheet_key(name).alias("sheet_key"),
        lookup_key(name).alias("lookup_key"),
    )


@query(
    "file_names",
    """select c_custkey, c_name as stem, lower(c_name) || '.v2' as file_key from customer""",
)
def q_file_names(spark, sf):
    name = F.concat(F.col("c_name"), F.lit(".v2.xlsx"))
    return table(spark, sf, "customer").select(
        "c_custkey", file_stem(name).alias("stem"), file_lookup_key(name).alias("file_key")
    )


_NUMBER_SQL = "translate(format('{:,.2f}', c_acctbal), ',.', '.,')"


@query(
    "text_numbers",
    f"""select c_custkey, replace({_NUMBER_SQL}, '.', '') as cleaned, c_acctbal as number,
               c_mktsegment || 'NO2' as pollutant from customer""",
)
def q_text_numbers(spark, sf):
    text = F.translate(F.format_number("c_acctbal", 2), ",.", ".,")
    label = F.concat(F.col("c_mktsegment"), F.lit(" NO2 ( ppb )"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        drop_periods(text).alias("cleaned"),
        parse_decimal(text).alias("number"),
        pollutant_name(label).alias("pollutant"),
    )


@query(
    "column_names",
    """select l_orderkey as "l orderkey", l_quantity as "PM10", l_tax as "NO2" from lineitem""",
)
def q_column_names(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.col("l_quantity").alias(" PM10 ( µg/m3 )"),
        F.col("l_tax").alias("NO2 ( ppb ) "),
    )
    return space_columns(strip_columns(clean_pollutant_columns(lines)))


@query(
    "column_layout",
    """select l_shipdate as date, l_quantity as "PM10", l_discount as other from lineitem""",
)
def q_column_layout(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_discount").alias("other"),
        F.col("l_quantity").alias("PM10"),
        F.col("l_tax").alias("O3"),
        F.year("l_shipdate").alias("Year"),
        F.lit(0).alias("COVID - 19"),
        F.col("l_shipdate").alias("Date"),
    )
    renamed = rename_if_present(lines, "Date", "date")
    return order_columns(drop_calendar(drop_if_present(renamed, ["O3", "SO2"])))


@query("feature_columns", "select l_discount, l_quantity, l_tax from lineitem")
def q_feature_columns(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("date"), "l_quantity", "l_discount", "l_tax", "l_extendedprice"
    )
    return lines.select(*feature_names(lines, "l_extendedprice"))


@query(
    "wind_and_humidity",
    """select l_orderkey, l_linenumber, l_partkey, l_extendedprice,
         round(sqrt(l_quantity * l_quantity + l_linenumber * l_linenumber), 6) as wind,
         round(100 * exp(17.625::double * (l_quantity - 5) / (243.04::double + (l_quantity - 5)))
               / exp(17.625::double * l_quantity / (243.04::double + l_quantity)), 6) as humidity,
         round(case when l_discount <> 0 then l_tax / l_discount end, 6) as ratio
       from lineitem""",
)
def q_wind_and_humidity(spark, sf):
    t = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice",
        r6(wind_speed(t, F.col("l_linenumber").cast("double"))).alias("wind"),
        r6(relative_humidity(t, t - 5)).alias("humidity"),
        r6(pm_ratio(F.col("l_tax"), F.col("l_discount"))).alias("ratio"),
    )


def _slice(spark, sf, kind, name):
    facts = observations(spark, sf).where(F.col("variable") == kind)
    return facts.select("station", F.to_date("date").alias("date"), F.col("value").alias(name))


@query(
    "merge_sources",
    """with m as (select user_id as station, ts::date as date, value as pm from events where event_type = 'view'),
            w as (select user_id as station, ts::date as date, value as wind from events where event_type = 'click'),
            a as (select user_id as station, ts::date as date, value as aod from events
                  where event_type = 'error' and value > 60),
            c as (select ts::date as date, max(case when value > 400 then 1 else 0 end) as "COVID - 19"
                  from events group by 1)
       select station, date, pm, wind, aod, "COVID - 19"
       from m left join w using (station, date) left join a using (station, date) left join c using (date)
       where station in (select station from w) and station in (select station from a)""",
)
def q_merge_sources(spark, sf):
    aerosol = _slice(spark, sf, "error", "aod").where("aod > 60")
    calendar = (
        observations(spark, sf)
        .groupBy(F.to_date("date").alias("date"))
        .agg(F.max(F.when(F.col("value") > 400, 1).otherwise(0)).alias("COVID - 19"))
    )
    return merge_sources(
        _slice(spark, sf, "view", "pm"), _slice(spark, sf, "click", "wind"), aerosol, calendar
    )


@query(
    "left_merge_suffixes",
    """select m.user_id as station, m.ts::date as date, m.value as value_x, w.value as value_y
       from (select * from events where event_type = 'view') m
       left join (select * from events where event_type = 'signup') w
         on m.user_id = w.user_id and m.ts::date = w.ts::date""",
)
def q_left_merge_suffixes(spark, sf):
    left, right = _slice(spark, sf, "view", "value"), _slice(spark, sf, "signup", "value")
    return left_merge(left, right, ["station", "date"])


@query(
    "stations_in_every_source",
    """select event_id, user_id as station from events
       where event_type = 'view'
         and user_id in (select user_id from events where event_type = 'click' and value > 150)
         and user_id in (select user_id from events where event_type = 'error' and value > 150)""",
)
def q_stations_in_every_source(spark, sf):
    facts = observations(spark, sf)
    high = facts.where("value > 150")
    kept = in_every_source(
        facts.where("variable = 'view'"),
        high.where("variable = 'click'"),
        high.where("variable = 'error'"),
    )
    return kept.select("event_id", "station")


@query(
    "coordinates_by_name",
    f"""with {STATIONS_SQL}, dim as (
          select s_nationkey, arg_min(latitude, s_suppkey) as lat, arg_min(longitude, s_suppkey) as lon
          from supplier join stations on s_suppkey = station where s_nationkey < 20 group by 1)
        select c_custkey, lat as "Latitude", lon as "Longitude" from customer join dim on c_nationkey = s_nationkey""",
)
def q_coordinates_by_name(spark, sf):
    nation = table(spark, sf, "supplier").where("s_nationkey < 20").select("s_suppkey", "s_nationkey")
    named = stations(spark, sf).join(nation, F.col("station") == F.col("s_suppkey"))
    dimension = named.select(
        F.concat(F.lit(" kağıthane  "), F.col("s_nationkey").cast("string")).alias("station"),
        "latitude", "longitude", "s_suppkey",
    )
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("kagithane_"), F.col("c_nationkey").cast("string")).alias("station")
    )
    return add_coordinates(rows, dimension, "s_suppkey").drop("station")


@query(
    "station_by_rounded_coordinates",
    f"""with {STATIONS_SQL},
        dim as (select round_even(longitude, 4) as lon, round_even(latitude, 4) as lat, min(station) as station
                from stations group by all),
        src as (select l_orderkey, l_partkey, l_extendedprice, latitude + 0.00001::double as lat, longitude as lon
                from lineitem join stations on station = l_suppkey)
        select l_orderkey, l_partkey, l_extendedprice, d.station as "Station_Name" from src s join dim d
          on round_even(s.lon, 4) = d.lon and round_even(s.lat, 4) = d.lat""",
)
def q_station_by_rounded_coordinates(spark, sf):
    places = stations(spark, sf)
    rows = table(spark, sf, "lineitem").join(places, F.col("l_suppkey") == F.col("station"))
    rows = rows.select(
        "l_orderkey", "l_partkey", "l_extendedprice", F.col("longitude").alias("Longitude"),
        (F.col("latitude") + F.lit(0.00001)).alias("Latitude"),
    )
    found = station_at_rounded(rows, places.withColumn("order", F.col("station")), "order")
    return found.select("l_orderkey", "l_partkey", "l_extendedprice", "Station_Name")


@query(
    "station_by_exact_coordinates",
    f"""with {STATIONS_SQL}, src as (
          select l_orderkey, l_partkey, l_extendedprice, longitude as lon,
                 case when l_tax > 0 then latitude else latitude + 100 end as lat
          from lineitem join stations on station = l_suppkey)
        select l_orderkey, l_partkey, l_extendedprice, s.station
        from src left join stations s on s.longitude = lon and s.latitude = lat""",
)
def q_station_by_exact_coordinates(spark, sf):
    places = stations(spark, sf)
    rows = table(spark, sf, "lineitem").join(places, F.col("l_suppkey") == F.col("station"))
    lat = F.when(F.col("l_tax") > 0, F.col("latitude")).otherwise(F.col("latitude") + 100)
    rows = rows.select(
        "l_orderkey", "l_partkey", "l_extendedprice",
        lat.alias("Latitude"), F.col("longitude").alias("Longitude"),
    )
    found = station_at_exact(rows, places)
    return found.select("l_orderkey", "l_partkey", "l_extendedprice", "station")
