"""Queries over array files, two-row matrices, the ledger, skipped rows and bucketed tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from airloom.catalog.base import CELL_SERIES_SQL, cell_series, observations, query, r6, stations, table
from airloom.operators.assemble import station_at_rounded
from airloom.operators.reshape import AEROSOL_VARIABLES
from airloom.session import fresh_path, materialize
from airloom.sources.arrays import read_arrays, write_arrays
from airloom.sources.bucketed import left_join_chain, write_bucketed
from airloom.functions.dates import granule_date
from airloom.sources.matrices import read_two_row_matrices, write_two_row_matrices
from airloom.sources.skips import Skips
from airloom.streaming.ledger import Ledger, ingest

_HEIGHT, _WIDTH = 9, 11


def _hourly_grid(spark, sf):
    """Events as a grid: hour of the event, a cell by its user, one variable per type."""
    place = F.pmod(F.col("station"), F.lit(_HEIGHT * _WIDTH))
    grid = observations(spark, sf).select(
        F.date_trunc("hour", F.col("date")).cast("timestamp_ntz").alias("time"),
        (F.lit(36.0) + F.floor(place / _WIDTH) * F.lit(0.5)).alias("lat"),
        (F.lit(26.0) + F.pmod(place, F.lit(_WIDTH)) * F.lit(0.25)).alias("lon"),
        "variable", "value",
    )
    means = grid.groupBy("time", "lat", "lon", "variable").agg(F.avg("value").alias("value"))
    return means.withColumn("day", F.date_format("time", "yyyy-MM-dd"))


_GRID_SQL = f"""select date_trunc('hour', ts) as time,
    (user_id % {_HEIGHT * _WIDTH})::bigint as cell_id, event_type as variable, round(avg(value), 6) as value
    from events group by all"""


def _grid_files(spark, sf):
    folder = fresh_path(spark, "arrays")
    lats = [36.0 + 0.5 * i for i in range(_HEIGHT)]
    lons = [26.0 + 0.25 * i for i in range(_WIDTH)]
    written = write_arrays(_hourly_grid(spark, sf), folder, "day", lats, lons)
    assert written.agg(F.count("*")).first()[0] > 0
    return read_arrays(spark, folder, 24 * 3 * _WIDTH)


@query("array_files", _GRID_SQL)
def q_array_files(spark, sf):
    """A file a day, chunks of three latitudes."""
    found = _grid_files(spark, sf).where("value is not null")
    return found.select("time", "cell_id", "variable", r6("value").alias("value"))


@query("array_files_filtered", f"select * from ({_GRID_SQL}) where variable = 'view' and hour(time) < 6 and cell_id // {_WIDTH} >= 6 and time >= timestamp '2024-01-10'")
def q_array_files_filtered(spark, sf):
    """The filters reach the source, which plans only the chunks that can match."""
    found = _grid_files(spark, sf).where("value is not null and variable = 'view' and lat >= 39.0")
    found = found.where("time >= timestamp_ntz'2024-01-10 00:00:00' and hour(time) < 6")
    return found.select("time", "cell_id", "variable", r6("value").alias("value"))


@query(
    "matrix_two_header_rows",
    """select user_id % 7 as file, user_id::varchar as station, event_type as variable, ts::date as date, round(max(value), 6) as value
       from events group by all""",
)
def q_matrix_two_header_rows(spark, sf):
    """Matrices of seven groups of stations, each with columns of its own."""
    folder = fresh_path(spark, "matrices")
    daily = observations(spark, sf).groupBy(
        F.pmod("station", F.lit(7)).alias("file"), "station", "variable", F.to_date("date").alias("date")
    ).agg(F.max("value").alias("value"))
    write_two_row_matrices(daily, folder, "file")
    found = read_two_row_matrices(spark, folder).where("value is not null")
    return found.select(
        F.regexp_extract("path", "file=([0-9]+)", 1).cast("long").alias("file"), "station", "variable",
        F.col("date").cast("date").alias("date"), F.round(F.col("value").cast("double"), 6).alias("value"),
    )


_LEDGER_SQL = f"""with {CELL_SERIES_SQL}
    select cell_id as station, time, variable, round(value, 6) as value from cell_series"""


@query("facts_ledger", _LEDGER_SQL)
def q_facts_ledger(spark, sf):
    """Files taken in several batches, one of them killed before its commit, then compacted."""
    folder, root, log = (fresh_path(spark, n) for n in ("grid-files", "ledgered", "stream"))
    grid = cell_series(spark, sf)
    grid.withColumn("file", F.col("time")).repartition("file").write.partitionBy("file").parquet(folder)
    ledger = Ledger(spark, root)

    def facts(rows):
        return rows.select(F.pmod("cell_id", F.lit(40)).alias("station_group"), "cell_id", "time", "variable", "value")

    schema = "cell_id long, time int, variable string, value double, station_group int"
    # What a killed batch leaves behind.
    ledger.write(facts(spark.read.schema(grid.schema).parquet(folder)).limit(50), "station_group")
    ingest(spark, folder, grid.schema, facts, ledger, log, "station_group", files_per_batch=3)
    ledger.compact(schema, "station_group")
    found = ledger.read(schema)
    return found.select(F.col("cell_id").alias("station"), "time", "variable", r6("value").alias("value"))


_SKIP_SQL = """with granules as (select *, case event_type when 'click' then 'AOT_Land_Mean' when 'view' then 'AOT_Ocean_Mean' else event_type end as variable,
        case when event_id % 4 = 0 then 'swath.nc' else 'X.A' || (2019000 + 1 + user_id % 365)::varchar || '.h.nc' end as path,
        case when event_id % 5 > 0 then value end as lat from events),
    judged as (select *, case when not regexp_matches(path, 'A[0-9]{7}') then 'no date in path'
        when variable not in ({variables}) then 'variable not listed' when lat is null then 'no coordinates' end as reason,
        case when not regexp_matches(path, 'A[0-9]{7}') then path when variable not in ({variables}) then variable else path end as item from granules)"""


def _granule_rows(spark, sf):
    rows = observations(spark, sf)
    listed = F.when(F.col("variable") == "click", AEROSOL_VARIABLES[0]).when(F.col("variable") == "view", AEROSOL_VARIABLES[1])
    dated = F.concat(F.lit("X.A"), (F.lit(2019001) + F.pmod("station", F.lit(365))).cast("string"), F.lit(".h.nc"))
    return rows.select(
        "event_id", F.coalesce(listed, F.col("variable")).alias("variable"),
        F.when(F.col("event_id") % 4 == 0, F.lit("swath.nc")).otherwise(dated).alias("path"),
        F.when(F.col("event_id") % 5 > 0, F.col("value")).alias("lat"),
    )


def _skip_sql(final: str) -> str:
    names = ", ".join(f"'{v}'" for v in AEROSOL_VARIABLES)
    text = _SKIP_SQL.replace("{variables}", names)
    return text.replace("AOT_Land_Mean", AEROSOL_VARIABLES[0]).replace("AOT_Ocean_Mean", AEROSOL_VARIABLES[1]) + final


def _skipping(spark, sf):
    """Granule rows kept, and the channel, filled by the pass that keeps them."""
    skips = Skips()
    kept = skips.drop(
        _granule_rows(spark, sf),
        {
            "no date in path": (granule_date(F.col("path")).isNull(), F.col("path")),
            "variable not listed": (~F.col("variable").isin(*AEROSOL_VARIABLES), F.col("variable")),
            "no coordinates": (F.col("lat").isNull(), F.col("path")),
        },
    )
    return materialize(kept, "granules"), skips


@query("skipped_rows", _skip_sql(" select coalesce(reason, 'kept') as reason, count(*) as rows from judged group by 1"))
def q_skipped_rows(spark, sf):
    kept, skips = _skipping(spark, sf)
    counts = skips.counts(spark)
    return counts.unionByName(kept.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("kept").alias("reason"), "rows"))


@query("skipped_items", _skip_sql(" select distinct reason, item from judged where reason is not null"))
def q_skipped_items(spark, sf):
    return _skipping(spark, sf)[1].items(spark)


@query(
    "unmatched_stations",
    """select 'no station at coordinates' as reason, 'lat ' || s_nationkey as item from supplier where s_suppkey % 3 > 0 group by all""",
)
def q_unmatched_stations(spark, sf):
    """Coordinates no station of the dimension has, listed by the pass that joins the names."""
    places = stations(spark, sf)
    nation = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("station"), "s_nationkey")
    rows = places.join(nation, "station").withColumnsRenamed({"latitude": "Latitude", "longitude": "Longitude"})
    known = places.where("station % 3 = 0").withColumn("order", F.col("station"))
    named = station_at_rounded(rows.drop("station"), known.withColumn("station", F.col("station").cast("string")), "order", unmatched="keep")
    skips = Skips()
    label = F.concat(F.lit("lat "), F.col("s_nationkey").cast("string"))
    kept = skips.drop(named, {"no station at coordinates": (F.col("Station_Name").isNull(), label)})
    materialize(kept, "named")
    return skips.items(spark)


@query(
    "bucketed_join_chain",
    """with daily as (select user_id as station, ts::date as date,
          max(value) filter (event_type = 'click') as a, max(value) filter (event_type = 'view') as b, min(value) as c from events group by all)
       select station, date, round(a, 6) as a, round(b, 6) as b, round(c, 6) as c,
              round(lag(c) over (partition by station order by date), 6) as previous from daily where a is not null""",
)
def q_bucketed_join_chain(spark, sf):
    """Three station tables joined and lagged as they lie."""
    rows = observations(spark, sf).withColumn("date", F.to_date("date"))

    def saved(name, value, condition="true"):
        daily = rows.where(condition).groupBy("station", "date").agg(value.alias(name))
        return write_bucketed(daily, f"station_{name}_{uuid.uuid4().hex}", buckets=8)

    tables = [
        saved("a", F.max("value"), "variable = 'click'"), saved("b", F.max("value"), "variable = 'view'"), saved("c", F.min("value")),
    ]
    joined = left_join_chain(tables, ["station", "date"])
    lagged = joined.withColumn("previous", F.lag("c").over(Window.partitionBy("station").orderBy("date")))
    return lagged.select("station", "date", *[r6(x).alias(x) for x in ("a", "b", "c", "previous")])
