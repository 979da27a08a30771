"""Queries over sources and sinks: written to the shared scratch folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from airloom.catalog.base import (
    CELL_SERIES_SQL,
    CELLS_SQL,
    NEAREST_SQL,
    STATIONS_SQL,
    cell_series,
    cells,
    observations,
    query,
    r6,
    stations,
    table,
)
from airloom.catalog.models import SCORES_SQL, Y_SQL, long_scores
from airloom.operators.assemble import dedup_dimension, union_by_name
from airloom.operators.boosting import Boosting, fit, load_model, predict, save_model
from airloom.operators.calendar import daily_mean
from airloom.operators.metrics import score_table
from airloom.operators.reshape import AEROSOL_VARIABLES
from airloom.operators.scaling import fit_scale
from airloom.operators.spatial import nearest_cells
from airloom.session import fresh_path, materialize
from airloom.sources.files import apply_to_folder, read_combined, read_station_files, read_tree
from airloom.sources.grids import (
    granule_observations,
    grid_observations,
    read_stations,
    station_dimension,
    with_coordinates,
)
from airloom.sources.sinks import (
    CSV_TIMESTAMP,
    append_facts,
    export_csv,
    replace_facts,
    write_per_metric,
    write_per_station,
    write_predictions,
)
from airloom.streaming.ingest import ingest_grid_files

LONG_SQL = """select user_id as station, ts as date, event_type as variable, value, event_id
from events"""


@query("read_tree", "select event_id, value, event_type as folder from events")
def q_read_tree(spark, sf):
    path = fresh_path(spark, "tree")
    events = table(spark, sf, "events").select("event_id", "value", "event_type")
    events.write.partitionBy("event_type").parquet(path)
    found = read_tree(spark, path, events.select("event_id", "value").schema)
    folder = F.regexp_extract("path", "event_type=([^/]+)", 1)
    return found.select("event_id", "value", folder.alias("folder"))


@query(
    "grid_long_names",
    """select case l_returnflag when 'A' then 'Surface pressure'
                                when 'R' then 'Total cloud cover'
                                else l_returnflag end as variable,
              count(*) as n, min(l_extendedprice) as low, max(l_extendedprice) as high
       from lineitem group by 1""",
)
def q_grid_long_names(spark, sf):
    flag = F.col("l_returnflag")
    long_name = F.when(flag == "A", "Surface pressure").when(flag == "R", "Total cloud cover")
    grid = table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("time"),
        F.col("l_partkey").alias("cell_id"),
        F.lit(36.0).alias("lat"),
        F.lit(26.0).alias("lon"),
        long_name.alias("long_name"),
        flag.alias("variable"),
        F.col("l_extendedprice").alias("value"),
    )
    return (
        grid_observations(grid)
        .groupBy("variable")
        .agg(F.count("value").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    )


def _swath(spark, sf):
    """Orders as swath cells: one granule per month, five variables of which three are known."""
    names = F.create_map(
        *[
            x
            for key, name in zip(("1-URGENT", "2-HIGH", "3-MEDIUM"), AEROSOL_VARIABLES)
            for x in (F.lit(key), F.lit(name))
        ]
    )
    month = F.trunc("o_orderdate", "month")
    mark = F.when(
        F.col("o_orderstatus") != "P",
        F.concat(F.lit("MOD08.A"), F.date_format(month, "yyyyDDD"), F.lit(".h")),
    ).otherwise(F.lit("undated"))
    variable = F.coalesce(names[F.col("o_orderpriority")], F.col("o_orderpriority"))
    return table(spark, sf, "orders").select(
        mark.alias("granule"),
        F.col("o_orderkey").alias("cell_id"),
        F.col("o_custkey").cast("double").alias("lat"),
        F.when(F.col("o_custkey") > 10, F.col("o_custkey").cast("double")).alias("lon"),
        variable.alias("variable"),
        F.col("o_totalprice").alias("value"),
    )


@query(
    "granule_files",
    """select o_orderkey as cell_id, date_trunc('month', o_orderdate)::date as date, value, variable
       from (select *, o_totalprice as value, case o_orderpriority
               when '1-URGENT' then 'Aerosol_Optical_Thickness_550_Land_Mean'
               when '2-HIGH' then 'Aerosol_Optical_Thickness_550_Ocean_Mean'
               when '3-MEDIUM' then 'Aerosol_Optical_Thickness_550_Ocean_Standard_Deviation'
               end as variable from orders)
       where variable is not null and o_orderstatus <> 'P' and o_custkey > 10""",
)
def q_granule_files(spark, sf):
    path = fresh_path(spark, "granules")
    swath = _swath(spark, sf)
    swath.hint("rebalance", "granule").write.partitionBy("granule").parquet(path)
    files = read_tree(spark, path, swath.drop("granule").schema)
    return granule_observations(files, F.col("path")).select("cell_id", "date", "variable", "value")


@query(
    "coordinate_alias",
    f"with {STATIONS_SQL} select station, latitude as lat, longitude as lon from stations",
)
def q_coordinate_alias(spark, sf):
    odd = stations(spark, sf).withColumnsRenamed({"latitude": "Latitude", "longitude": "Lon"})
    return with_coordinates(odd)


@query(
    "station_source",
    f"with {STATIONS_SQL} select station::varchar as station, latitude, longitude from stations",
)
def q_station_source(spark, sf):
    path = fresh_path(spark, "stations")
    table_ = stations(spark, sf).select("longitude", "station", "latitude")
    table_.write.option("header", True).csv(path)
    return read_stations(spark, path)


@query(
    "station_dimension",
    f"""with {STATIONS_SQL}
        select 'canakkale_ili_' || s_nationkey as station,
               arg_max(latitude, s_suppkey) as latitude, arg_max(longitude, s_suppkey) as longitude
        from supplier join stations on s_suppkey = station group by 1""",
)
def q_station_dimension(spark, sf):
    nation = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    named = stations(spark, sf).join(nation, F.col("station") == F.col("s_suppkey"))
    raw = named.select(
        F.concat(F.lit("ÇANAKKALE  İli\t"), F.col("s_nationkey").cast("string")).alias("station"),
        "latitude",
        "longitude",
        "s_suppkey",
    )
    return station_dimension(raw, "s_suppkey")


@query(
    "dimension_first",
    f"""with {STATIONS_SQL}
        select s_nationkey as nation, arg_min(latitude, s_suppkey) as latitude
        from supplier join stations on s_suppkey = station group by 1""",
)
def q_dimension_first(spark, sf):
    nation = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    named = stations(spark, sf).join(nation, F.col("station") == F.col("s_suppkey"))
    kept = dedup_dimension(named.select("nation", "s_suppkey", "latitude"), ["nation"], "s_suppkey")
    return kept.select("nation", "latitude")


@query(
    "facts_replace",
    """select event_type as station, ts as date, event_id,
              case when event_type = 'click' then value * 2 else value end as value from events""",
)
def q_facts_replace(spark, sf):
    path = fresh_path(spark, "facts")
    facts = observations(spark, sf).select(
        F.col("variable").alias("station"), "date", "event_id", "value"
    )
    replace_facts(facts, path)
    again = facts.where("station = 'click'").withColumn("value", F.col("value") * 2)
    replace_facts(again, path)
    return spark.read.schema(facts.schema).parquet(path)


@query("facts_append", LONG_SQL)
def q_facts_append(spark, sf):
    path = fresh_path(spark, "facts")
    facts = observations(spark, sf)
    append_facts(facts.where("value < 50"), path, "variable")
    append_facts(facts.where("value >= 50"), path, "variable")
    return spark.read.schema(facts.schema).parquet(path)


@query(
    "facts_stream",
    f"""with {STATIONS_SQL}, {CELLS_SQL}, {CELL_SERIES_SQL}, {NEAREST_SQL}
        select station, time, variable,
               round(case when count(value) = 4
                     then sum(value / sqrt(d2)) / sum(1 / sqrt(d2)) end, 6) as value
        from nearest join cell_series using (cell_id) group by all""",
)
def q_facts_stream(spark, sf):
    folder, facts, log = (fresh_path(spark, n) for n in ("grid-files", "facts", "stream"))
    grid = cell_series(spark, sf).join(cells(spark, sf), "cell_id").select(
        "time", "cell_id", "lat", "lon", F.lit(None).cast("string").alias("long_name"),
        "variable", "value",
    )
    # One file per year: all cells of a time step are in one file.
    grid.withColumn("file", F.col("time")).repartition("file").write.partitionBy("file").parquet(folder)
    near = materialize(nearest_cells(cells(spark, sf), stations(spark, sf)), "neighbours")
    ingest_grid_files(spark, folder, grid.schema, near, facts, log)
    found = spark.read.parquet(facts)
    return found.select("station", "time", "variable", r6("value").alias("value"))


@query("export_csv", LONG_SQL)
def q_export_csv(spark, sf):
    path = fresh_path(spark, "export")
    facts = observations(spark, sf)
    export_csv(facts, path)
    reader = spark.read.schema(facts.schema).option("header", True)
    return reader.option("timestampNTZFormat", CSV_TIMESTAMP).csv(path)


def _kinds(facts) -> list[str]:
    """Variables that occur; a station's files are named by them here."""
    return [r["variable"] for r in facts.select("variable").distinct().collect()]


@query("station_files", "select event_type as station, ts as date, value from events")
def q_station_files(spark, sf):
    path = fresh_path(spark, "station-files")
    facts = observations(spark, sf)
    text = facts.select(F.col("date").cast("string").alias("date"), "value", "variable")
    for name in _kinds(facts):
        text.where(F.col("variable") == name).drop("variable").write.parquet(f"{path}/{name}.v1.parquet")
    return read_station_files(spark, path, text.drop("variable").schema)


@query(
    "combined_folder",
    """select event_id, value, case when event_type = 'click' then props end as props from events""",
)
def q_combined_folder(spark, sf):
    path = fresh_path(spark, "combined")
    events = table(spark, sf, "events")
    click = F.col("event_type") == "click"
    events.where(click).select("event_id", F.col("value").alias("value "), "props").write.parquet(f"{path}/a.parquet")
    events.where(~click).select(F.col("event_id").alias(" event_id"), "value").write.parquet(f"{path}/b.parquet")
    return read_combined(spark, path)


@query("per_station_output", LONG_SQL)
def q_per_station_output(spark, sf):
    path = fresh_path(spark, "per-station")
    facts = observations(spark, sf)
    write_per_station(facts, path, "variable")
    return spark.read.schema(facts.schema).parquet(path)


@query(
    "per_metric_output",
    f"""with s as (select event_type as station, {Y_SQL},
                          lag(value) over (partition by event_type order by ts, event_id) as previous from events),
        g as (select station, {SCORES_SQL} from s group by 1),
        o as (select {Y_SQL}, lag(value) over (order by event_type, ts, event_id) as previous from events),
        w as (select {SCORES_SQL} from o)
        {long_scores("g", "station")} union all {long_scores("w", "'Overall'")}""",
)
def q_per_metric_output(spark, sf):
    path = fresh_path(spark, "metrics")
    scored = observations(spark, sf).withColumn("predicted", F.col("value") * 0.9 + 1)
    scored = scored.drop("station").withColumnRenamed("variable", "station")
    scores = score_table(scored, ["station"], ["date", "event_id"], "station", actual="value")
    write_per_metric(scores, path)
    found = spark.read.parquet(path)
    return found.select(*[c for c in scores.columns if c != "Value"], r6("Value").alias("Value"))


@query(
    "predictions_output",
    "select user_id as station, ts as date, value as actual, value * 0.9::double as predicted, event_id from events",
)
def q_predictions_output(spark, sf):
    path = fresh_path(spark, "predictions")
    facts = observations(spark, sf).withColumn("predicted", F.col("value") * 0.9)
    facts = facts.withColumnRenamed("value", "actual").drop("variable")
    write_predictions(facts, path, ["station", "date"], "actual", "predicted")
    return spark.read.parquet(path)


@query(
    "tables_of_schema",
    """with daily as (
           select event_type as station, ts::date as date, avg(value) as value
           from events group by all),
       days as (
           select station, unnest(generate_series(min(date), max(date), interval 1 day))::date as date
           from daily group by station)
       select station, date, round(value, 6) as value from days left join daily using (station, date)""",
)
def q_tables_of_schema(spark, sf):
    facts = observations(spark, sf)
    path = fresh_path(spark, "schema")
    for name in _kinds(facts):
        facts.where(F.col("variable") == name).select("date", "value").write.parquet(f"{path}/{name}")
    schema = facts.select("date", "value").schema
    daily = apply_to_folder(spark, path, schema, lambda df: daily_mean(df, ["value"]))
    return daily.withColumn("value", r6("value"))


@query(
    "union_by_name",
    """select event_id, case when event_type <> 'view' then value end as value,
              case when event_type = 'view' then props end as props
       from events""",
)
def q_union_by_name(spark, sf):
    events = table(spark, sf, "events")
    kind = F.col("event_type")
    return union_by_name(
        [
            events.where(kind == "click").select("event_id", "value"),
            events.where(kind == "view").select("props", "event_id"),
            events.where(~kind.isin("click", "view")).select("value", "event_id"),
        ]
    )


@query(
    "model_store",
    """select 'l_quantity' as "column", 'feature' as role, round(avg(l_quantity), 6) as mean,
              round(stddev_pop(l_quantity), 6) as deviation from lineitem
       union all select 'l_discount', 'feature', round(avg(l_discount), 6), round(stddev_pop(l_discount), 6) from lineitem
       union all select 'l_extendedprice', 'target', round(avg(l_extendedprice), 6), round(stddev_pop(l_extendedprice), 6) from lineitem
       union all select 'l_extendedprice', 'loaded', 0.0::double, 1.0::double""",
)
def q_model_store(spark, sf):
    path = fresh_path(spark, "model")
    lines = table(spark, sf, "lineitem")
    features, target = ["l_quantity", "l_discount"], "l_extendedprice"
    scale = fit_scale(lines, [*features, target])
    setting = Boosting(rounds=3, depth=3, rate=0.3)
    model = fit(lines, ["l_orderkey", "l_linenumber"], features, target, setting, scale)
    save_model(spark, model, scale, target, path)
    loaded, scale, target = load_model(spark, path)
    rows = [(c, "target" if c == target else "feature", *scale[c]) for c in [*loaded.features, target]]
    found = spark.createDataFrame(rows, "column string, role string, mean double, deviation double")
    both = predict(model, lines.select(*features), target, scale, "first")
    again = predict(loaded, both, target, scale, "second")
    # The loaded model predicts what the saved one did, and not the same for all rows.
    gap = again.agg(F.max(F.abs(F.col("first") - F.col("second"))), F.stddev_pop("second") > 0)
    check = gap.toDF("mean", "varies").select(
        F.lit(target).alias("column"), F.lit("loaded").alias("role"), "mean",
        F.col("varies").cast("double").alias("deviation"),
    )
    found = found.unionByName(check)
    return found.select("column", "role", r6("mean").alias("mean"), r6("deviation").alias("deviation"))
