"""Queries over quality rules, ranks, imputation and statistics."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import functions as F

from airloom.catalog.base import GAPPY_SQL, gappy, observations, query, r6, table
from airloom.functions.cells import (
    PRECIPITATION_SENTINEL,
    missing_percent,
    numeric_columns,
    other_columns,
    round_even,
    sentinel_to_null,
    valid_percent,
)
from airloom.operators.impute import contiguous_blocks, imputable_columns, knn_impute
from airloom.operators.ordered import trim_null_runs, with_previous
from airloom.operators.quality import (
    blank_nitrogen_conflicts,
    blank_particle_conflicts,
    drop_empty_rows,
    drop_incomplete_rows,
    drop_nitrogen_conflicts,
    drop_particle_conflicts,
    keep_filled_rows,
    measured_at,
)
from airloom.operators.ranks import ecdf_points, percentiles, prune_tails
from airloom.operators.stats import analysed_columns, correlations, summary

# Columns that together identify a line.
LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
_KEY_SQL = ", ".join(LINE_KEY)


@query(
    "measured_stations",
    """select o_orderkey, o_custkey as station, case when o_orderstatus = 'F' then o_totalprice end as "PM10",
              case when o_orderpriority = '1-URGENT' then o_totalprice end as "PM2.5"
       from orders where o_custkey in (
         select o_custkey from orders group by 1
         having count(*) filter (where o_orderstatus = 'F') > 0
            and count(*) filter (where o_orderpriority = '1-URGENT') = 0)""",
)
def q_measured_stations(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("station"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("PM10"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).alias("PM2.5"),
    )
    return measured_at(rows)


@query(
    "sentinel_to_null",
    """select event_id, case when value < 1 then null else value end as rain from events""",
)
def q_sentinel_to_null(spark, sf):
    rain = F.when(F.col("value") < 1, F.lit(PRECIPITATION_SENTINEL)).otherwise(F.col("value"))
    return observations(spark, sf).select("event_id", sentinel_to_null(rain).alias("rain"))


@query(
    "drop_empty_rows",
    """select case when l_tax > 0.04 then l_tax end as a, case when l_discount > 0.05 then l_discount end as b
       from lineitem where l_tax > 0.04 or l_discount > 0.05""",
)
def q_drop_empty_rows(spark, sf):
    return drop_empty_rows(_sparse(spark, sf).select("a", "b"))


def _sparse(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.when(F.col("l_tax") > 0.04, F.col("l_tax")).alias("a"),
        F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("b"),
        F.when(F.col("l_quantity") > 25, F.col("l_quantity")).alias("c"),
        F.when(F.col("l_linenumber") > 3, F.col("l_linenumber")).alias("d"),
        F.when(F.col("l_returnflag") == "A", F.lit("A")).alias("e"),
    )


_SPARSE_SQL = """sparse as (
    select case when l_tax > 0.04 then l_tax end as a, case when l_discount > 0.05 then l_discount end as b,
           case when l_quantity > 25 then l_quantity end as c,
           case when l_linenumber > 3 then l_linenumber end as d,
           case when l_returnflag = 'A' then 'A' end as e from lineitem)"""


@query(
    "drop_incomplete_rows",
    f"""with {_SPARSE_SQL} select * from sparse
        where a is not null and b is not null and c is not null and d is not null and e is not null""",
)
def q_drop_incomplete_rows(spark, sf):
    return drop_incomplete_rows(_sparse(spark, sf))


@query("drop_rows_without_target", f"with {_SPARSE_SQL} select * from sparse where c is not null")
def q_drop_rows_without_target(spark, sf):
    return drop_incomplete_rows(_sparse(spark, sf), ["c"])


@query(
    "keep_filled_rows",
    f"""with {_SPARSE_SQL} select * from sparse
        where (a is not null)::int + (b is not null)::int + (c is not null)::int
              + (d is not null)::int + (e is not null)::int >= 2""",
)
def q_keep_filled_rows(spark, sf):
    return keep_filled_rows(_sparse(spark, sf), allowed_empty=3)


def _pollutants(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey",
        F.col("l_quantity").alias("PM10"),
        F.when(F.col("l_linenumber") < 7, F.col("l_linenumber").cast("double")).alias("PM2.5"),
        F.col("l_discount").alias("NO2"),
        F.col("l_tax").alias("NO"),
        F.when(F.col("l_quantity") > 2, F.col("l_quantity") / 100).alias("NOX"),
    )


_POLLUTANTS_SQL = """p as (
    select l_orderkey, l_partkey, l_quantity as "PM10",
           case when l_linenumber < 7 then l_linenumber::double end as "PM2.5",
           l_discount as "NO2", l_tax as "NO",
           case when l_quantity > 2 then l_quantity / 100 end as "NOX" from lineitem)"""


@query(
    "drop_particle_conflicts",
    f"""with {_POLLUTANTS_SQL} select * from p where "PM10" >= "PM2.5" and "PM10" <= 10 * "PM2.5" """,
)
def q_drop_particle_conflicts(spark, sf):
    return drop_particle_conflicts(_pollutants(spark, sf), "PM10", "PM2.5")


@query(
    "drop_nitrogen_conflicts",
    f"""with {_POLLUTANTS_SQL} select * from p
        where "NO2" + "NO" <= "NOX" and "NOX" <= 2 * ("NO2" + "NO")""",
)
def q_drop_nitrogen_conflicts(spark, sf):
    return drop_nitrogen_conflicts(_pollutants(spark, sf), "NO2", "NO", "NOX")


@query(
    "blank_particle_conflicts",
    f"""with {_POLLUTANTS_SQL},
        q as (select *, coalesce("PM10" < "PM2.5" or "PM10" > 10 * "PM2.5", false) as bad from p)
        select l_orderkey, l_partkey, case when not bad then "PM10" end as "PM10",
               case when not bad then "PM2.5" end as "PM2.5", "NO2", "NO", "NOX" from q""",
)
def q_blank_particle_conflicts(spark, sf):
    return blank_particle_conflicts(_pollutants(spark, sf), "PM10", "PM2.5")


@query(
    "blank_nitrogen_conflicts",
    f"""with {_POLLUTANTS_SQL},
        q as (select *, coalesce("NO2" + "NO" > "NOX" or "NOX" > 2 * ("NO2" + "NO"), false) as bad from p)
        select l_orderkey, l_partkey, "PM10", "PM2.5", case when not bad then "NO2" end as "NO2",
               case when not bad then "NO" end as "NO", case when not bad then "NOX" end as "NOX" from q""",
)
def q_blank_nitrogen_conflicts(spark, sf):
    return blank_nitrogen_conflicts(_pollutants(spark, sf), "NO2", "NO", "NOX")


@query(
    "trim_null_runs",
    f"""with {GAPPY_SQL}
        select station, date, variable, event_id, value from (
          select *, sum((value is null)::int) over (
            partition by station order by date, event_id rows between 9 preceding and current row) as missing
          from gappy) where missing < 10""",
)
def q_trim_null_runs(spark, sf):
    return trim_null_runs(gappy(spark, sf), "value", ["station"], ["date", "event_id"])


@query(
    "trim_short_null_runs",
    f"""with {GAPPY_SQL}
        select station, date, variable, event_id, value from (
          select *, sum((value is null)::int) over (
            partition by station order by date, event_id rows between 2 preceding and current row) as missing
          from gappy) where missing < 3""",
)
def q_trim_short_null_runs(spark, sf):
    return trim_null_runs(gappy(spark, sf), "value", ["station"], ["date", "event_id"], 3)


@query(
    "previous_value",
    """select event_id, lag(value) over w as previous, abs(value - lag(value) over w) as step
       from events window w as (partition by user_id order by ts, event_id)""",
)
def q_previous_value(spark, sf):
    facts = with_previous(
        observations(spark, sf), ["station"], ["date", "event_id"], {"previous": "value"}
    )
    step = F.abs(F.col("value") - F.col("previous"))
    return facts.select("event_id", "previous", step.alias("step"))


@query(
    "ecdf_points",
    """select distinct event_type as variable, value,
              round(cume_dist() over (partition by event_type order by value), 6) as ecdf
       from events""",
)
def q_ecdf_points(spark, sf):
    points = ecdf_points(observations(spark, sf), "value", ["variable"])
    return points.select("variable", "value", r6("ecdf").alias("ecdf"))


def _prune_sql(column: str, name: str) -> str:
    return f"""case when not ({column}_low or {column}_high) then {column} end as "{name}" """


@query(
    "prune_tails",
    f"""with r as (
          select *, rank() over (order by l_extendedprice) / count(*) over ()::double <= 0.001 as l_extendedprice_low,
                 cume_dist() over (order by l_extendedprice) >= 1 - 0.001::double as l_extendedprice_high,
                 rank() over (order by l_quantity) / count(*) over ()::double <= 0.001 as l_quantity_low,
                 cume_dist() over (order by l_quantity) >= 1 - 0.001::double as l_quantity_high
          from lineitem)
        select l_orderkey, l_partkey, l_shipdate, {_prune_sql("l_extendedprice", "PM10")},
               {_prune_sql("l_quantity", "PM2.5")} from r""",
)
def q_prune_tails(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_shipdate",
        F.col("l_extendedprice").alias("PM10"), F.col("l_quantity").alias("PM2.5"),
    )
    return prune_tails(lines)


@query(
    "percentiles",
    """select l_returnflag as flag, count(*) as n, round(quantile_cont(l_extendedprice, 0.2), 6) as p20,
              round(quantile_cont(l_extendedprice, 0.5), 6) as p50,
              round(quantile_cont(l_extendedprice, 0.8), 6) as p80
       from lineitem group by 1""",
)
def q_percentiles(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_returnflag", "flag")
    found = percentiles(lines, "l_extendedprice", [0.2, 0.5, 0.8], ["flag"])
    return found.select("flag", "n", *[r6(p).alias(p) for p in ("p20", "p50", "p80")])


_SUMMARY_PARTS = " union all ".join(
    f"""select '{c}' as "Metric", count(*) as total,
        round_even(count({c}) / count(*) * 100::double, 4) as valid_percent,
        round_even((count(*) - count({c})) / count(*) * 100::double, 4) as missing_percent,
        round_even(avg({c}), 4) as mean, round_even(stddev_samp({c}), 4) as std,
        round_even(min({c}), 4) as min, round_even(quantile_cont({c}, 0.2), 4) as p20,
        round_even(quantile_cont({c}, 0.4), 4) as p40, round_even(quantile_cont({c}, 0.5), 4) as p50,
        round_even(quantile_cont({c}, 0.6), 4) as p60, round_even(quantile_cont({c}, 0.8), 4) as p80,
        round_even(max({c}), 4) as max from s"""
    for c in ("l_quantity", "l_extendedprice", "tax")
)


@query(
    "summary",
    f"""with s as (select l_quantity, l_extendedprice, case when l_tax > 0 then l_tax end as tax from lineitem)
        {_SUMMARY_PARTS}""",
)
def q_summary(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax"),
        F.lit(None).cast("double").alias("empty"),
    )
    return summary(lines, ["l_quantity", "l_extendedprice", "tax", "empty"], decimals=4)


_CORR = ("l_quantity", "l_extendedprice", "tax")


@query(
    "correlations",
    "with s as (select l_quantity, l_extendedprice, case when l_tax > 0 then l_tax end as tax from lineitem) "
    + " union all ".join(
        f"select '{a}' as column_a, '{b}' as column_b, round(corr({a}, {b}), 6) as correlation from s"
        for a in _CORR
        for b in _CORR
    ),
)
def q_correlations(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax")
    )
    return correlations(lines, list(_CORR)).withColumn("correlation", r6("correlation"))


@query(
    "analysed_columns",
    """with s as (select (l_returnflag = 'A')::int as flag, l_quantity, 7 as constant,
                 case when l_linestatus = 'F' then 1 end as status from lineitem),
       v as (select var_samp(flag) as flag, var_samp(l_quantity) as l_quantity,
                    var_samp(constant) as constant, var_samp(status) as status,
                    bool_and(coalesce(flag in (0, 1), false)) as flag_binary,
                    bool_and(coalesce(l_quantity in (0, 1), false)) as quantity_binary,
                    bool_and(coalesce(status in (0, 1), false)) as status_binary from s)
       select 'l_quantity' as name from v where coalesce(l_quantity <> 0, true) and not quantity_binary
       union all select 'flag' from v where coalesce(flag <> 0, true) and not flag_binary
       union all select 'constant' from v where coalesce(constant <> 0, true)
       union all select 'status' from v where coalesce(status <> 0, true) and not status_binary""",
)
def q_analysed_columns(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_returnflag") == "A").cast("int").alias("flag"),
        "l_quantity",
        F.lit(7).alias("constant"),
        F.when(F.col("l_linestatus") == "F", 1).alias("status"),
        F.year("l_shipdate").alias("Year"),
    )
    return spark.createDataFrame([(c,) for c in analysed_columns(lines)], "name string")


@query(
    "column_kinds",
    """select count(*) as rows, count(l_returnflag) + count(l_linestatus) + count(l_shipdate) as others,
              count(l_orderkey) + count(l_partkey) + count(l_suppkey) + count(l_linenumber)
              + count(l_quantity) + count(l_extendedprice) + count(l_discount) + count(l_tax) as numbers
       from lineitem""",
)
def q_column_kinds(spark, sf):
    lines = table(spark, sf, "lineitem")
    cells = {"others": other_columns(lines), "numbers": numeric_columns(lines)}
    return lines.agg(
        F.count(F.lit(1)).alias("rows"),
        *[reduce(add, [F.count(c) for c in names]).alias(kind) for kind, names in cells.items()],
    )


@query(
    "missing_share",
    """select l_returnflag as flag, round(avg((l_tax = 0)::int) * 100, 6) as missing,
              round(avg((l_tax <> 0)::int) * 100, 6) as valid from lineitem group by 1""",
)
def q_missing_share(spark, sf):
    tax = F.when(F.col("l_tax") != 0, F.col("l_tax"))
    return table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("flag")).agg(
        r6(missing_percent(tax)).alias("missing"), r6(valid_percent(tax)).alias("valid")
    )


@query(
    "round_half_even",
    """select l_orderkey, l_partkey, l_linenumber, l_suppkey, round_even(l_quantity / 8, 2) as eighth
       from lineitem""",
)
def q_round_half_even(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
        round_even(F.col("l_quantity") / 8, 2).alias("eighth"),
    )


_BLOCKS_SQL = f"""numbered as (
    select *, row_number() over (order by {_KEY_SQL}) - 1 as position, count(*) over () as rows from lineitem),
  sized as (select *, greatest(1, rows // 1000) as blocks from numbered),
  blocked as (
    select *, case when position < (rows % blocks) * (rows // blocks + 1)
              then position // (rows // blocks + 1)
              else rows % blocks + (position - (rows % blocks) * (rows // blocks + 1)) // (rows // blocks)
              end as block from sized)"""


@query(
    "contiguous_blocks",
    f"with {_BLOCKS_SQL} select {_KEY_SQL}, position, block from blocked",
)
def q_contiguous_blocks(spark, sf):
    return contiguous_blocks(table(spark, sf, "lineitem").select(*LINE_KEY), LINE_KEY, 1000)


def _imputed_sql(column: str) -> str:
    """Missing cells of one column: mean of the five nearest donors of the block."""
    return f"""select position, avg({column}) as filled from (
        select p.position, d.{column},
               row_number() over (partition by p.position order by
                 ((p.l_quantity - d.l_quantity) * (p.l_quantity - d.l_quantity)
                  + (p.l_extendedprice - d.l_extendedprice) * (p.l_extendedprice - d.l_extendedprice)
                  + coalesce((p.discount - d.discount) * (p.discount - d.discount), 0)
                  + coalesce((p.tax - d.tax) * (p.tax - d.tax), 0))
                 * 4 / (2 + (p.discount is not null and d.discount is not null)::int
                          + (p.tax is not null and d.tax is not null)::int), d.position) as rank
        from cells p join cells d on p.block = d.block
        where p.{column} is null and d.{column} is not null) where rank <= 5 group by 1"""


@query(
    "knn_impute",
    f"""with {_BLOCKS_SQL},
        cells as (select *, case when l_discount > 0 then l_discount end as discount,
                         case when l_tax > 0 then l_tax end as tax from blocked),
        d as ({_imputed_sql("discount")}), t as ({_imputed_sql("tax")})
        select {_KEY_SQL}, l_quantity, round(coalesce(discount, d.filled), 6) as discount,
               round(coalesce(tax, t.filled), 6) as tax
        from cells left join d using (position) left join t using (position)""",
)
def q_knn_impute(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        *LINE_KEY, "l_quantity",
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("discount"),
        F.when(F.col("l_tax") > 0, F.col("l_tax")).alias("tax"),
    )
    keys = [k for k in LINE_KEY if k != "l_extendedprice"]
    columns = imputable_columns(lines, keys)
    filled = knn_impute(lines, sorted(columns, key=_FEATURE_ORDER.index), LINE_KEY, block_rows=1000)
    return filled.select(*LINE_KEY, "l_quantity", r6("discount").alias("discount"), r6("tax").alias("tax"))


# Order in which squared differences are added, the same in both engines.
_FEATURE_ORDER = ["l_quantity", "l_extendedprice", "discount", "tax"]
