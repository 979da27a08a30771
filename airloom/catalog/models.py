"""Queries over splits, scaling, scores and the training protocols."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from airloom.catalog.base import STATIONS_SQL, observations, query, r6, stations, table
from airloom.catalog.boost_sql import boosted
from airloom.catalog.cleaning import LINE_KEY
from airloom.functions.dates import season
from airloom.operators.boosting import Boosting, mean_importances, search, settings_of, top_features
from airloom.operators.metrics import (
    distinct_stations,
    group_scores,
    score_table,
    season_scores,
)
from airloom.operators.scaling import apply_scale, fit_scale, fold_scales, unscaled
from airloom.operators.splits import (
    fold_sizes,
    k_folds,
    random_split,
    rows_not_in,
    season_split,
    text_hash,
)
from airloom.operators.trees import Model, grow
from airloom.plans.evaluation import (
    PREDICTED,
    Protocol,
    base_model,
    random_protocol,
    save_predictions,
    scores_at_stations,
    season_protocol,
    station_protocol,
    year_protocol,
)
from airloom.session import fresh_path, lookup_table


def _hash_sql(key: str) -> str:
    return f"('0x' || substr(md5({key}::varchar || '|42'), 1, 13))::bigint"


@query(
    "random_split",
    f"""select event_id, row_number() over (order by {_hash_sql("event_id")}, event_id)
               <= ceil(count(*) over () * 0.2) as is_test from events""",
)
def q_random_split(spark, sf):
    return random_split(observations(spark, sf), ["event_id"], order=text_hash(["event_id"])).select("event_id", "is_test")


_SEASON_SQL = """case when month(o_orderdate) in (12, 1, 2) then 'Winter'
    when month(o_orderdate) <= 5 then 'Spring' when month(o_orderdate) <= 8 then 'Summer'
    else 'Autumn' end"""


@query(
    "season_split",
    f"""with s as (select o_orderkey, {_SEASON_SQL} as "Season" from orders)
        select o_orderkey, "Season",
               row_number() over (partition by "Season" order by {_hash_sql("o_orderkey")}, o_orderkey)
               <= round_even(count(*) over (partition by "Season") * 0.2::double, 0) as is_test from s""",
)
def q_season_split(spark, sf):
    key = ["o_orderkey"]
    split = season_split(table(spark, sf, "orders"), key, "o_orderdate", order=text_hash(key))
    return split.select("o_orderkey", "Season", "is_test")


@query(
    "season_train_rows",
    f"""with s as (select o_orderkey, {_SEASON_SQL} as "Season" from orders)
        select o_orderkey from (select o_orderkey,
          row_number() over (partition by "Season" order by {_hash_sql("o_orderkey")}, o_orderkey) as place,
          round_even(count(*) over (partition by "Season") * 0.2::double, 0) as held from s)
        where place > held""",
)
def q_season_train_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    split = season_split(orders, ["o_orderkey"], "o_orderdate", order=text_hash(["o_orderkey"]))
    test = split.where("is_test")
    return rows_not_in(orders, test, ["o_orderkey"]).select("o_orderkey")


@query(
    "k_folds",
    f"""with p as (select event_id, row_number() over (order by {_hash_sql("event_id")}, event_id) - 1 as place,
                          count(*) over () as n from events)
        select event_id, (case when place < (n % 7) * (n // 7 + 1) then place // (n // 7 + 1)
                 else n % 7 + (place - (n % 7) * (n // 7 + 1)) // (n // 7) end)::int as fold from p""",
)
def q_k_folds(spark, sf):
    folds = k_folds(observations(spark, sf), ["event_id"], 7, order=text_hash(["event_id"]))
    return folds.select("event_id", "fold")


@query(
    "leave_one_year_out",
    """select y as fold, year(l_shipdate) = y as is_test, count(*) as rows
       from lineitem, (select distinct year(l_shipdate) as y from lineitem) group by all""",
)
def q_leave_one_year_out(spark, sf):
    years = table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"))
    return fold_sizes(years.select(F.col("year").cast("long").alias("fold")), "fold")


@query(
    "standard_scale",
    f"""with s as (select avg(l_quantity) as m, stddev_pop(l_quantity) as d,
                          avg(l_extendedprice) as me, stddev_pop(l_extendedprice) as de from lineitem)
        select {", ".join(LINE_KEY)}, round((l_quantity - m) / d, 6) as l_quantity_scaled,
               round((l_extendedprice - me) / de, 6) as l_extendedprice_scaled,
               0.0::double as constant_scaled, round(l_quantity, 6) as back
        from lineitem, s""",
)
def q_standard_scale(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("constant", F.lit(3.0))
    columns = ["l_quantity", "l_extendedprice", "constant"]
    scale = fit_scale(lines, columns)
    out = apply_scale(lines, scale)
    back = r6(unscaled(F.col("l_quantity_scaled"), "l_quantity", scale)).alias("back")
    return out.select(*LINE_KEY, *[r6(f"{c}_scaled").alias(f"{c}_scaled") for c in columns], back)


_FOLD_COLUMNS = ("l_quantity", "l_extendedprice", "l_tax")
_FOLD_SQL = " union all ".join(
    f"""select fold, '{c}' as "column", count({c}) as train_n, round(avg({c}), 6) as train_mean,
               round(stddev_pop({c}), 6) as train_std from {{rest}} group by 1"""
    for c in _FOLD_COLUMNS
)


@query(
    "fold_scales_by_year",
    f"""with folds as (select distinct year(l_shipdate) as fold from lineitem),
        rest as (select fold, l_quantity, l_extendedprice, l_tax from folds join lineitem on year(l_shipdate) <> fold)
        {_FOLD_SQL.format(rest="rest")}""",
)
def q_fold_scales_by_year(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("fold", F.year("l_shipdate").cast("long"))
    return _rounded_scales(fold_scales(lines, ["fold"], _FOLD_COLUMNS))


@query(
    "fold_scales_by_station",
    f"""with folds as (select distinct l_suppkey as fold from lineitem),
        rest as (select fold, l_quantity, l_extendedprice, l_tax from folds join lineitem on l_suppkey <> fold)
        {_FOLD_SQL.format(rest="rest")}""",
)
def q_fold_scales_by_station(spark, sf):
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "fold")
    return _rounded_scales(fold_scales(lines, ["fold"], _FOLD_COLUMNS))


def _rounded_scales(df):
    return df.select(
        "fold", "column", "train_n", r6("train_mean").alias("train_mean"), r6("train_std").alias("train_std")
    )


def _scored(spark, sf):
    return observations(spark, sf).withColumn("predicted", F.col("value") * 0.9 + 1)


SCORES_SQL = """count(*) as n, sqrt(avg((y - p) * (y - p))) as rmse,
    avg(abs(y - p) / greatest(abs(y), 2.220446049250313e-16)) as mape,
    avg(case when previous is not null then abs(y - p) end) / nullif(avg(abs(y - previous)), 0) as mase,
    case when count(*) > 1 then case when var_pop(y) > 0
      then 1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) else 0 end end as r2"""
Y_SQL = "value as y, value * 0.9::double + 1 as p"


@query(
    "group_scores",
    f"""with s as (select user_id as station, {Y_SQL},
                          lag(value) over (partition by user_id order by ts, event_id) as previous from events),
        g as (select station, {SCORES_SQL} from s group by 1)
        select station, n, round(rmse, 6) as "RMSE", round(mape * 100, 6) as "MAPE", round(mase, 6) as "MASE",
               round(r2, 6) as "R2", n < 5 as small_group, r2 < 0 as negative_r2 from g""",
)
def q_group_scores(spark, sf):
    scores = group_scores(
        _scored(spark, sf), ["station"], ["date", "event_id"], "value", unit="percent"
    )
    return scores.select(
        "station", "n", *[r6(m).alias(m) for m in ("RMSE", "MAPE", "MASE", "R2")],
        "small_group", "negative_r2",
    )


def long_scores(source: str, label: str) -> str:
    return " union all ".join(
        f"""select {label} as station, '{m}' as "Metric", round({m.lower()}, 6) as "Value" from {source}"""
        for m in ("RMSE", "MAPE", "MASE", "R2")
    )


def _long_at(source: str, label: str) -> str:
    return " union all ".join(
        f"""select '{m}' as "Metric", round({m.lower()}, 6) as "Value", {label} as station, "Longitude", "Latitude" from {source}"""
        for m in ("RMSE", "MAPE", "MASE", "R2")
    )


@query(
    "score_table",
    f"""with s as (select user_id as station, {Y_SQL},
                          lag(value) over (partition by user_id order by ts, event_id) as previous from events),
        g as (select station, {SCORES_SQL} from s group by 1),
        o as (select {Y_SQL}, lag(value) over (order by user_id, ts, event_id) as previous from events),
        w as (select {SCORES_SQL} from o)
        {long_scores("g", "station::varchar")} union all {long_scores("w", "'Overall'")}""",
)
def q_score_table(spark, sf):
    scores = score_table(
        _scored(spark, sf), ["station"], ["date", "event_id"], "station", actual="value"
    )
    return scores.withColumn("Value", r6("Value"))


@query(
    "season_scores",
    f"""with s as (select {_SEASON_SQL} as "Season", o_totalprice as y, o_totalprice * 0.9::double + 1 as p,
                   lag(o_totalprice) over (partition by {_SEASON_SQL} order by o_orderdate, o_orderkey) as previous
                   from orders),
        g as (select "Season", sqrt(avg((y - p) * (y - p))) as rmse, avg(abs(y - p) / abs(y)) * 100 as mape,
                     avg(abs(y - p)) / avg(abs(y - previous)) as mase,
                     1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) as r2 from s group by 1)
        select "Season", round(rmse, 4) as "RMSE", round(mape, 4) as "MAPE", round(mase, 4) as "MASE",
               round(r2, 4) as "R2" from g""",
)
def q_season_scores(spark, sf):
    orders = table(spark, sf, "orders").select(
        season(F.col("o_orderdate")).alias("Season"), "o_orderdate", "o_orderkey",
        F.col("o_totalprice").alias("actual"), (F.col("o_totalprice") * 0.9 + 1).alias("predicted"),
    )
    scores = season_scores(orders, ["o_orderdate", "o_orderkey"])
    return scores.select("Season", *[F.round(m, 4).alias(m) for m in ("RMSE", "MAPE", "MASE", "R2")])


@query(
    "distinct_stations",
    """select round_even((s_suppkey * 37) % 900 / 7::double, 4) as "Longitude", s_nationkey::double as "Latitude",
              count(*) as rows from lineitem join supplier on l_suppkey = s_suppkey group by all""",
)
def q_distinct_stations(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_suppkey")
    places = table(spark, sf, "supplier").select(
        "s_suppkey",
        (F.pmod(F.col("s_suppkey") * 37, F.lit(900)) / 7.0).alias("Longitude"),
        F.col("s_nationkey").cast("double").alias("Latitude"),
    )
    placed = lines.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
    return distinct_stations(placed, 4)


@query(
    "distinct_years",
    "select distinct year(o_orderdate) as year from orders",
)
def q_distinct_years(spark, sf):
    return table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()


@query(
    "mean_importances",
    """select p_type as "Feature", round(avg(p_retailprice), 6) as "Importance" from part group by 1""",
)
def q_mean_importances(spark, sf):
    per_fold = table(spark, sf, "part").select(
        F.col("p_type").alias("Feature"), F.col("p_retailprice").alias("Importance")
    )
    return mean_importances(per_fold).withColumn("Importance", r6("Importance"))


@query(
    "top_features",
    """select p_name as "Feature", p_retailprice as "Importance" from part
       order by p_retailprice desc, p_name limit 20""",
)
def q_top_features(spark, sf):
    return top_features(
        table(spark, sf, "part").select(
            F.col("p_name").alias("Feature"), F.col("p_retailprice").alias("Importance")
        )
    )


LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
HASHED = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

#: Trees that SQL can be held against: whole features, no sampling.
CHECKED = Boosting(rounds=2, depth=2, rate=0.3, row_share=1.0, column_share=1.0)


def _regression(spark, sf):
    """Lines as days of a station, its supplier: price to predict from quantity, discount, tax."""
    return table(spark, sf, "lineitem").select(*LINE_KEY, "l_quantity", "l_discount", "l_tax")


def _protocol(setting: Boosting = CHECKED, **more) -> Protocol:
    return Protocol(
        target="l_extendedprice", keys=LINE_KEY, order_by=LINE_ORDER,
        features=["l_quantity", "l_discount", "l_tax"], setting=setting, order=text_hash(HASHED), **more,
    )


_FEATURES = ["l_quantity", "l_discount", "l_tax"]
_HASH = "('0x' || substr(md5(concat_ws('|', " + ", ".join(HASHED) + ", '42')), 1, 13))::bigint"
_PLACE = f"order by {_HASH}, {', '.join(LINE_KEY)}"
#: Rows numbered, and the part that each protocol gives them.
_SPLIT_SQL = f"""rows as materialized (select *, row_number() over () as id, year(l_shipdate) as "Year",
    month(l_shipdate) as "Month", {_SEASON_SQL.replace("o_orderdate", "l_shipdate")} as "Season" from lineitem),
  given as materialized (select *, {{part}} as part from rows)"""
_PARTS_SQL = {
    "random": f"case when row_number() over ({_PLACE}) <= ceil(count(*) over () * 0.2) then -1 else 0 end",
    "season": f"""case when row_number() over (partition by "Season" {_PLACE})
        <= round_even(count(*) over (partition by "Season") * 0.2::double, 0) then -1 else 0 end""",
    "station": "l_suppkey",
    "year": '"Year"',
}


def _protocol_sql(kind: str, final: str, setting: Boosting = CHECKED) -> str:
    extra = {"random": ["\"Year\""], "season": ["\"Month\""]}.get(kind, [])
    models = "select -1 as m" if extra else "select distinct part as m from given"
    trees = boosted("given", [*_FEATURES, *extra], "l_extendedprice", setting, models)
    return f"with {_SPLIT_SQL.format(part=_PARTS_SQL[kind])},\n{trees},\n{final}"


_ACTUAL = "l_extendedprice as y, predicted as p"
_OVER = ", ".join(LINE_ORDER)


def _scored_sql(group: str, percent: bool) -> str:
    """Long scores per group and overall."""
    scale = " * 100" if percent else ""
    scores = SCORES_SQL.replace(" as mape", f"{scale} as mape")
    return f"""s as (select {group} as station, {_ACTUAL}, lag(l_extendedprice) over (partition by {group} order by {_OVER}) as previous
              from given join predicted using (id)),
        g as (select station, {scores} from s group by 1),
        o as (select {_ACTUAL}, lag(l_extendedprice) over (order by {group}, {_OVER}) as previous from given join predicted using (id)),
        w as (select {scores} from o)
        {long_scores("g", "station::varchar")} union all {long_scores("w", "'Overall'")}"""


def _shares_sql(label: str, rounds: int) -> str:
    """Mean gain per split of a feature as a share, per model."""
    splits = " union all ".join(f"select m, c, gain from k{t}_{level}" for t in range(rounds) for level in range(CHECKED.depth))
    names = ", ".join(f"({i}, '{f}')" for i, f in enumerate(_FEATURES))
    return f"""shares as (select m, name, coalesce(avg(gain), 0) as mean from models cross join (values {names}) as n(c, name)
          left join ({splits}) k using (m, c) group by m, name)
        select {label}, name as "Feature", round(mean / sum(mean) over (partition by m), 6) as "Importance" from shares"""


@query("protocol_random", _protocol_sql("random", _scored_sql("l_suppkey", False)))
def q_protocol_random(spark, sf):
    found = random_protocol(_regression(spark, sf), _protocol(), "l_suppkey", "l_shipdate").scores
    return _long(found, "l_suppkey")


def _long(scores, group):
    return scores.select(F.col(group).alias("station"), "Metric", r6("Value").alias("Value"))


@query(
    "protocol_season",
    _protocol_sql("season", f"""s as (select "Season", {_ACTUAL}, lag(l_extendedprice) over (partition by "Season" order by {_OVER}) as previous
              from given join predicted using (id))
        select "Season", round(sqrt(avg((y - p) * (y - p))), 4) as "RMSE", round(avg(abs(y - p) / abs(y)) * 100, 4) as "MAPE",
               round(avg(abs(y - p)) / avg(abs(y - previous)), 4) as "MASE",
               round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 4) as "R2" from s group by 1"""),
)
def q_protocol_season(spark, sf):
    scores = season_protocol(_regression(spark, sf), _protocol(), "l_shipdate").scores
    return scores.select("Season", *[F.round(m, 4).alias(m) for m in ("RMSE", "MAPE", "MASE", "R2")])


@query("protocol_station", _protocol_sql("station", _scored_sql("l_suppkey", True)))
def q_protocol_station(spark, sf):
    """Every supplier predicted from all others."""
    found = station_protocol(_regression(spark, sf), _protocol(), "l_suppkey").scores
    return _long(found, "l_suppkey")


@query("protocol_year", _protocol_sql("year", _shares_sql('m::varchar as "Year"', CHECKED.rounds)))
def q_protocol_year(spark, sf):
    shares = year_protocol(_regression(spark, sf), _protocol(), "l_shipdate").importances
    return shares.select("Year", "Feature", r6("Importance").alias("Importance"))


@query("protocol_year_scores", _protocol_sql("year", _scored_sql('"Year"', True)))
def q_protocol_year_scores(spark, sf):
    found = year_protocol(_regression(spark, sf), _protocol(), "l_shipdate").scores
    return _long(found, "Year")


@query(
    "held_out_by_year",
    _protocol_sql("year", f"""last as (select 1) select {", ".join(LINE_KEY)}, "Year"::bigint as "Year",
        round(l_extendedprice, 6) as actual, round(predicted, 4) as predicted from given join predicted using (id)"""),
)
def q_held_out_by_year(spark, sf):
    """Every row is held out once and predicted by the model of the other years."""
    found = year_protocol(_regression(spark, sf), _protocol(), "l_shipdate").predictions
    return found.select(
        *LINE_KEY, F.col("Year").cast("long").alias("Year"), r6("l_extendedprice").alias("actual"),
        F.round(PREDICTED, 4).alias("predicted"),
    )


_GAPS_SQL = f"""rows as materialized (select * replace (case when l_tax > 0 then l_tax end as l_tax,
        case when l_quantity % 7 <> 3 then l_quantity end as l_quantity), row_number() over () as id from lineitem),
    given as materialized (select *, 0 as part from rows)"""


def _with_gaps(spark, sf):
    lines = _regression(spark, sf)
    return lines.withColumns({
        "l_tax": F.when(F.col("l_tax") > 0, F.col("l_tax")),
        "l_quantity": F.when(F.col("l_quantity") % 7 != 3, F.col("l_quantity")),
    })


@query(
    "protocol_base",
    f"""with {_GAPS_SQL}, {boosted("given", ["l_quantity", "l_tax"], "l_extendedprice", CHECKED, "select 0 as m", "true", "true")}
        select {", ".join(LINE_KEY)}, l_quantity, l_tax, round(predicted, 4) as predicted from given join predicted using (id)""",
)
def q_protocol_base(spark, sf):
    """All rows, missing cells sent where they gain most."""
    found = base_model(_with_gaps(spark, sf), _protocol(), ["l_discount"], fresh_path(spark, "base-model"))
    return found.select(*LINE_KEY, "l_quantity", "l_tax", F.round(PREDICTED, 4).alias("predicted"))


STUMP = replace(CHECKED, rounds=1, depth=1, l1=0.5, l2=2.0, min_gain=0.0)
_GAP_FEATURES = ["l_quantity", "l_discount", "l_tax"]
_VALUE_SQL = "case c " + " ".join(f"when {i} then f{i}" for i in range(3)) + " end"


@query(
    "boosted_splits",
    f"""with {_GAPS_SQL.replace("0 as part", "year(l_shipdate) as part")},
        {boosted("given", _GAP_FEATURES, "l_extendedprice", STUMP, "select distinct part as m from given")},
        cuts as (select k.m, k.c, min({_VALUE_SQL}) as threshold from k0_0 k join cells on v is null or {_VALUE_SQL} > v group by k.m, k.c)
        select m::bigint as "Year", c as feature, case when v is not null then threshold end as threshold, missing_left,
               round(gain, 6) as gain, round(a.value, 9) as left_value, round(b.value, 9) as right_value
        from k0_0 join cuts using (m, c) join leaves0 a on a.m = k0_0.m and a.leaf = 1 join leaves0 b on b.m = k0_0.m and b.leaf = 2""",
)
def q_boosted_splits(spark, sf):
    """First split, gain and leaves of a tree without each year: L1, L2 and missing cells."""
    lines = _with_gaps(spark, sf).withColumn("Year", F.year("l_shipdate"))
    scales = fold_scales(lines, ["Year"], ["l_extendedprice"]).orderBy("Year").collect()
    models = [Model(STUMP, r["train_mean"], r["train_std"], part=r["Year"]) for r in scales]
    trees = grow(lines, LINE_KEY, _GAP_FEATURES, "l_extendedprice", models, F.col("Year")).trees
    years = F.element_at(F.array(*[F.lit(r["Year"]).cast("long") for r in scales]), F.col("model") + 1)
    leaf = {i: F.max(F.when(F.col("place") == i, F.col("value"))) for i in (1, 2)}
    roots = trees.where("place = 0 and child > 0")
    cut = F.when(F.col("threshold") > float("-inf"), F.col("threshold")).alias("threshold")
    roots = roots.select("model", F.col("column").alias("feature"), cut, "missing_left", r6("gain").alias("gain"))
    leaves = trees.groupBy("model").agg(*[F.round(leaf[i], 9).alias(f"{side}_value") for i, side in ((1, "left"), (2, "right"))])
    return roots.join(leaves, "model").withColumn("Year", years).drop("model")


#: All nine axes; those that sample stand at whole rows and columns, which SQL can follow.
_GRID = {
    "rounds": [1, 2], "depth": [1, 2], "rate": [0.3], "row_share": [1.0], "column_share": [1.0],
    "l1": [0.1], "l2": [0.1, 10.0], "bins": [256], "min_gain": [1.0, 4.0],
}
_GRID_FOLDS = 3
_FOLD_ROWS_SQL = f"""rows as materialized (select *, row_number() over ({_PLACE}) - 1 as place, row_number() over () as id, count(*) over () as n from lineitem),
    given as materialized (select *, case when place < (n % {_GRID_FOLDS}) * (n // {_GRID_FOLDS} + 1) then place // (n // {_GRID_FOLDS} + 1)
        else n % {_GRID_FOLDS} + (place - (n % {_GRID_FOLDS}) * (n // {_GRID_FOLDS} + 1)) // (n // {_GRID_FOLDS}) end as part from rows)"""


def _error_sql(setting: Boosting) -> str:
    folds = "select distinct part as m from given"
    return f"""(with {_FOLD_ROWS_SQL}, {boosted("given", _FEATURES, "l_extendedprice", setting, folds, scale="true")}
        select avg(e) from (select m, avg(pow((l_extendedprice - predicted) / deviation, 2)) as e
        from predicted join given using (id) join models using (m) group by m))"""


@query(
    "grid_search",
    "with e as ("
    + " union all ".join(f"select {i} as setting, {_error_sql(s)} as error" for i, s in enumerate(settings_of(CHECKED, _GRID)))
    + """) select setting, round(error, 8) as error, setting = (select arg_min(setting, (round(error, 8), setting)) from e) as best from e""",
)
def q_grid_search(spark, sf):
    """Cross-validated error of every setting; all settings and folds grow together."""
    lines = _regression(spark, sf)
    scale = {None: fit_scale(lines, ["l_extendedprice"])["l_extendedprice"]}
    best, errors = search(
        lines, LINE_KEY, _FEATURES, "l_extendedprice", F.lit(0), scale, CHECKED, _GRID, _GRID_FOLDS,
        text_hash(HASHED),
    )
    rounded = [round(e, 8) for e in errors[None]]
    first = rounded.index(min(rounded))
    assert best[None].depth in _GRID["depth"]
    rows = [(i, e, i == first) for i, e in enumerate(rounded)]
    return spark.createDataFrame(rows, "setting int, error double, best boolean")


def _placed(spark, sf):
    """The regression rows with their supplier's coordinates, and the suppliers as named stations."""
    places = stations(spark, sf).withColumn("name", F.concat(F.lit("st "), F.col("station")))
    side = lookup_table(places.select("station", F.col("longitude").alias("Longitude"), F.col("latitude").alias("Latitude")), "places")
    rows = _regression(spark, sf).join(side, F.col("l_suppkey") == F.col("station")).drop("station")
    named = places.select(F.col("name").alias("station"), "longitude", "latitude", F.col("station").alias("order"))
    return rows, named


_PLACED_SQL = f"""places as (select *, 'st ' || station as name, row_number() over (
        partition by round_even(longitude, 4), round_even(latitude, 4) order by station) as nth from stations),
    names as (select round_even(longitude, 4) as lon, round_even(latitude, 4) as lat, name from places where nth = 1)"""


def _station_sql(final: str) -> str:
    body = _protocol_sql("year", final)
    return body.replace("with rows as", f"with {STATIONS_SQL}, {_PLACED_SQL}, rows as", 1)


_PLACED_ROWS = """placed as (select g.*, predicted, longitude as "Longitude", latitude as "Latitude", name
        from given g join predicted using (id) join stations s on s.station = l_suppkey
        join names on lon = round_even(longitude, 4) and lat = round_even(latitude, 4))"""


@query(
    "predictions_at_stations",
    _station_sql(f"""{_PLACED_ROWS} select name as "Station_Name", {", ".join(LINE_KEY)}, round(predicted, 4) as predicted,
        round("Longitude", 6) as "Longitude", round("Latitude", 6) as "Latitude" from placed"""),
)
def q_predictions_at_stations(spark, sf):
    """The prediction file of a protocol, written and read back: names, keys, actual, predicted."""
    rows, named = _placed(spark, sf)
    protocol = _protocol(carried=["Longitude", "Latitude"])
    found = year_protocol(rows, protocol, "l_shipdate").predictions
    path = fresh_path(spark, "predictions")
    save_predictions(found, path, protocol, named, "order")
    back = spark.read.parquet(path)
    assert back.columns[: len(LINE_KEY) + 1] == ["Station_Name", *LINE_KEY]
    return back.select(
        "Station_Name", *LINE_KEY, F.round(PREDICTED, 4).alias("predicted"), r6("Longitude").alias("Longitude"), r6("Latitude").alias("Latitude")
    )


@query(
    "scores_at_stations",
    _station_sql(f"""{_PLACED_ROWS},
        s as (select "Longitude", "Latitude", name as station, {_ACTUAL}, lag(l_extendedprice) over (
              partition by "Longitude", "Latitude" order by {_OVER}) as previous from placed),
        g as (select "Longitude", "Latitude", station, {SCORES_SQL} from s group by all),
        o as (select {_ACTUAL}, lag(l_extendedprice) over (order by "Longitude", "Latitude", {_OVER}) as previous from placed),
        w as (select null::double as "Longitude", null::double as "Latitude", {SCORES_SQL} from o)
        select "Metric", "Value", station as "Station", round("Longitude", 6) as "Longitude", round("Latitude", 6) as "Latitude" from (
        {_long_at("g", "station")} union all {_long_at("w", "'Overall'")})"""),
)
def q_scores_at_stations(spark, sf):
    """Scores with the station's name and coordinates, and overall ones."""
    rows, named = _placed(spark, sf)
    protocol = _protocol(carried=["Longitude", "Latitude"])
    found = year_protocol(rows, protocol, "l_shipdate").predictions
    scores = scores_at_stations(found, protocol, named, "order")
    return scores.select("Metric", r6("Value").alias("Value"), "Station", r6("Longitude").alias("Longitude"), r6("Latitude").alias("Latitude"))
