"""Sliced and whole-group forms give the same rows, also with a hot group and copies."""

import random

import numpy as np
import pandas as pd
import pytest
from conftest import rows
from pyspark.sql import functions as F

from airloom.operators.ordered import (
    slice_hot_groups,
    trim_null_runs,
    with_positions,
    with_previous,
)
from airloom.operators.ranks import ecdf_points, percentiles, prune_tails, tail_cuts, value_ranks


@pytest.fixture(scope="module")
def skewed(spark):
    """Station 1 holds most rows; a third of its rows share one time."""
    rng = random.Random(3)
    data = []
    for i in range(600):
        station = 1 if i % 4 else rng.randint(2, 6)
        time = 50 if i % 3 == 0 else rng.randint(0, 99)
        value = None if rng.random() < 0.6 else float(rng.randint(0, 9))
        data.append((station, time, i, value))
    frame = spark.createDataFrame(data, "station int, time int, id int, value double")
    return frame, pd.DataFrame(data, columns=["station", "time", "id", "value"])


def test_slices_follow_the_order_and_stay_small(skewed):
    frame, local = skewed
    sizes = local.groupby("station").size()
    cool = sizes[sizes <= 40].index.tolist()
    sliced, keys = slice_hot_groups(frame, ["station"], ["time", "id"], 40)
    assert keys
    got = sliced.where("station = 1").toPandas().sort_values(["time", "id"])
    order = got[keys].apply(tuple, axis=1).tolist()
    assert order == sorted(order)
    assert got.groupby(keys).size().max() <= 80
    assert cool
    assert set(sliced.where(F.col("station").isin(cool)).toPandas()["__slice0"]) == {-1}


def test_slices_grow_with_the_group(spark):
    """Many groups just above the bound get a few slices each, not every cut."""
    frame = spark.range(4000).select((F.col("id") % 40).alias("g"), F.col("id"), F.lit(1).alias("v"))
    sliced, keys = slice_hot_groups(frame, ["g"], ["id"], 60)
    sizes = sliced.groupBy("g", *keys).count().toPandas()
    assert len(sizes) <= 40 * 4 and sizes["count"].max() <= 60


def test_text_order(spark):
    names = [f"istasyon_{w}{i}" for i in range(60) for w in ("", "a", "ağrı", "ığdır", "çan")]
    data = [(n, i) for i, n in enumerate(names)] + [("istasyon_ağrı1", 1000 + i) for i in range(100)]
    frame = spark.createDataFrame(data, "name string, id int")
    got = with_positions(frame, [], ["name", "id"], "n", 40)
    wanted = sorted(data, key=lambda r: (r[0].encode(), r[1]))
    assert [r[:2] for r in rows(got, "n")] == wanted
    sliced, keys = slice_hot_groups(frame, [], ["name", "id"], 40)
    assert sliced.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 80


def test_null_positions_come_first(spark):
    data = [(None if i % 2 else 7, i) for i in range(100)]
    frame = spark.createDataFrame(data, "t int, id int")
    got = rows(with_positions(frame, [], ["t", "id"], "n", 10), "n")
    assert [r[:2] for r in got] == sorted(data, key=lambda r: (r[0] is not None, r[1]))


def test_no_slices_without_hot_groups(skewed):
    frame, _ = skewed
    same, keys = slice_hot_groups(frame, ["station"], ["time", "id"], 10_000)
    assert keys == [] and same.columns == frame.columns


@pytest.mark.parametrize("max_rows", [60, 10_000])
def test_positions(skewed, max_rows):
    frame, local = skewed
    local = local.sort_values(["station", "time", "id"])
    wanted = dict(zip(local["id"], local.groupby("station").cumcount() + 1))
    got = with_positions(frame, ["station"], ["time", "id"], "n", max_rows)
    assert {r["id"]: r["n"] for r in got.collect()} == wanted
    whole = with_positions(frame, [], ["time", "id"], "n", max_rows)
    ordered = local.sort_values(["time", "id"])["id"].tolist()
    assert [r[0] for r in rows(whole.select("id", "n"), "n")] == ordered


@pytest.mark.parametrize("max_rows", [60, 10_000])
def test_previous(skewed, max_rows):
    frame, local = skewed
    frame = frame.withColumn("y", F.col("id") * 2)
    local = local.sort_values(["station", "time", "id"])
    wanted = dict(zip(local["id"], (local["id"] * 2).groupby(local["station"]).shift(1)))
    got = with_previous(frame, ["station"], ["time", "id"], {"before": "y"}, max_rows)
    assert got.columns == [*frame.columns, "before"]
    for r in got.collect():
        assert r["before"] == (None if np.isnan(wanted[r["id"]]) else wanted[r["id"]])


@pytest.mark.parametrize("max_rows,block", [(5, 2), (40, 3), (100, 10), (10_000, 2), (10_000, 10)])
def test_null_runs(skewed, max_rows, block):
    frame, local = skewed
    local = local.sort_values(["station", "time", "id"])
    missing = local["value"].isna().astype(int)
    run = missing.groupby(local["station"]).transform(
        lambda s: s.rolling(block, min_periods=block).sum()
    )
    wanted = sorted(local[run != block]["id"])
    got = trim_null_runs(frame, "value", ["station"], ["time", "id"], block, max_rows)
    assert got.columns == frame.columns
    assert sorted(r["id"] for r in got.collect()) == wanted


def test_null_run_edges(spark):
    """A run of 12 keeps its first 9 rows; a short empty station keeps all."""
    data = [(1, i, None if i < 12 else 1.0) for i in range(14)] + [(2, i, None) for i in range(5)]
    frame = spark.createDataFrame(data, "station int, date int, v double")
    got = trim_null_runs(frame, "v", ["station"], ["date"])
    assert rows(got.groupBy("station").count(), "station") == [(1, 11), (2, 5)]


def _pruned(values, share):
    """Straight from the definition of the empirical distribution."""
    ordered = np.sort(values)
    shares = np.arange(1, len(ordered) + 1) / len(ordered)
    cut = set(ordered[shares <= share]) | set(ordered[shares >= 1 - share])
    return [None if v in cut else v for v in values]


@pytest.mark.parametrize("n,share", [(7, 0.1), (50, 0.01), (999, 0.001), (1000, 0.001), (1001, 0.1)])
def test_prune_against_definition(spark, n, share):
    rng = np.random.default_rng(n)
    values = [float(v) for v in rng.integers(0, n // 2 + 2, n)]
    frame = spark.createDataFrame(list(enumerate(values)), "id int, `PM2.5` double")
    for max_rows in (200, 10**6):
        got = prune_tails(frame, ["PM10", "PM2.5"], share, max_rows)
        assert [r[1] for r in rows(got, "id")] == _pruned(values, share)


def test_prune_edges(spark):
    ten = spark.createDataFrame([(float(i),) for i in range(10)], "PM10 double")
    assert tail_cuts(ten, ["PM10"]) == {"PM10": (None, 9.0)}
    twice = spark.createDataFrame(
        [(float(max(i, 1)),) for i in range(1000)], "PM10 double"
    )
    assert prune_tails(twice, ["PM10"]).where("PM10 = 1").count() == 0
    same = spark.createDataFrame([(4.0,)] * 5, "PM10 double")
    assert prune_tails(same, ["PM10"]).where("PM10 is not null").count() == 0
    none = spark.createDataFrame([(None,)], "PM10 double")
    assert prune_tails(none, ["PM10"]).count() == 1


@pytest.mark.parametrize("max_rows", [40, 10**6])
def test_ranks_and_percentiles(spark, max_rows):
    rng = np.random.default_rng(1)
    data = [("a", float(v)) for v in rng.integers(0, 200, 500)]
    data += [("b", float(v)) for v in rng.normal(size=30)] + [("b", None)]
    frame = spark.createDataFrame(data, "g string, v double")
    ranked = value_ranks(frame, "v", ["g"], max_rows).toPandas()
    local = pd.DataFrame(data, columns=["g", "v"]).dropna()
    local["first"] = local.groupby("g")["v"].rank("min")
    local["last"] = local.groupby("g")["v"].rank("max")
    wanted = local.drop_duplicates().sort_values(["g", "v"]).reset_index(drop=True)
    ranked = ranked.sort_values(["g", "v"]).reset_index(drop=True)
    assert (ranked["rank_first"] == wanted["first"]).all()
    assert (ranked["rank_last"] == wanted["last"]).all()
    got = percentiles(frame, "v", [0.0, 0.2, 0.5, 0.77, 1.0], ["g"], max_rows).collect()
    for r in got:
        values = local[local["g"] == r["g"]]["v"]
        assert np.allclose(list(r)[2:], np.quantile(values, [0.0, 0.2, 0.5, 0.77, 1.0]))
    whole = percentiles(frame, "v", [0.5], [], max_rows).first()
    assert np.isclose(whole["p50"], local["v"].median())
    points = ecdf_points(frame, "v", ["g"], max_rows).where("ecdf = 1")
    assert points.count() == 2


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_clock_change_does_not_reorder(spark):
    """Zone-less times are cut by their own parts, also where the session's clock jumps."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        minutes = spark.range(300).select(
            F.expr("timestamp_ntz '2024-03-10 00:00:00' + make_dt_interval(0, 0, id, 0)").alias("t"),
            F.lit(1).alias("g"),
            (F.col("id") + 1).alias("wanted"),
        )
        got = with_positions(minutes, ["g"], ["t"], "n", 20)
        assert got.where("n <> wanted").count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_hot_null_group_is_sliced(spark):
    frame = spark.range(200).select(F.lit(None).cast("string").alias("station"), F.col("id"))
    sliced, keys = slice_hot_groups(frame, ["station"], ["id"], 50)
    assert sliced.groupBy(*keys).count().agg(F.max("count")).first()[0] <= 100
    got = with_positions(frame, ["station"], ["id"], "n", 50)
    assert got.where("n <> id + 1").count() == 0


def test_overall_positions_use_many_tasks(spark):
    frame = spark.range(5000).select((F.col("id") % 7).alias("k"), "id")
    got = with_positions(frame, [], ["k", "id"], "n")
    assert "SinglePartition" not in _plan(got)
    assert [r["id"] for r in got.orderBy("n").collect()] == sorted(range(5000), key=lambda i: (i % 7, i))
    assert with_positions(frame.limit(0), [], ["id"], "n").count() == 0


def test_nan_is_missing(spark):
    nan = float("nan")
    frame = spark.createDataFrame([(1, i, nan) for i in range(20)], "g int, t int, v double")
    assert trim_null_runs(frame, "v", ["g"], ["t"]).count() == 9
    values = [(float(i),) for i in range(1, 100)] + [(nan,)] * 5
    pruned = prune_tails(spark.createDataFrame(values, "PM10 double"), ["PM10"])
    assert sorted(r[0] for r in pruned.where("PM10 is not null").collect()) == [float(i) for i in range(1, 99)]
