"""Imputation, splits, scaling, models, protocols, streaming."""

import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from airloom.operators.boosting import Boosting, fit, load_model, predict, save_model, search, settings_of
from airloom.operators.impute import _fill_block, contiguous_blocks, knn_impute
from airloom.operators.scaling import apply_scale, fit_scale, fold_scales
from airloom.operators.spatial import nearest_cells
from airloom.operators.splits import k_folds, random_split, season_split, stratified_split
from airloom.plans.evaluation import Protocol, base_model, station_protocol, year_protocol
from airloom.session import broadcast_checked, fresh_path, materialize
from airloom.sources.files import read_station_files
from airloom.streaming.ingest import ingest_grid_files


def _fill_by_hand(cells, k):
    """One missing cell at a time, from the definition of the distance."""
    out = [list(r) for r in cells]
    width = len(cells[0])
    for i, row in enumerate(cells):
        for c in range(width):
            if row[c] is not None:
                continue
            near = []
            for j, other in enumerate(cells):
                shared = [x for x in range(width) if row[x] is not None and other[x] is not None]
                if other[c] is not None and shared:
                    total = sum((row[x] - other[x]) ** 2 for x in shared)
                    near.append((total * width / len(shared), j))
            values = [cells[j][c] for _, j in sorted(near)[:k]]
            if not values:
                values = [r[c] for r in cells if r[c] is not None]
            out[i][c] = sum(values) / len(values) if values else None
    return out


def _holey(rng, n, width, share):
    return [
        [None if rng.random() < share else float(rng.normal()) for _ in range(width)] for _ in range(n)
    ]


@pytest.mark.parametrize("share", [0.1, 0.5, 0.8])
def test_block_fill(share):
    cells = _holey(np.random.default_rng(6), 60, 4, share)
    block = np.array([[np.nan if v is None else v for v in r] for r in cells])
    got = _fill_block(block, 5)
    wanted = np.array([[np.nan if v is None else v for v in r] for r in _fill_by_hand(cells, 5)])
    assert np.allclose(got, wanted, equal_nan=True)


def test_impute_in_blocks(spark):
    cells = _holey(np.random.default_rng(7), 97, 3, 0.3)
    data = [(i, "keep", *r) for i, r in enumerate(cells)]
    frame = spark.createDataFrame(data, "id int, label string, `PM2.5` double, b double, c double")
    got = rows(knn_impute(frame.repartition(5), ["PM2.5", "b", "c"], ["id"], 5, 20), "id")
    blocks = np.array_split(np.arange(97), 97 // 20)
    wanted = [r for b in blocks for r in _fill_by_hand([cells[i] for i in b], 5)]
    assert [r[:2] for r in got] == [(i, "keep") for i in range(97)]
    assert np.allclose([r[2:] for r in got], wanted)


def test_impute_edges():
    lone = np.array([[np.nan, np.nan], [1.0, 4.0], [2.0, 6.0]])
    assert _fill_block(lone, 5)[0].tolist() == [1.5, 5.0]
    three = np.array([[1.0, np.nan], [1.0, 3.0], [2.0, 6.0], [9.0, 9.0]])
    assert _fill_block(three, 5)[0, 1] == 6.0
    empty = np.array([[1.0, np.nan], [np.nan, np.nan], [3.0, np.nan]])
    got = _fill_block(empty, 5)
    assert np.isnan(got[:, 1]).all() and got[1, 0] == 2.0


def test_blocks_like_even_cuts(spark):
    frame = spark.range(53)
    got = contiguous_blocks(frame.withColumn("k", -F.col("id")), ["k"], 10, "block")
    sizes = [r[1] for r in rows(got.groupBy("block").count(), "block")]
    assert sizes == [len(b) for b in np.array_split(np.arange(53), 5)]


@pytest.mark.parametrize("n", [1, 9, 100, 1003])
def test_split_sizes(spark, n):
    frame = spark.range(n)
    split = random_split(frame, ["id"])
    assert split.where("is_test").count() == math.ceil(0.2 * n)
    folds = k_folds(frame, ["id"], 5).groupBy("fold").count()
    got = sorted((r["count"] for r in folds.collect()), reverse=True)
    assert got == [len(p) for p in np.array_split(np.arange(n), 5) if len(p)]


def test_split_is_repeatable_and_stratified(spark):
    frame = spark.range(500).withColumn("g", F.when(F.col("id") < 333, "hot").otherwise((F.col("id") % 7).cast("string")))
    split = stratified_split(frame, ["id"], ["g"])
    again = stratified_split(frame.repartition(7), ["id"], ["g"])
    assert rows(split.where("is_test").select("id"), "id") == rows(again.where("is_test").select("id"), "id")
    for r in split.groupBy("g").agg(F.count("*").alias("n"), F.sum(F.col("is_test").cast("int")).alias("t")).collect():
        assert r["t"] == round(0.2 * r["n"])


def test_season_split(spark):
    frame = spark.range(400).withColumn("date", F.expr("date_add(date'2020-01-01', cast(id as int))"))
    split = season_split(frame, ["id"])
    shares = split.groupBy("Season").agg(F.avg(F.col("is_test").cast("int")).alias("s")).collect()
    assert len(shares) == 4 and all(abs(r["s"] - 0.2) < 0.01 for r in shares)


def test_fold_scales(spark):
    rng = np.random.default_rng(9)
    data = [(int(i % 3), float(rng.normal(1000, 1)), 5.0, None if i % 4 == 0 else float(i)) for i in range(60)]
    frame = spark.createDataFrame(data, "fold int, a double, same double, gap double")
    got = {(r["fold"], r["column"]): r for r in fold_scales(frame, ["fold"], ["a", "same", "gap"]).collect()}
    for fold in range(3):
        for i, c in ((1, "a"), (3, "gap")):
            rest = np.array([d[i] for d in data if d[0] != fold and d[i] is not None])
            r = got[fold, c]
            assert r["train_n"] == len(rest)
            assert np.isclose(r["train_mean"], rest.mean()) and np.isclose(r["train_std"], rest.std())
        assert got[fold, "same"]["train_std"] == 1.0
    assert fold_scales(frame.where("fold = 0"), ["fold"], ["a"]).count() == 0


def test_constant_feature_scales_to_zero(spark):
    frame = spark.createDataFrame([(3.0,), (3.0,)], "a double")
    scaled = apply_scale(frame, fit_scale(frame, ["a"]))
    assert {r["a_scaled"] for r in scaled.collect()} == {0.0}


@pytest.fixture(scope="module")
def regression(spark):
    frame = spark.range(300).select(
        "id",
        (F.col("id") % 3).alias("station"),
        F.expr("date_add(date'2019-06-01', cast(id * 3 as int))").alias("date"),
        (F.col("id") % 17).cast("double").alias("a"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 11).cast("double")).alias("b"),
    )
    return frame.withColumn("y", F.col("a") * 2 + F.coalesce("b", F.lit(20.0)))


def _protocol(**more):
    setting = Boosting(rounds=4, depth=4, rate=0.5, bins=32, row_share=1.0, column_share=1.0)
    return Protocol("y", ["id"], ["date", "id"], ["a", "b"], setting, **more)


def test_saved_model_predicts_the_same(spark, regression):
    path = fresh_path(spark, "model")
    scale = fit_scale(regression, ["a", "b", "y"])
    model = fit(regression, ["id"], ["a", "b"], "y", Boosting(rounds=3, depth=3, rate=0.5, bins=32), scale)
    save_model(spark, model, scale, "y", path)
    loaded, scale2, target = load_model(spark, path)
    assert scale2 == scale and (loaded.features, loaded.depth, target) == (["a", "b"], 3, "y")
    first = predict(model, regression, "y", scale, "p").select("id", "p")
    second = predict(loaded, regression.select("a", "b", "id"), target, scale2, "p").select("id", "p")
    assert rows(first, "id") == rows(second, "id")
    assert first.select("p").distinct().count() > 3


GRID = {
    "rounds": [1, 3], "depth": [1, 3], "rate": [0.3, 0.6], "row_share": [0.8], "column_share": [0.5, 1.0],
    "l1": [0.1], "l2": [0.1, 5.0], "bins": [16, 32], "min_gain": [0.0],
}


def test_grid_over_nine_axes_equals_one_setting_at_a_time(spark, regression):
    base, scale = Boosting(), {None: (20.0, 9.0)}
    assert len(GRID) == 9
    best, errors = search(regression, ["id"], ["a", "b"], "y", F.lit(0), scale, base, GRID, 3)
    settings = settings_of(base, GRID)
    assert len(settings) == len(errors[None]) == 64
    assert best[None] == settings[errors[None].index(min(errors[None]))]
    for i in (0, 21, 40, 63):
        alone = {k: [getattr(settings[i], k)] for k in GRID}
        _, error = search(regression, ["id"], ["a", "b"], "y", F.lit(0), scale, base, alone, 3)
        assert abs(error[None][0] - errors[None][i]) < 1e-9


def test_jobs_do_not_grow_with_folds(spark, regression):
    tracker = spark.sparkContext.statusTracker()

    def jobs(parts):
        frame = regression.withColumn("station", F.col("id") % parts)
        spark.sparkContext.setJobGroup(f"folds-{parts}", "")
        station_protocol(frame, _protocol(), "station").predictions.count()
        return len(tracker.getJobIdsForGroup(f"folds-{parts}"))

    assert abs(jobs(3) - jobs(60)) <= 8


def test_every_station_predicted_by_the_others(spark, regression):
    folder = fresh_path(spark, "models")
    result = station_protocol(regression, _protocol(), "station", folder)
    complete = regression.na.drop()
    assert rows(result.predictions.select("id"), "id") == rows(complete.select("id"), "id")
    assert result.scores.count() == 16
    assert result.importances.count() == 2
    model, scale, target = load_model(spark, f"{folder}/fold=1")
    assert (model.features, target) == (["a", "b"], "y") and set(scale) == {"a", "b", "y"}
    # The saved model of a station is the one that predicted it.
    held = complete.where("station = 1")
    again = predict(model, held, "y", scale, "p").select("id", F.round("p", 9))
    own = result.predictions.where("station = 1").select("id", F.round("predicted", 9))
    assert rows(again, "id") == rows(own, "id")


def test_years_and_base_model(spark, regression):
    result = year_protocol(regression, _protocol(), "date")
    assert result.importances.select("Year").distinct().count() == 3
    fitted = base_model(regression, _protocol(), [], fresh_path(spark, "base"))
    assert fitted.count() == 300
    error = fitted.agg(F.avg(F.abs(F.col("y") - F.col("predicted")))).first()[0]
    spread = regression.agg(F.avg(F.abs(F.col("y") - F.lit(28.0)))).first()[0]
    assert error < spread / 2


def test_stream_takes_each_file_once(spark):
    cells = spark.createDataFrame([(i, float(i % 2), float(i // 2)) for i in range(4)], "cell_id long, lat double, lon double")
    places = spark.createDataFrame([("s", 0.4, 0.6)], "station string, latitude double, longitude double")
    near = materialize(nearest_cells(cells, places), "neighbours")
    folder, facts, log = (fresh_path(spark, n) for n in ("grid", "facts", "log"))

    def add(time):
        grid = cells.selectExpr(
            f"{time} as time", "*", "'Wind' as long_name", "'u' as variable", f"cell_id + {time}.0D as value"
        )
        grid.coalesce(1).write.parquet(f"{folder}/{time}")
        return grid.schema

    schema = add(1)
    ingest_grid_files(spark, folder, schema, near, facts, log)
    add(2)
    ingest_grid_files(spark, folder, schema, near, facts, log)
    ingest_grid_files(spark, folder, schema, near, facts, log)
    got = rows(spark.read.parquet(facts).select("time", "station", "variable"), "time")
    assert got == [(1, "s", "Wind"), (2, "s", "Wind")]


def test_station_files_by_plain_name(spark, tmp_path):
    (tmp_path / "kadikoy moda.v2.csv").write_text("date,v\n2020-01-01,1.5\nbad,2.5\n")
    found = read_station_files(spark, str(tmp_path), spark.createDataFrame([], "date string, v double").schema, "csv")
    assert [(r["station"], r["v"]) for r in found.collect()] == [("kadikoy moda", 1.5)]


def test_broadcast_only_within_bound(spark):
    small = spark.range(5)
    plan = spark.range(100).join(broadcast_checked(small, 100), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan.lower()
    plan = spark.range(100).join(broadcast_checked(small, 120), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan.lower()


def test_fold_scales_with_a_dominating_fold(spark):
    """The rest's deviation survives a fold whose values are far larger."""
    rng = np.random.default_rng(4)
    small = rng.normal(3.0, 0.7, 50)
    data = [(0, float(v)) for v in small] + [(1, float(v)) for v in rng.normal(1e9, 1e8, 5000)]
    data += [(2, 5.0)] * 3 + [(2, float("nan")), (None, 4.0)]
    frame = spark.createDataFrame(data, "fold int, x double")
    got = {r["fold"]: r for r in fold_scales(frame, ["fold"], ["x"]).collect()}
    rest = np.array([*small, 5.0, 5.0, 5.0, 4.0])
    assert got[1]["train_n"] == 54
    assert np.isclose(got[1]["train_mean"], rest.mean()) and np.isclose(got[1]["train_std"], rest.std())
    assert set(got) == {0, 1, 2, None}
