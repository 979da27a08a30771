"""What must not grow with hot groups, folds or models, against the plain forms."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from airloom.operators import shared_sums as S
from airloom.operators import trees as T
from airloom.operators.boosting import Boosting, search
from airloom.operators.metrics import group_scores, score_table
from airloom.operators.splits import k_folds, random_split, season_split, text_hash
from airloom.operators.trees import Model, grow


@pytest.fixture(scope="module")
def scored(spark):
    """A group with most rows, one of one row, one of equal values, one without a name."""
    r = np.random.default_rng(3)
    out = [("hot", i % 97, i, float(r.normal()) + 1e6, float(r.normal()) + 1e6) for i in range(700)]
    out += [("one", 1, 1, 2.0, 3.0), (None, None, 1, 5.0, 4.0), (None, 1, 2, 7.0, 4.0)]
    out += [("same", i, i, 0.1, 0.1 * i) for i in range(60)]
    out += [("hot", 5, -1, None, 1.0)]
    return spark.createDataFrame(out, "g string, t int, id int, actual double, predicted double").cache()


def test_scores_of_a_hot_group_take_as_many_jobs(spark, scored):
    tracker, found = spark.sparkContext.statusTracker(), {}
    for most in (7, 70, 10**6):
        spark.sparkContext.setJobGroup(f"scores-{most}", "")
        scores = group_scores(scored, ["g"], ["t", "id"], max_rows=most).toPandas()
        found[most] = len(tracker.getJobIdsForGroup(f"scores-{most}")), scores.sort_values("g").reset_index(drop=True)
    # Cutting the group finer takes no more jobs.
    assert found[7][0] <= found[70][0] + 1
    pd.testing.assert_frame_equal(found[7][1], found[10**6][1], rtol=1e-9)


@pytest.mark.parametrize("most", [7, 10**6])
def test_scores_of_ordered_runs(scored, most):
    rows = scored.where("actual is not null").toPandas().sort_values(["g", "t", "id"], na_position="first")
    got = group_scores(scored, ["g"], ["t", "id"], max_rows=most).toPandas().set_index("g", drop=False)
    for name, own in rows.groupby("g", dropna=False):
        row = got[got["g"].isna()].iloc[0] if pd.isna(name) else got.loc[name]
        error, steps = (own["actual"] - own["predicted"]).abs(), own["actual"].diff().abs().iloc[1:]
        assert row["n"] == len(own) and np.isclose(row["RMSE"], np.sqrt((error**2).mean()))
        if len(own) == 1:
            assert pd.isna(row["MASE"]) and pd.isna(row["R2"])
        elif name == "same":
            # Equal values in several ranges have no deviation, not a rounded one.
            assert pd.isna(row["MASE"]) and row["R2"] == 0.0
        else:
            assert np.isclose(row["MASE"], error.iloc[1:].mean() / steps.mean(), rtol=1e-9)
            assert np.isclose(row["R2"], 1 - (error**2).sum() / ((own["actual"] - own["actual"].mean()) ** 2).sum(), rtol=1e-6)
    overall = score_table(scored, ["g"], ["t", "id"], "g", max_rows=most).where("g = 'Overall' and Metric = 'MASE'").first()["Value"]
    whole = rows.assign(first=rows["g"].isna()).sort_values(["first", "g", "t", "id"], ascending=[False, True, True, True], na_position="first")
    error, steps = (whole["actual"] - whole["predicted"]).abs(), whole["actual"].diff().abs().iloc[1:]
    assert np.isclose(overall, error.iloc[1:].mean() / steps.mean(), rtol=1e-9)


def test_row_hash_is_made_once(spark):
    frame = spark.range(500).select("id", F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("date"))
    order = text_hash(["id"])
    for labelled in (k_folds(frame, ["id"], 3, order=order), random_split(frame, ["id"], order=order), season_split(frame, ["id"], order=order)):
        assert "__hash" not in labelled.columns
        assert "md5" not in labelled._jdf.queryExecution().toString()
    assert {r["n"] for r in k_folds(frame, ["id"], 3, order=order).groupBy("fold").agg(F.count("*").alias("n")).collect()} == {166, 167}
    assert random_split(frame, ["id"], order=order).where("is_test").count() == 100


def test_search_predicts_held_out_rows_only(spark, monkeypatch):
    """Errors of shared sums equal those of stored predictions, which are not made for them."""
    r = np.random.default_rng(8)
    out = [(i, float(r.integers(0, 30)), float(r.normal()) if i % 9 else None, i % 4 - 1) for i in range(900)]
    out = [(i, a, b, p, (a - 9) ** 2 + 3 * (b or 0.0)) for i, a, b, p in out]
    frame = spark.createDataFrame(out, "id long, a double, b double, part int, y double")
    base = Boosting(rounds=2, depth=2, rate=0.4, row_share=1.0, column_share=1.0, l1=0.2, l2=0.3, bins=32, min_gain=0.5)
    grid = {"rounds": [1, 2], "l2": [0.3, 20.0], "min_gain": [0.5, 50.0]}
    scales = {None: (10.0, 9.0), 1: (8.0, 9.0)}
    given = frame, ["id"], ["a", "b"], "y", F.col("part"), scales, base, grid, 3
    with monkeypatch.context() as m:
        m.setattr(S, "_with_outputs", None)
        _, shared = search(*given)
    monkeypatch.setattr(S, "fits", lambda *_: False)
    _, plain = search(*given)
    for p in scales:
        np.testing.assert_allclose(shared[p], plain[p], rtol=1e-9)


def test_small_forests_are_walked_as_arrays(spark, monkeypatch):
    r = np.random.default_rng(4)
    out = [(i, float(r.normal()) if i % 5 else None, float(r.integers(0, 6)) if i % 7 else float("nan"), float(r.normal()), i % 4 if i % 11 else None) for i in range(600)]
    frame = spark.createDataFrame(out, "id long, a double, b double, y double, of int")
    setting = Boosting(rounds=3, depth=3, rate=0.4, row_share=0.8, column_share=1.0, l1=0.0, l2=0.1, bins=16, min_gain=0.0)
    models = [Model(s, 0.0, 1.0) for s in (setting, Boosting(**{**setting.__dict__, "rounds": 1, "depth": 1}), setting)]
    trees = grow(frame, ["id"], ["a", "b"], "y", models, F.lit(0)).trees
    walked = T.score(frame, trees, ["a", "b"], F.col("of"), 3, "p")
    assert "lambda" not in walked._jdf.queryExecution().toString().lower()
    monkeypatch.setattr(T, "WALKED", 1)
    joined = T.score(frame, trees, ["a", "b"], F.col("of"), 3, "p")
    a, b = ({r["id"]: r["p"] for r in x.select("id", "p").collect()} for x in (walked, joined))
    assert a == b and len(set(a.values())) > 3
    monkeypatch.undo()
    empty = T.score(frame, trees.limit(0), ["a", "b"], F.col("of"), 3, "p")
    assert {r["p"] for r in empty.select("p").collect()} == {0.0}
