"""Small forests from shared sums against the same grown row by row."""

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from airloom.operators import shared_sums as S
from airloom.operators import trees as T
from airloom.operators.boosting import fit_parts
from airloom.operators.trees import Boosting, Model, grow, predictions

FEATURES = ["a", "b", "c"]
SETTING = Boosting(rounds=3, depth=2, rate=0.4, row_share=1.0, column_share=1.0, l1=0.3, l2=0.7, bins=16, min_gain=1.0)
SAMPLED = Boosting(rounds=2, depth=3, rate=0.3, row_share=0.6, column_share=0.7, l1=0.0, l2=1.0, bins=16, min_gain=0.0)
PARTS = 40


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(5)
    out = []
    for i in range(1200):
        a, b, c = float(r.integers(0, 40)), float(r.normal()), float(r.integers(0, 4))
        y = (a - 20) ** 2 / 40 + 3 * b * (c > 1) + float(r.normal()) * 0.2
        part = i % PARTS if i % 9 else -1
        out.append((i, a if i % 7 else None, b if i % 11 else float("nan"), c, y if i % 50 else None, part, i % 3, i % 4 - 1))
    # Part 39 is unlike the rest, and dominates; part 40 has no rows.
    out += [(2000 + i, float(i % 40), float(i), 9.0, 1e6 * i, 39, 1, 0) for i in range(300)]
    return spark.createDataFrame(out, "id long, a double, b double, c double, y double, part int, fold int, few int").cache()


def _grown(frame, models, part, fold=None):
    forest = grow(frame, ["id"], FEATURES, "y", models, part, fold)
    nodes = rows(forest.trees.select("model", "tree", "place", "column", "threshold", "missing_left", "child", "cover"), "model", "tree", "place")
    inner = [r if r[3] >= 0 else (*r[:5], None, *r[6:]) for r in nodes]
    return inner, {r["id"]: r["p"] for r in predictions(forest, "p").select("id", "p").collect()}, forest


@pytest.mark.parametrize("case", ["parts", "ranges", "folds"])
def test_shared_sums_grow_the_same_trees(spark, frame, monkeypatch, case):
    part, fold = F.col("part"), None
    models = [Model(s, 0.5, 3.0, part=p) for s in (SETTING, SAMPLED) for p in [None, 0, 7, 38, 39, 40]]
    if case == "ranges":
        monkeypatch.setattr(S, "MAX_SLOTS", 1)
        models = [Model(SETTING, 0.1 * p, 3.0, part=p) for p in range(PARTS + 1)] + [Model(SAMPLED)]
        assert S.Slots(models, 1).width > 1
    elif case == "folds":
        part, fold = F.col("few"), F.col("fold")
        models = [Model(s, 0.5, 3.0, part=p, fold=f) for s in (SETTING, SAMPLED) for p in (None, 1) for f in (None, 2)]
    assert S.fits(models, len(FEATURES))
    shared, every, forest = _grown(frame, models, part, fold)
    monkeypatch.setattr(S, "fits", lambda *_: False)
    plain, wanted, _ = _grown(frame, models, part, fold)
    assert shared == plain and every.keys() == wanted.keys()
    for i, p in wanted.items():
        np.testing.assert_allclose(every[i], p, rtol=1e-7, atol=1e-7)
    own = predictions(forest, "p", F.col("few")).select("id", "few", "p").collect()
    assert all(r["p"] is None if r["few"] < 0 else abs(r["p"] - every[r["id"]][r["few"]]) < 1e-12 for r in own)


def test_models_of_one_history_are_summed_once(spark, frame, monkeypatch):
    """All parts are one run of jobs, and its passes do not depend on how many there are."""
    monkeypatch.setattr(T, "MODELS_AT_ONCE", 4)
    some = frame.where("part < 39")
    runs = list(fit_parts(some, ["id"], FEATURES, "y", F.col("part"), {p: (0.0, 1.0) for p in range(39)}, {p: SETTING for p in range(39)}))
    assert [len(parts) for parts, _ in runs] == [39]
    models = [Model(SETTING, part=p) for p in range(39)]
    now = T.Round.empty(39, 2)
    level = S.Level(models, [18] * 3, [], now, 0, np.ones((39, 1), bool), np.ones((39, 3), bool), 0.0)
    assert [x.tolist() for x in level.members] == [list(range(39))]
    assert not S.fits([Model(Boosting())], 3)
