"""Second-order boosting against a plain recursion, many models against one at a time."""

import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from airloom.operators import trees as T
from airloom.operators.trees import Boosting, Model, grow, predictions, score

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def frame(spark):
    r = np.random.default_rng(3)
    out = []
    for i in range(500):
        a, b, c = float(r.integers(0, 40)), float(r.normal()), float(r.integers(0, 4))
        y = (a - 20) ** 2 / 40 + 3 * b * (c > 1) + float(r.normal()) * 0.2
        out.append((i, a if i % 7 else None, b if i % 11 else math.nan, c, y if i % 50 else None, i % 3))
    return spark.createDataFrame(out, "id long, a double, b double, c double, y double, part int").cache()


def threshold(g, l1):
    return math.copysign(max(abs(g) - l1, 0), g)


def side(g, h, s):
    return threshold(g, s.l1) ** 2 / (h + s.l2) if h + s.l2 > 0 else 0.0


def plain_tree(x, g, cuts, columns, s, depth):
    """Nested (column, threshold, missing left, gain, left, right) or a leaf value."""
    total, n = g.sum(), len(g)
    best = None
    if depth < s.depth:
        for c in columns:
            own = x[:, c]
            gone = np.isnan(own)
            bins = np.where(gone, -1, np.searchsorted(cuts[c], own, "right"))
            for cut in range(len(cuts[c]) + 2):
                for right in (True, False):
                    left = (bins >= 0) & (bins < cut) | (gone & (not right))
                    if not 0 < left.sum() < n:
                        continue
                    gain = side(g[left].sum(), left.sum(), s) + side(g[~left].sum(), n - left.sum(), s) - side(total, n, s)
                    # Rounded: sums in another order must not decide ties.
                    key = (round(gain, 9), -c, -cut, right)
                    if gain > 1e-6 and (best is None or key > best[0]):
                        best = (key, c, cut, right, gain, left)
    if best is None:
        return -s.rate * threshold(total, s.l1) / (n + s.l2)
    _, c, cut, right, gain, left = best
    a, b = (plain_tree(x[m], g[m], cuts, columns, s, depth + 1) for m in (left, ~left))
    if gain < s.min_gain and not isinstance(a, tuple) and not isinstance(b, tuple):
        return -s.rate * threshold(total, s.l1) / (n + s.l2)
    return c, cut, not right, gain, a, b


def walk(node, bins):
    while isinstance(node, tuple):
        c, cut, missing_left, _, a, b = node
        node = a if (missing_left if bins[c] < 0 else bins[c] < cut) else b
    return node


def plain_boosting(frame, s, cuts, mean=0.0, deviation=1.0):
    """Predictions of all rows, trained on all of them."""
    data = frame.where("y is not null").orderBy("id").collect()
    x = np.array([[math.nan if r[c] is None else r[c] for c in FEATURES] for r in data])
    y = (np.array([r["y"] for r in data]) - mean) / deviation
    bins = np.stack([np.where(np.isnan(x[:, c]), -1, np.searchsorted(cuts[c], x[:, c], "right")) for c in range(3)], 1)
    out, made = np.zeros(len(y)), []
    for _ in range(s.rounds):
        tree = plain_tree(x, out - y, cuts, range(3), s, 0)
        made.append(tree)
        out = out + np.array([walk(tree, b) for b in bins])
    return [r["id"] for r in data], out * deviation + mean, made


WHOLE = Boosting(rounds=5, depth=3, rate=0.4, row_share=1.0, column_share=1.0, l1=0.3, l2=0.7, bins=32, min_gain=2.0)


def test_trees_equal_a_plain_recursion(spark, frame):
    cuts = T.find_cuts(frame, FEATURES, WHOLE.bins)
    assert [len(c) for c in cuts][2] == 3 and len(cuts[0]) < 32 and len(cuts[1]) <= 31
    forest = grow(frame, ["id"], FEATURES, "y", [Model(WHOLE, 1.0, 2.0)], F.lit(0))
    ids, wanted, made = plain_boosting(frame, WHOLE, cuts, 1.0, 2.0)
    found = {r["id"]: r["p"][0] for r in predictions(forest, "p").collect()}
    assert sorted(found) == ids
    np.testing.assert_allclose([found[i] for i in ids], wanted, atol=1e-9)

    def size(node):
        return 1 + size(node[4]) + size(node[5]) if isinstance(node, tuple) else 1

    sizes = [r["count"] for r in forest.trees.groupBy("tree").count().orderBy("tree").collect()]
    assert sizes == [size(t) for t in made]
    root = forest.trees.where("place = 0").orderBy("tree").collect()
    assert [r["column"] for r in root] == [t[0] for t in made]
    np.testing.assert_allclose([r["gain"] for r in root], [t[3] for t in made], rtol=1e-9)


def test_packed_trees_score_the_same(spark, frame, monkeypatch):
    forest = grow(frame, ["id"], FEATURES, "y", [Model(WHOLE), Model(WHOLE, part=1)], F.col("part"))
    found = predictions(forest, "p")
    for pack in (64, 2):
        monkeypatch.setattr(T, "PACK", pack)
        model = F.when(F.col("part") == 1, 1).otherwise(0)
        scored = score(found, forest.trees, FEATURES, model, WHOLE.depth, "q")
        gaps = scored.select(F.abs(F.col("q") - F.get("p", model))).collect()
        assert len(gaps) == 490 and max(r[0] for r in gaps) < 1e-12


def test_many_models_equal_one_at_a_time(spark, frame):
    settings = [WHOLE, Boosting(rounds=3, depth=2, rate=0.3, row_share=0.6, column_share=0.7, bins=16, l1=0.0, l2=1.0, min_gain=0.0)]
    models = [Model(s, 0.5, 3.0, part=p) for s in settings for p in (0, 1, 2)]
    together = grow(frame, ["id"], FEATURES, "y", models, F.col("part"))
    every = {r["id"]: r["p"] for r in predictions(together, "p").collect()}
    for i in (1, 4):
        alone = grow(frame, ["id"], FEATURES, "y", [models[i]], F.col("part"))
        own = {r["id"]: r["p"][0] for r in predictions(alone, "p").collect()}
        assert len(own) == 490 and all(abs(every[k][i] - v) < 1e-9 for k, v in own.items())
    # Rows of a model's own part do not move it.
    changed = frame.withColumn("y", F.when(F.col("part") == 1, F.col("y") * 100).otherwise(F.col("y")))
    again = {r["id"]: r["p"] for r in predictions(grow(changed, ["id"], FEATURES, "y", models, F.col("part")), "p").collect()}
    for i, m in enumerate(models):
        same = all(abs(every[k][i] - again[k][i]) < 1e-9 for k in every)
        assert same == (m.part == 1)


def test_negative_parts_and_folds_are_left_out(spark, frame):
    models = [Model(WHOLE), Model(WHOLE, fold=2)]
    part = F.when(F.col("id") % 2 == 0, -1).otherwise(0)
    forest = grow(frame, ["id"], FEATURES, "y", models, part, F.col("part"))
    odd = grow(frame.where("id % 2 = 1 and part <> 2").unionByName(frame.where("id % 2 = 0").withColumn("y", F.lit(None).cast("double"))), ["id"], FEATURES, "y", models[:1], F.lit(0))
    cover = rows(forest.trees.where("place = 0 and tree = 0").select("model", "cover"), "model")
    assert cover[1][1] == odd.trees.where("place = 0 and tree = 0").first()["cover"]
    assert cover[0][1] == frame.where("id % 2 = 1 and y is not null").count()


def test_no_rows_and_stages(spark, frame):
    seen = []
    forest = grow(frame.limit(0), ["id"], FEATURES, "y", [Model(WHOLE)], F.lit(0), stages=[2, 5], at_stage=lambda n, d: seen.append((n, d.count())))
    assert seen == [(2, 0), (5, 0)]
    assert forest.trees.count() == 5 and predictions(forest, "p").count() == 0
    shares = T.importances(forest.trees, FEATURES, 1)
    assert rows(shares, "Feature") == [(0, "a", 0.0), (0, "b", 0.0), (0, "c", 0.0)]
