"""Gradient-boosted tree regression: fit, search, predict, importances, persistence."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.operators import trees as T
from airloom.operators.scaling import Scale, unscaled
from airloom.operators.shared_sums import fits
from airloom.operators.splits import k_folds
from airloom.operators.trees import Boosting, Forest, Model, grow

__all__ = ["Boosting", "GRID", "Fitted", "fit", "fit_parts", "load_model", "mean_importances", "predict", "save_model", "search", "settings_of", "top_features"]

# The grid the chosen setting comes from.
TOP_FEATURES = 20
GRID = {
    "rounds": [500, 1000, 2000, 5000],
    "depth": [5, 7, 9, 11],
    "rate": [0.01, 0.1, 0.3],
    "row_share": [0.7, 0.8, 0.9],
    "column_share": [0.7, 0.8, 0.9],
    "l1": [0.1, 0.5, 1.0],
    "l2": [0.1, 0.5, 1.0],
    "bins": [256, 512],
    "min_gain": [1.0, 10.0],
}

#: A part that a model leaves out, none for a model of all rows.
Part = int | None


@dataclass(frozen=True)
class Fitted:
    """One model: its trees, what they read and how deep they are."""

    trees: DataFrame
    features: list[str]
    depth: int


def settings_of(base: Boosting, grid: dict[str, Sequence]) -> list[Boosting]:
    """Every combination of the grid's values, the last axis fastest."""
    return [replace(base, **dict(zip(grid, values, strict=True))) for values in product(*grid.values())]


def fit(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, setting: Boosting, scale: Scale
) -> Fitted:
    """A model of all rows with a target; missing features are allowed."""
    forest = grow(df, keys, features, target, [Model(setting, *scale[target])], F.lit(0))
    return Fitted(forest.trees, forest.features, setting.depth)


def fit_parts(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, part: Column,
    scales: dict[Part, tuple[float, float]], settings: dict[Part, Boosting],
) -> Iterator[tuple[list[Part], Forest]]:
    """A model without each part, ``MODELS_AT_ONCE`` in one run of jobs, small ones all at once."""
    parts = list(scales)
    models = [Model(settings[p], *scales[p], part=p) for p in parts]
    most = max(1, len(parts)) if models and fits(models, len(features)) else T.MODELS_AT_ONCE
    for at in range(0, len(parts), most):
        yield parts[at : at + most], grow(df, keys, features, target, models[at : at + most], part)


def search(
    df: DataFrame, keys: Sequence[str], features: Sequence[str], target: str, part: Column,
    scales: dict[Part, tuple[float, float]], base: Boosting, grid: dict[str, Sequence] | None, folds: int,
    order: Column | None = None,
) -> tuple[dict[Part, Boosting], dict[Part, list[float]]]:
    """Best setting for a model without each part, by cross-validated mean squared error.

    Folds are shuffled over all rows; a model for a part never sees that part. All settings, folds
    and parts grow together. Settings that differ only in ``rounds`` are one model, read after
    each of these numbers of trees. Errors, of the scaled target and averaged over folds, come in
    the order of the grid, and of equal ones the first wins. Without a grid it is ``GRID``.
    """
    settings = settings_of(base, GRID if grid is None else grid)
    alike: dict[Boosting, list[int]] = {}
    for i, s in enumerate(settings):
        alike.setdefault(replace(s, rounds=0), []).append(i)
    table = df.withColumn("__parts", part.cast("int"))
    table = k_folds(table, keys, folds, "__folds", order)
    jobs = [(p, group, f) for p in scales for group in alike for f in range(folds)]
    errors: dict[tuple, dict[int, float]] = {}
    for at in range(0, len(jobs), T.MODELS_AT_ONCE):
        own = jobs[at : at + T.MODELS_AT_ONCE]
        models = [
            Model(replace(group, rounds=max(settings[i].rounds for i in alike[group])), *scales[p], part=p, fold=f)
            for p, group, f in own
        ]
        stages = sorted({settings[i].rounds for _, group, _ in own for i in alike[group]})

        def read(rounds: int, sums: DataFrame, own=own) -> None:
            found = _mean_errors(sums)
            for m, (p, group, f) in enumerate(own):
                for i in alike[group]:
                    if settings[i].rounds == rounds and m in found:
                        errors.setdefault((p, i), {})[f] = found[m]

        grow(table, keys, features, target, models, F.col("__parts"), F.col("__folds"), stages, read, held=True)
    best, means = {}, {}
    for p in scales:
        own_errors = [errors.get((p, i), {}) for i in range(len(settings))]
        means[p] = [sum(e.values()) / len(e) if e else float("inf") for e in own_errors]
        best[p] = settings[means[p].index(min(means[p]))]
    return best, means


def _mean_errors(sums: DataFrame) -> dict[int, float]:
    """Mean squared error of every model on the fold it leaves out."""
    added = sums.groupBy("model").agg(F.sum("e").alias("e"), F.sum("n").alias("n")).where("n > 0")
    return {r["model"]: r["e"] / r["n"] for r in added.collect()}


def predict(model: Fitted, df: DataFrame, target: str, scale: Scale, out: str) -> DataFrame:
    """Predictions in the target's own unit, in one scan."""
    scored = T.score(df, model.trees, model.features, F.lit(0), model.depth, out)
    return scored.withColumn(out, unscaled(F.col(out), target, scale))


def mean_importances(per_fold: DataFrame) -> DataFrame:
    """Mean importance across folds, largest first."""
    mean = per_fold.groupBy("Feature").agg(F.avg("Importance").alias("Importance"))
    return mean.orderBy(F.desc("Importance"), "Feature")


def top_features(df: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    return df.orderBy(F.desc("Importance"), "Feature").limit(n)


_SCALE = "position int, column string, role string, mean double, deviation double, depth int"


def save_model(
    spark: SparkSession, model: Fitted, scale: Scale, target: str, path: str
) -> None:
    """Trees, scaling and feature list below one folder."""
    model.trees.write.mode("overwrite").parquet(f"{path}/trees")
    names = [*model.features, target]
    rows = [
        (i, c, "target" if i == len(model.features) else "feature", *map(float, scale[c]), model.depth)
        for i, c in enumerate(names)
    ]
    spark.createDataFrame(rows, _SCALE).coalesce(1).write.mode("overwrite").json(f"{path}/scale")


def load_model(spark: SparkSession, path: str) -> tuple[Fitted, Scale, str]:
    trees = spark.read.schema(T.TREES).parquet(f"{path}/trees")
    rows = spark.read.schema(_SCALE).json(f"{path}/scale").orderBy("position").collect()
    scale = {r["column"]: (r["mean"], r["deviation"]) for r in rows}
    features = [r["column"] for r in rows if r["role"] == "feature"]
    target = next(r["column"] for r in rows if r["role"] == "target")
    return Fitted(trees, features, rows[0]["depth"]), scale, target
