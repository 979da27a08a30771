"""Standard scaling with training statistics, and fold statistics without rescans."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Scale = dict[str, tuple[float, float]]


def fit_scale(df: DataFrame, columns: Sequence[str]) -> Scale:
    """Mean and population deviation per column; a constant column gets deviation 1.

    One pass; two numbers per column come to the driver.
    """
    found = []
    for i, c in enumerate(columns):
        cell = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))
        found += [F.avg(cell).alias(f"m{i}"), F.stddev_pop(cell).alias(f"s{i}")]
    row = df.agg(*found).first()
    return {
        c: (row[f"m{i}"] if row[f"m{i}"] is not None else 0.0, row[f"s{i}"] or 1.0)
        for i, c in enumerate(columns)
    }


def scaled(column: str, scale: Scale) -> Column:
    mean, deviation = scale[column]
    return (F.col(f"`{column}`").cast("double") - F.lit(mean)) / F.lit(deviation)


def apply_scale(df: DataFrame, scale: Scale, suffix: str = "_scaled") -> DataFrame:
    return df.select("*", *[scaled(c, scale).alias(f"{c}{suffix}") for c in scale])


def unscaled(value: Column, column: str, scale: Scale) -> Column:
    mean, deviation = scale[column]
    return value * F.lit(deviation) + F.lit(mean)


# Number, mean, summed squared deviations, smallest and largest of a set of values.
Moments = tuple[int, float, float, float, float]
_NOTHING: Moments = (0, 0.0, 0.0, math.inf, -math.inf)


def _merged(a: Moments, b: Moments) -> Moments:
    """Moments of two sets together; nothing is subtracted that could cancel."""
    n = a[0] + b[0]
    if not a[0] or not b[0]:
        return a if a[0] else b
    gap = b[1] - a[1]
    mean = a[1] + gap * (b[0] / n)
    return n, mean, a[2] + b[2] + gap * gap * (a[0] / n * b[0]), min(a[3], b[3]), max(a[4], b[4])


def _rests(parts: pd.DataFrame) -> pd.DataFrame:
    """Moments of all other folds for each fold: those before it merged with those after it."""
    rows = list(zip(parts["n"], parts["m"], parts["q"], parts["lo"], parts["hi"], strict=True))
    rows = [r if r[0] else _NOTHING for r in rows]
    before = [_NOTHING, *accumulate(rows[:-1], _merged)]
    after = [_NOTHING, *accumulate(rows[:0:-1], _merged)][::-1]
    rest = [_merged(a, b) for a, b in zip(before, after, strict=True)]
    out = parts.drop(columns=["n", "m", "q", "lo", "hi"])
    out["train_n"] = [r[0] for r in rest]
    out["train_mean"] = [r[1] for r in rest]
    # A column is constant if its smallest value is its largest.
    out["train_std"] = [math.sqrt(r[2] / r[0]) if r[3] < r[4] else 1.0 for r in rest]
    return out[out["train_n"] > 0]


def fold_scales(df: DataFrame, fold: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per fold and column, mean and deviation of all rows outside the fold.

    Rows are read once, for the moments of every fold and column; then one row per fold is merged
    into the moments of the rest, in fold order. Folds that hold every row are left out. Columns:
    fold, ``column``, ``train_n``, ``train_mean``, ``train_std``.
    """
    fold = list(fold)
    stats = []
    for i, c in enumerate(columns):
        cell = F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))
        stats.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(cell).alias("n"),
                F.coalesce(F.avg(cell), F.lit(0.0)).alias("m"),
                F.coalesce(F.var_pop(cell) * F.count(cell), F.lit(0.0)).alias("q"),
                F.coalesce(F.min(cell), F.lit(math.inf)).alias("lo"),
                F.coalesce(F.max(cell), F.lit(-math.inf)).alias("hi"),
            ).alias(f"s{i}")
        )
    folds = df.groupBy(*fold).agg(*stats)
    parts = folds.select(*fold, F.inline(F.array(*[f"s{i}" for i in range(len(stats))])))
    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in fold]
    schema = ", ".join([*kinds, "column string, train_n long, train_mean double, train_std double"])

    def merge(parts: pd.DataFrame) -> pd.DataFrame:
        return _rests(parts.sort_values(fold, kind="stable"))

    return parts.groupBy("column").applyInPandas(merge, schema)
