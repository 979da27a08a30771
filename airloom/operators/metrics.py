"""Scores of predictions: per group, overall, per season."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.operators.ordered import with_previous
from airloom.session import materialize

# Floor of the MAPE denominator, and the size below which a group is flagged.
TINY = 2.220446049250313e-16
SMALL_GROUP = 5
# Rows, about, that one task puts in order.
RANGE_ROWS = 250_000

METRICS = ["RMSE", "MAPE", "MASE", "R2"]


def _whole(parts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Parts of all groups as one sequence through the groups in order.

    Only group rows are touched: the step between two groups goes from the last value of one
    to the first of the next.
    """
    total = parts.agg(F.sum("n"), F.sum(F.col("n") * F.col("mean"))).first()
    centre = total[1] / total[0] if total[0] else 0.0
    joined = with_previous(parts, [], group, {"__left": "last"})
    skipped = F.col("absolute") - F.coalesce("absolute_later", F.lit(0.0))
    return joined.agg(
        F.sum("n").alias("n"),
        F.sum("sse").alias("sse"),
        F.sum(F.col("sst") + F.col("n") * (F.col("mean") - centre) ** 2).alias("sst"),
        F.sum("relative").alias("relative"),
        F.sum("absolute").alias("absolute"),
        (F.sum("absolute") - F.min_by(skipped, F.struct(*group))).alias("absolute_later"),
        F.sum(
            F.coalesce("steps", F.lit(0.0))
            + F.coalesce(F.abs(F.col("first") - F.col("__left")), F.lit(0.0))
        ).alias("steps"),
    )


def _scores(unit: str, seasonal: bool) -> dict[str, Column]:
    n = F.col("n")
    mape = F.col("relative") / n * (100.0 if unit == "percent" else 1.0)
    change = F.try_divide(F.col("steps"), n - 1)
    if seasonal:
        scale = F.when((change == 0) | change.isNull(), F.lit(1.0)).otherwise(change)
        mase = F.col("absolute") / n / scale
    else:
        mase = F.try_divide(F.try_divide(F.col("absolute_later"), n - 1), change)
    r2 = F.lit(1.0) - F.try_divide(F.col("sse"), F.col("sst"))
    # Constant actuals: a perfect fit scores 1, any other 0.
    r2 = F.when(F.col("sst") > 0, r2).when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return {"RMSE": F.sqrt(F.col("sse") / n), "MAPE": mape, "MASE": mase,
            "R2": F.when(n > 1, r2)}


def _prepare(df: DataFrame, actual: str, predicted: str, keep: Sequence[str]) -> DataFrame:
    return df.select(
        *[F.col(f"`{c}`") for c in dict.fromkeys(keep)],
        F.col(f"`{actual}`").cast("double").alias("actual"),
        F.col(f"`{predicted}`").cast("double").alias("predicted"),
    ).where("actual is not null and predicted is not null")


_RUN = {
    "range": pa.int32(), "run": pa.int64(), "n": pa.int64(), **dict.fromkeys(
        ["sse", "sst", "mean", "relative", "absolute", "later", "steps", "opening", "first", "last"], pa.float64()
    ),
}


def _runs(batch: pa.RecordBatch, group: Sequence[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where the runs of a batch of ordered rows begin, and their sums in the order of ``_RUN``.

    A run is a stretch of rows of one group. ``later`` and ``steps`` leave out its first row, whose
    error is ``opening``.
    """
    new = np.zeros(len(batch), bool)
    new[0] = True
    for c in group:
        code = batch.column(c).dictionary_encode("encode").indices.to_numpy()
        new[1:] |= code[1:] != code[:-1]
    begin = np.flatnonzero(new)
    n = np.diff([*begin, len(batch)])
    y, p = (batch.column(c).to_numpy() for c in ("actual", "predicted"))

    def added(x: np.ndarray) -> np.ndarray:
        return np.add.reduceat(x, begin)

    with np.errstate(all="ignore"):
        error = np.abs(y - p)
        relative = added(error / np.maximum(np.abs(y), TINY))
        # From the run's first value on, so that equal values have no deviation at all.
        first = y[begin]
        above = y - first.repeat(n)
        mean = added(above) / n
        sst = added((above - mean.repeat(n)) ** 2)
        step = np.abs(np.diff(y, prepend=y[0]))
        step[begin] = 0.0
        later = np.where(new, 0.0, error)
        sums = [added(error * error), sst, first + mean, relative, added(error), added(later), added(step)]
    return begin, [n, *sums, error[begin], first, y[np.append(begin[1:], len(batch)) - 1]]


def _group_parts(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    actual: str,
    predicted: str,
    max_rows: int,
) -> DataFrame:
    """Sums every score is made of, one row per group.

    Rows are dealt by ranges of group and order, so that a group of any size is spread over tasks.
    Each task sums the runs of its range in order; windows over the runs of a group link them.
    """
    group = list(group)
    rows = _prepare(df, actual, predicted, [*group, *order_by])
    ranges = max(1, -(-rows.count() // max_rows))
    order = [F.col(c).asc_nulls_first() for c in dict.fromkeys([*group, *order_by])]
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    dealt = dealt.select(*group, "actual", "predicted")
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema.fields[:-2]]
    schema = ", ".join([*kinds, "range int, run long, n long", *[f"{c} double" for c in list(_RUN)[3:]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not len(batch):
                continue
            begin, sums = _runs(batch, group)
            place = [np.full(len(begin), at), np.arange(len(begin)) + seen]
            seen += len(begin)
            cells = [pa.array(x).cast(k) for x, k in zip([*place, *sums], _RUN.values(), strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c).take(pa.array(begin)) for c in group], *cells], [*group, *_RUN])

    whole = Window.partitionBy(*group)
    along = whole.orderBy("range", "run")
    linked = dealt.mapInArrow(run, schema).select(
        "*", F.lag("last").over(along).alias("left"), (F.col("mean") - F.first("first").over(along)).alias("above")
    )
    centre = F.sum(F.col("n") * F.col("above")).over(whole) / F.sum("n").over(whole)
    linked = linked.withColumn("centre", centre)
    place, several = F.struct("range", "run"), F.sum("n") > 1
    opening = F.when(F.col("left").isNotNull(), F.col("opening")).otherwise(0.0)
    joint = F.coalesce(F.abs(F.col("first") - F.col("left")), F.lit(0.0))
    return linked.groupBy(*group).agg(
        F.sum("n").alias("n"),
        F.sum("sse").alias("sse"),
        F.sum(F.col("sst") + F.col("n") * (F.col("above") - F.col("centre")) ** 2).alias("sst"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.sum("relative").alias("relative"),
        F.sum("absolute").alias("absolute"),
        F.when(several, F.sum(F.col("later") + opening)).alias("absolute_later"),
        F.when(several, F.sum(F.col("steps") + joint)).alias("steps"),
        F.min_by("first", place).alias("first"),
        F.max_by("last", place).alias("last"),
    )


def group_scores(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    actual: str = "actual",
    predicted: str = "predicted",
    unit: str = "fraction",
    seasonal: bool = False,
    max_rows: int = RANGE_ROWS,
) -> DataFrame:
    """RMSE, MAPE, MASE and R2 per group, with flags for small groups and negative R2.

    MASE follows ``order_by`` within the group. ``seasonal`` takes the error over all rows and
    a scale of 1 where the actual value never changes. ``unit`` is fraction or percent.
    """
    parts = _group_parts(df, group, order_by, actual, predicted, max_rows)
    scores = _scores(unit, seasonal)
    return parts.select(
        *group,
        "n",
        *[scores[m].alias(m) for m in METRICS],
        (F.col("n") < SMALL_GROUP).alias("small_group"),
        (scores["R2"] < 0).alias("negative_r2"),
    )


def score_table(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    label: str,
    unit: str = "fraction",
    actual: str = "actual",
    predicted: str = "predicted",
    max_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Long table of scores per group plus rows labelled Overall.

    ``label`` is the group column that names the group; the overall sequence runs through
    the groups in order, row order within. Both come from one pass over the rows.
    """
    parts = materialize(
        _group_parts(df, group, order_by, actual, predicted, max_rows), "score-parts"
    )
    scores = _scores(unit, seasonal=False)
    found = [scores[m].alias(m) for m in METRICS]
    grouped = parts.select(*group, *found).withColumn(label, F.col(label).cast("string"))
    whole = _whole(parts, group).select(F.lit("Overall").alias(label), *found)
    table = grouped.unionByName(whole, allowMissingColumns=True)
    values = F.inline(
        F.array(*[F.struct(F.lit(m).alias("Metric"), F.col(m).alias("Value")) for m in METRICS])
    )
    return table.select(*group, values)


def season_scores(
    df: DataFrame,
    order_by: Sequence[str],
    season: str = "Season",
    actual: str = "actual",
    predicted: str = "predicted",
    max_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row of scores per season, MAPE in percent."""
    scores = group_scores(df, [season], order_by, actual, predicted, "percent", True, max_rows)
    return scores.select(season, *METRICS)


def distinct_stations(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Distinct coordinates, rounded half-even if ``digits`` is given, with row counts."""
    lon, lat = F.col("Longitude"), F.col("Latitude")
    if digits is not None:
        lon, lat = F.bround(lon, digits), F.bround(lat, digits)
    return df.groupBy(lon.alias("Longitude"), lat.alias("Latitude")).agg(
        F.count(F.lit(1)).alias("rows")
    )
