"""Exact ranks, ECDF, pruning of distribution tails, and percentiles.

Values are counted first, so copies of a value cost one row each, and the running count is
sliced along the value where a column has more distinct values than one task should sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions.cells import present
from airloom.operators.ordered import MAX_GROUP_ROWS, join_summary, slice_hot_groups
from airloom.session import broadcast_checked, materialize

# Share of each tail that is pruned, and the columns pruned.
TAIL_SHARE = 0.001
PRUNED_COLUMNS = ("PM10", "PM2.5")


def value_ranks(
    df: DataFrame,
    value: str,
    group: Sequence[str] = (),
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per distinct present value: ``n_value``, ``rank_first``, ``rank_last``, ``n``."""
    group = list(group)
    counts = df.select(*group, present(df, value).alias(value)).where(F.col(value).isNotNull())
    counts = counts.groupBy(*group, value).agg(F.count(F.lit(1)).alias("n_value"))
    # Everything else follows from the counts, so the rows are read once.
    counts = materialize(counts, "value-counts")
    sizes = materialize(
        counts.groupBy(*group).agg(
            F.count(F.lit(1)).alias("distinct"), F.sum("n_value").alias("n")
        ),
        "group-sizes",
    )
    keys: list[str] = []
    if (sizes.agg(F.max("distinct")).first()[0] or 0) > max_rows:
        counts, keys = slice_hot_groups(counts, group, [value], max_rows)
    running = Window.partitionBy(*group, *keys).orderBy(value)
    running = running.rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.withColumn("rank_last", F.sum("n_value").over(running))
    if keys:
        along = Window.partitionBy(*group).orderBy(*keys)
        offsets = (
            counts.where(F.col(keys[0]) >= 0)
            .groupBy(*group, *keys)
            .agg(F.sum("n_value").alias("__sum"))
            .select(
                *group,
                *keys,
                (F.sum("__sum").over(along) - F.col("__sum")).alias("__off"),
            )
        )
        ranked = join_summary(ranked, offsets, [*group, *keys])
        ranked = ranked.withColumn("rank_last", F.col("rank_last") + F.coalesce("__off", F.lit(0)))
    # One row per group.
    if group:
        ranked = join_summary(ranked, sizes.select(*group, "n"), group, broadcast_checked)
    else:
        ranked = ranked.withColumn("n", F.lit(sizes.first()["n"]))
    first = (F.col("rank_last") - F.col("n_value") + 1).alias("rank_first")
    return ranked.select(*group, value, "n_value", first, "rank_last", "n")


def ecdf_points(
    df: DataFrame, value: str, group: Sequence[str] = (), max_rows: int = MAX_GROUP_ROWS
) -> DataFrame:
    """Sorted present values with the share i/n at the last copy of each value.

    ``n_value`` copies of a value take the shares from ``ecdf_first`` up to ``ecdf``.
    """
    ranked = value_ranks(df, value, group, max_rows)
    n = F.col("n").cast("double")
    return ranked.select(
        *group,
        value,
        "n_value",
        (F.col("rank_first") / n).alias("ecdf_first"),
        (F.col("rank_last") / n).alias("ecdf"),
    )


def tail_cuts(
    df: DataFrame,
    columns: Sequence[str],
    share: float = TAIL_SHARE,
    max_rows: int = MAX_GROUP_ROWS,
) -> dict[str, tuple[float | None, float | None]]:
    """Per column the largest value cut at the low end and the smallest cut at the high end."""
    there = [c for c in columns if c in df.columns]
    long = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(there)])
    long = long.unpivot([], long.columns, "column", "value")
    points = ecdf_points(long, "value", ["column"], max_rows)
    cuts = points.groupBy("column").agg(
        F.max(F.when(F.col("ecdf_first") <= share, F.col("value"))).alias("low"),
        F.min(F.when(F.col("ecdf") >= 1 - share, F.col("value"))).alias("high"),
    )
    # One row per pruned column.
    found = {row["column"]: (row["low"], row["high"]) for row in cuts.collect()}
    return {c: found.get(f"v{i}", (None, None)) for i, c in enumerate(there)}


def prune_tails(
    df: DataFrame,
    columns: Sequence[str] = PRUNED_COLUMNS,
    share: float = TAIL_SHARE,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Null every value in the lowest or highest ``share`` of its column's distribution.

    The cut is by value, so all copies of a cut value go.
    """
    for name, (low, high) in tail_cuts(df, columns, share, max_rows).items():
        c = present(df, name)
        outside = F.lit(False)
        if low is not None:
            outside = outside | (c <= low)
        if high is not None:
            outside = outside | (c >= high)
        df = df.withColumn(name, F.when(~outside, c))
    return df


def percentiles(
    df: DataFrame,
    value: str,
    probabilities: Sequence[float],
    group: Sequence[str] = (),
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Exact percentiles with linear interpolation, one column ``p<percent>`` each,
    and the number of values ``n``."""
    group = list(group)
    ranked = value_ranks(df, value, group, max_rows)
    at = {}
    for p in probabilities:
        place = (F.col("n") - 1) * F.lit(float(p))
        for end, rank in (("lo", F.floor(place) + 1), ("hi", F.ceil(place) + 1)):
            hit = (F.col("rank_first") <= rank) & (rank <= F.col("rank_last"))
            at[f"__{end}{p}"] = F.max(F.when(hit, F.col(value)))
    found = ranked.groupBy(*group).agg(
        F.max("n").alias("n"), *[c.alias(name) for name, c in at.items()]
    )
    out = []
    for p in probabilities:
        place = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.col(f"`__lo{p}`"), F.col(f"`__hi{p}`")
        out.append((low + (high - low) * (place - F.floor(place))).alias(f"p{round(p * 100)}"))
    return found.select(*group, "n", *out)
