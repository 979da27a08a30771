"""Distribution summary, correlation and the choice of columns to analyse."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.functions.cells import numeric_columns
from airloom.operators.ordered import MAX_GROUP_ROWS
from airloom.operators.ranks import percentiles

# Percentiles reported, calendar columns left out, decimals shown.
REPORTED = (0.2, 0.4, 0.5, 0.6, 0.8)
CALENDAR = ("Year", "Month", "Day", "COVID-19")
DECIMALS = 2


def analysed_columns(df: DataFrame, excluded: Sequence[str] = CALENDAR) -> list[str]:
    """Numeric columns that vary, are no calendar column and no complete 0/1 indicator.

    One aggregate row comes to the driver. A column with too few values for a variance
    passes, as does an indicator with missing cells.
    """
    names = [c for c in numeric_columns(df) if c not in set(excluded)]
    if not names:
        return []
    probes = []
    for i, c in enumerate(names):
        cell = F.col(f"`{c}`")
        probes.append(F.var_samp(cell).alias(f"v{i}"))
        binary = cell.isin(0, 1)
        probes.append(F.min(F.coalesce(binary, F.lit(False))).alias(f"b{i}"))
    seen = df.agg(*probes).first()
    return [c for i, c in enumerate(names) if seen[f"v{i}"] != 0 and not seen[f"b{i}"]]


def summary(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = REPORTED,
    decimals: int = DECIMALS,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """One row per column: counts, mean, sample deviation, range and exact percentiles.

    Columns without a value are left out.
    """
    cells = [
        F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(c) for c in columns
    ]
    long = df.select(*cells).unpivot([], list(columns), "Metric", "value")
    moments = long.groupBy("Metric").agg(
        F.count(F.lit(1)).alias("total"),
        F.count("value").alias("valid"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    ranks = percentiles(long, "value", probabilities, ["Metric"], max_rows)
    # One row per analysed column on both sides.
    both = moments.join(ranks, "Metric")
    rounded = [F.bround(c, decimals).alias(c) for c in ("mean", "std", "min")]
    rounded += [
        F.bround(f"p{round(p * 100)}", decimals).alias(f"p{round(p * 100)}")
        for p in probabilities
    ]
    share = F.col("valid") / F.col("total") * 100.0
    return both.select(
        "Metric",
        "total",
        F.bround(share, decimals).alias("valid_percent"),
        F.bround((F.col("total") - F.col("valid")) / F.col("total") * 100.0, decimals).alias(
            "missing_percent"
        ),
        *rounded,
        F.bround("max", decimals).alias("max"),
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered column pair, each over the rows that have both.

    One pass and one row of partial results; the pairs are spread out afterwards.
    """
    cells = [
        F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(f"c{i}")
        for i, c in enumerate(columns)
    ]
    numbered = list(enumerate(columns))
    found, rows = [], []
    for (i, a), (j, b) in combinations(numbered, 2):
        found.append(F.corr(f"c{i}", f"c{j}").alias(f"r{i}_{j}"))
        rows += [(a, b, f"r{i}_{j}"), (b, a, f"r{i}_{j}")]
    for i, a in numbered:
        found.append(F.corr(f"c{i}", f"c{i}").alias(f"r{i}_{i}"))
        rows.append((a, a, f"r{i}_{i}"))
    one = df.select(*cells).agg(*found)
    pairs = F.array(
        *[
            F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(name).alias("r"))
            for a, b, name in rows
        ]
    )
    return one.select(F.inline(pairs)).toDF("column_a", "column_b", "correlation")
