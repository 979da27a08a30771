"""Daily series with complete calendars, date parsing and date ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.functions.dates import TEXT_DATE, parse_timestamp

# Analysed period. The upper bound is a midnight.
PERIOD_START = "2018-01-01"
PERIOD_END = "2023-12-31"


def within_period(
    df: DataFrame,
    start: str = PERIOD_START,
    end: str = PERIOD_END,
    date: str = "date",
    inclusive_day: bool = False,
) -> DataFrame:
    """Rows from ``start`` to ``end``. Of the last day only midnight counts, unless
    ``inclusive_day`` takes it whole."""
    low = F.lit(start).cast("timestamp_ntz")
    if inclusive_day:
        after = (F.lit(end).cast("date") + F.expr("interval 1 day")).cast("timestamp_ntz")
        return df.where((F.col(date) >= low) & (F.col(date) < after))
    return df.where((F.col(date) >= low) & (F.col(date) <= F.lit(end).cast("timestamp_ntz")))


def parse_dates(df: DataFrame, date: str = "date") -> DataFrame:
    """Date column as a timestamp, rows without a readable date dropped."""
    if isinstance(df.schema[date].dataType, T.StringType):
        df = df.withColumn(date, parse_timestamp(F.col(date)))
    return df.na.drop(subset=[date])


def daily_mean(
    df: DataFrame,
    columns: Sequence[str],
    group: Sequence[str] = ("station",),
    date: str = "date",
) -> DataFrame:
    """Mean of each column per group and day, with a row for every day from the group's
    first to its last; days without rows are null.

    Partial means are made before the shuffle. The gap days come from the distance to the
    next observed day, so no calendar is joined.
    """
    day = F.col(date).cast("date")
    means = [
        F.avg(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None))).alias(c) for c in columns
    ]
    daily = (
        df.where(F.col(date).isNotNull())
        .select(*group, day.alias("__day"), *[F.col(f"`{c}`") for c in columns])
        .groupBy(*group, "__day")
        .agg(*means)
    )
    # One row per calendar day and group from here on.
    following = F.lead("__day").over(Window.partitionBy(*group).orderBy("__day"))
    until = F.coalesce(F.date_sub(following, 1), F.col("__day"))
    spread = daily.select("*", until.alias("__until")).select(
        "*", F.explode(F.sequence("__day", "__until", F.expr("interval 1 day"))).alias(date)
    )
    observed = F.col(date) == F.col("__day")
    return spread.select(
        *group, date, *[F.when(observed, F.col(f"`{c}`")).alias(c) for c in columns]
    )


def from_first_date(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows that carry a date; undated header rows before the first one cannot be joined."""
    return df.where(F.col(date).isNotNull())


def first_dates(df: DataFrame, group: Sequence[str], date: str = "date") -> DataFrame:
    """First present date of each group."""
    return df.groupBy(*group).agg(F.min(date).alias("first_date"))


def date_order(date: str = "date", lexical: bool = False) -> Column:
    """Sort key: chronological, or the text MM/dd/yyyy, which sorts by month first."""
    return F.date_format(date, TEXT_DATE) if lexical else F.col(date)
