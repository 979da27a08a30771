"""Cell-value helpers: missing values, sentinels, rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: precipitation reading that stands for "missing".
PRECIPITATION_SENTINEL = -0.0000000009313226


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every floating column with NaN replaced by null."""
    return df.select(*[present(df, c).alias(c) for c in df.columns])


def present(df: DataFrame, column: str) -> Column:
    """A column's values, NaN as null where its type has NaN."""
    kind = df.schema[column].dataType
    c = F.col(f"`{column}`")
    return F.nanvl(c, F.lit(None)) if isinstance(kind, (T.DoubleType, T.FloatType)) else c


def sentinel_to_null(c: Column, sentinel: float = PRECIPITATION_SENTINEL) -> Column:
    return F.nullif(c, F.lit(sentinel))


def round_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def missing_percent(c: Column) -> Column:
    return F.avg(c.isNull().cast("int")) * 100.0


def valid_percent(c: Column) -> Column:
    return F.avg(c.isNotNull().cast("int")) * 100.0


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def other_columns(df: DataFrame) -> list[str]:
    numeric = set(numeric_columns(df))
    return [c for c in df.columns if c not in numeric]

