"""Writers. One partitioned table replaces a table or file per station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from airloom.functions.dates import STRICT_FORMAT

CSV_TIMESTAMP = STRICT_FORMAT.replace(" ", "'T'")


def _balanced(df: DataFrame, column: str) -> DataFrame:
    """Rows of a partition value together, large values split into several even files."""
    return df.hint("rebalance", column)


def replace_facts(df: DataFrame, path: str, station: str = "station") -> None:
    """Write facts by station. Stations in ``df`` are replaced, others stay."""
    writer = _balanced(df, station).write.mode("overwrite").partitionBy(station)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def append_facts(df: DataFrame, path: str, station: str = "station") -> None:
    _balanced(df, station).write.mode("append").partitionBy(station).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Whole table with a header line per file, timestamps to the microsecond."""
    writer = df.write.mode("overwrite").option("header", True)
    writer.option("timestampNTZFormat", CSV_TIMESTAMP).csv(path)


def write_per_station(df: DataFrame, path: str, station: str = "station") -> None:
    _balanced(df, station).write.mode("overwrite").partitionBy(station).parquet(path)


def write_per_metric(scores: DataFrame, path: str) -> None:
    scores.write.mode("overwrite").partitionBy("Metric").parquet(path)


def predictions_layout(
    df: DataFrame, keys: Sequence[str], actual: str, predicted: str
) -> DataFrame:
    """Key columns, actual and predicted value, then the rest."""
    lead = list(dict.fromkeys([*keys, actual, predicted]))
    return df.select(*[f"`{c}`" for c in lead + [c for c in df.columns if c not in lead]])


def write_predictions(
    df: DataFrame, path: str, keys: Sequence[str], actual: str, predicted: str
) -> None:
    predictions_layout(df, keys, actual, predicted).write.mode("overwrite").parquet(path)
