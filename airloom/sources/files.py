"""Folders of station and grid files."""

from __future__ import annotations

import re
from collections.abc import Callable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.functions.cells import nan_to_null
from airloom.functions.names import file_stem
from airloom.operators.calendar import parse_dates


def read_tree(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    file_format: str = "parquet",
    pattern: str | None = None,
) -> DataFrame:
    """Every file below a folder, at any depth, whose name fits ``pattern``; its path in
    ``path``."""
    reader = spark.read.format(file_format).schema(schema).option("recursiveFileLookup", True)
    reader = reader.option("pathGlobFilter", pattern or f"*.{file_format}")
    if file_format == "csv":
        reader = reader.option("header", True)
    return nan_to_null(reader.load(folder).select("*", F.col("_metadata.file_path").alias("path")))


def _entry_below(path: Column, folder: str) -> Column:
    """Name of the file or folder directly below ``folder`` on a path."""
    plain = quote("/" + re.sub(r"^[\w+.-]+:/+", "", folder).strip("/"))
    return F.url_decode(F.regexp_extract(path, re.escape(plain) + "/([^/]+)", 1))


def read_station_files(
    spark: SparkSession, folder: str, schema: T.StructType, file_format: str = "parquet"
) -> DataFrame:
    """Every station file of a folder: its name up to the first dot is the station, and
    ``date`` is parsed. A station's file may itself be a folder of part files."""
    reader = spark.read.format(file_format).schema(schema).option("recursiveFileLookup", True)
    if file_format == "csv":
        reader = reader.option("header", True)
    named = reader.load(folder).select(
        file_stem(_entry_below(F.col("_metadata.file_path"), folder)).alias("station"), "*"
    )
    return parse_dates(nan_to_null(named))


def read_combined(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of a folder's files. Column names are stripped, and columns a file lacks
    are null."""
    reader = spark.read.option("mergeSchema", True).option("recursiveFileLookup", True)
    found = nan_to_null(reader.parquet(folder))
    same: dict[str, list[Column]] = {}
    for c in found.columns:
        same.setdefault(c.strip(), []).append(found[f"`{c}`"])
    return found.select(*[F.coalesce(*cols).alias(name) for name, cols in same.items()])


def apply_to_folder(
    spark: SparkSession, folder: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """One transformation over every table of a folder, keyed by ``station``, the table's name:
    one read and one job whatever the number of tables."""
    return transform(read_station_files(spark, folder, schema))
