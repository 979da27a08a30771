"""File-at-a-time ingestion of grid files into the station fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from airloom.operators.spatial import interpolate
from airloom.session import lookup_table
from airloom.sources.grids import grid_observations


def ingest_grid_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    neighbours: DataFrame,
    facts: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    bytes_per_batch: int = 1_000_000_000,
) -> None:
    """Interpolate each arriving grid file onto the stations and append it to ``facts``.

    Files are taken in batches, of bounded size or of so many files, so those before a failing
    one stay saved, and the stream's checkpoint keeps each from being taken twice. A batch writes
    its own partition, which a retry replaces. All files present are worked off, then the call
    returns. The neighbours are written, and their join decided, once for all batches.
    """
    source = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    else:
        source = source.option("maxBytesPerTrigger", bytes_per_batch)
    files = source.parquet(folder)
    near = lookup_table(neighbours, "neighbours")

    def append(batch: DataFrame, number: int) -> None:
        series = interpolate(
            grid_observations(batch), near, ["time", "variable"], written=True
        )
        series.write.mode("overwrite").parquet(f"{facts}/batch={number}")

    query = (
        files.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
