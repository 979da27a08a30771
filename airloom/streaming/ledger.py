"""Ingestion with a ledger: facts by station, every file once, whatever fails in between.

A batch writes its facts below ``batch=<name>``, by station, then one ledger file with its source
files. Only batches in the ledger are read, so what a killed batch left behind is never seen, and
its files are taken again. Compaction writes several batches as one and switches to it by one more
ledger file. Of a source file's entries the last counts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from airloom.session import broadcast_checked

ENTRIES = "file string, batch string, sequence long"


class Ledger:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.path, self.facts = spark, f"{root}/ledger", f"{root}/facts"

    def entries(self) -> DataFrame:
        """The batch that each taken file's facts are in."""
        try:
            every = self.spark.read.schema(ENTRIES).parquet(self.path)
        except AnalysisException:
            every = self.spark.createDataFrame([], ENTRIES)
        return every.groupBy("file").agg(
            F.max_by("batch", "sequence").alias("batch"), F.max("sequence").alias("sequence")
        )

    def batches(self) -> list[str]:
        return [r["batch"] for r in self.entries().select("batch").distinct().orderBy("batch").collect()]

    def write(self, facts: DataFrame, station: str) -> str:
        """Facts of a new batch, by station; not yet seen by anyone."""
        name = uuid.uuid4().hex
        dealt = facts.repartition(F.col(f"`{station}`"))
        dealt.write.partitionBy(station).parquet(f"{self.facts}/batch={name}")
        return name

    def commit(self, files: DataFrame, batch: str) -> None:
        """Puts files into a batch. One file is written, so it is there as a whole or not at all."""
        last = self.entries().agg(F.max("sequence")).first()[0]
        rows = files.select("file", F.lit(batch).alias("batch"), F.lit((last or 0) + 1).cast("long").alias("sequence"))
        rows.coalesce(1).write.mode("append").parquet(self.path)

    def read(self, schema: str | T.StructType) -> DataFrame:
        """Facts of all committed batches; a filter on the station reads its folders only."""
        paths = [f"{self.facts}/batch={b}" for b in self.batches()]
        if not paths:
            return self.spark.createDataFrame([], schema)
        found = self.spark.read.schema(schema).option("basePath", self.facts).parquet(*paths)
        return found.drop("batch")

    def compact(self, schema: str | T.StructType, station: str) -> None:
        """All committed batches as one. What was read before stays in place for its readers."""
        if len(self.batches()) > 1:
            files = self.entries().select("file")
            self.commit(files, self.write(self.read(schema), station))


def ingest(
    spark: SparkSession,
    folder: str,
    schema: str | T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    ledger: Ledger,
    checkpoint: str,
    station: str = "station",
    files_per_batch: int | None = None,
) -> None:
    """Takes every file below ``folder`` that the ledger does not have, and returns.

    ``transform`` makes facts of rows; it sees the rows' file in ``path``.
    """
    source = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    if files_per_batch:
        source = source.option("maxFilesPerTrigger", files_per_batch)
    rows = source.parquet(folder).select("*", F.col("_metadata.file_path").alias("path"))

    def take(batch: DataFrame, _: int) -> None:
        # A batch that failed after its commit comes again and has nothing left to do.
        taken = broadcast_checked(ledger.entries().select(F.col("file").alias("path")))
        new = batch.join(taken, "path", "left_anti")
        files = new.select(F.col("path").alias("file")).distinct()
        if not files.isEmpty():
            ledger.commit(files, ledger.write(transform(new), station))

    query = (
        rows.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
