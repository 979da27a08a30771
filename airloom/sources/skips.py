"""A channel for what a flow leaves out, filled in the pass that leaves it out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SKIPPED = "reason string, item string"


class Skips:
    """Counts skipped rows by reason, and lists the files, variables or stations concerned.

    ``drop`` takes rows out of a frame; when the frame, or anything made of it, has been computed,
    the counts and items are there. No scan is added. Items come as one set per rule, so they
    should be names (of files, variables, stations), not rows.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[list[str], Observation]] = []

    def drop(self, df: DataFrame, rules: dict[str, tuple[Column, Column]]) -> DataFrame:
        """Rows that no rule skips. A rule is a condition and the item it names; the first that
        holds is a row's reason."""
        reason = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(i)) for i, (c, _) in enumerate(rules.values())])
        marked = df.withColumn("__reason", reason)
        seen = Observation()
        found = []
        for i, (_, item) in enumerate(rules.values()):
            own = F.col("__reason") == i
            found.append(F.count(F.when(own, F.lit(1))).alias(f"n{i}"))
            found.append(F.collect_set(F.when(own, item.cast("string"))).alias(f"items{i}"))
        self._seen.append((list(rules), seen))
        return marked.observe(seen, *found).where("__reason is null").drop("__reason")

    def counts(self, spark: SparkSession) -> DataFrame:
        """Rows (reason, rows)."""
        found = [(r, seen.get[f"n{i}"]) for reasons, seen in self._seen for i, r in enumerate(reasons)]
        return spark.createDataFrame(found, "reason string, rows long")

    def items(self, spark: SparkSession) -> DataFrame:
        """Rows (reason, item)."""
        found = [
            (r, item) for reasons, seen in self._seen for i, r in enumerate(reasons) for item in sorted(seen.get[f"items{i}"])
        ]
        return spark.createDataFrame(found, SKIPPED)
