"""Connected components of a large graph by contraction, then by merging within one task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import materialize

#: Links that one task merges in memory.
TASK_LINKS = 1_000_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every node of a task's links with the smallest node that these links join it to."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while top.setdefault(x, x) != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    yield pa.RecordBatch.from_arrays(
        [pa.array(top, pa.int64()), pa.array([find(x) for x in top], pa.int64())], ["node", "root"]
    )


def _contracted(links: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Rows (node, root), and the links between roots.

    Every node points to whichever of itself and its neighbours has the least hash, another hash at
    every level. Chains of pointers are then as short as the logarithm of the nodes, and about half
    of the nodes or more point away from themselves, however the links lie. The pointers are
    followed by doubling.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rank = F.struct(F.xxhash64("b", F.lit(level)).alias("h"), F.col("b").alias("to"))
    own = F.struct(F.xxhash64("a", F.lit(level)).alias("h"), F.col("a").alias("to"))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least(rank, own)).alias("least"))
    pointers = materialize(least.select("node", F.col("least.to").alias("root")), "pointers")
    while True:
        ahead = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
        pointers = materialize(pointers.join(ahead, "root").select("node", F.col("next").alias("root"), F.expr("next <> root").alias("moved")), "pointers")
        if pointers.where("moved").isEmpty():
            break
        pointers = pointers.drop("moved")
    roots = pointers.drop("moved")
    ends = [roots.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab"]
    joined = links.join(ends[0], "a").join(ends[1], "b").where("ra <> rb")
    joined = joined.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
    return roots, materialize(joined, "links")


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """Rows (node, component): the smallest node that each node of links (a, b) reaches.

    At most ``task_links`` links are merged in one task. More are first contracted, level by level,
    whose number grows with the logarithm of the nodes, also for long paths. Every level is
    written, so a lost executor costs a part of one.
    """
    levels: list[DataFrame] = []
    while links.count() > task_links:
        roots, links = _contracted(links, len(levels))
        levels.append(roots)
    dealt = links.select("a", "b").coalesce(1)
    forest = materialize(dealt.mapInArrow(_forest, "node long, root long"), "forest")
    found = forest.select("node", F.col("root").alias("component"))
    if not levels:
        return found
    for level in reversed(levels):
        top = found.select(F.col("node").alias("root"), "component")
        found = level.join(top, "root", "left").select("node", F.coalesce("component", "root").alias("component"))
    # Roots of a level need not be the smallest of what they stand for.
    found = materialize(found, "contracted")
    least = found.groupBy("component").agg(F.min("node").alias("least"))
    return found.join(least, "component").select("node", F.col("least").alias("component"))
