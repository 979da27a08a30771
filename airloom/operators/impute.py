"""Missing values from the nearest rows of the same block."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.operators.ordered import with_positions

# Fixed value: donors per missing value.
DONORS = 5
BLOCK_ROWS = 2000
BLOCKS_PER_TASK = 2000


def block_count(rows: int, block_rows: int) -> int:
    return max(1, rows // block_rows)


def contiguous_blocks(
    df: DataFrame,
    order_by: Sequence[str],
    block_rows: int = BLOCK_ROWS,
    out: str = "block",
    rows: int | None = None,
) -> DataFrame:
    """Number the rows by ``order_by`` (``position``, from 0) and cut them into runs.

    There are ``rows // block_rows`` runs, at least one, whose sizes differ by at most one row,
    longer ones first. ``order_by`` should identify a row. No run reaches twice ``block_rows``, whatever the keys look like.
    """
    rows = df.count() if rows is None else rows
    size, longer = divmod(rows, block_count(rows, block_rows))
    placed = with_positions(df, [], order_by, "position")
    placed = placed.withColumn("position", F.col("position") - 1)
    edge = longer * (size + 1)
    block = F.when(
        F.col("position") < edge, F.floor(F.col("position") / (size + 1))
    ).otherwise(longer + F.floor((F.col("position") - edge) / max(size, 1)))
    return placed.withColumn(out, block.cast("long"))


def _fill_block(cells: np.ndarray, donors: int) -> np.ndarray:
    """One block's cells with each missing one replaced by the mean of its nearest donors.

    Distance is Euclidean over the columns both rows have, scaled up to all columns. A cell
    whose row shares no column with any donor gets the column mean; a column without any
    value stays missing. Equally near donors go by row order.
    """
    present = ~np.isnan(cells)
    filled = cells.copy()
    needy = np.flatnonzero(~present.all(axis=1))
    if not len(needy):
        return filled
    width = cells.shape[1]
    total = np.zeros((len(needy), len(cells)))
    shared = np.zeros((len(needy), len(cells)), dtype=np.int32)
    for c in range(width):
        both = present[needy, c][:, None] & present[:, c][None, :]
        step = np.where(both, cells[needy, c][:, None] - cells[:, c][None, :], 0.0)
        total += step * step
        shared += both
    with np.errstate(divide="ignore", invalid="ignore"):
        distance = np.where(shared > 0, total * width / shared, np.inf)
    for c in range(width):
        givers = np.flatnonzero(present[:, c])
        lacking = np.flatnonzero(~present[needy, c])
        if not len(givers) or not len(lacking):
            continue
        near = distance[np.ix_(lacking, givers)]
        order = np.argsort(near, axis=1, kind="stable")[:, :donors]
        usable = np.isfinite(np.take_along_axis(near, order, axis=1))
        values = np.where(usable, cells[givers, c][order], 0.0)
        count = usable.sum(axis=1)
        mean = values.sum(axis=1) / np.maximum(count, 1)
        filled[needy[lacking], c] = np.where(count > 0, mean, cells[givers, c].mean())
    return filled


def knn_impute(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    donors: int = DONORS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Fill missing cells of ``columns`` from the ``donors`` nearest rows in the row's block.

    Blocks are contiguous in ``order_by`` and bounded in size, so each task holds a small
    distance matrix and pairs of rows are never shuffled. Columns outside ``columns``, such
    as calendar indicators, are carried along untouched.
    """
    rows = df.count()
    blocked = contiguous_blocks(df, order_by, block_rows, "__block", rows)
    # Numbered names inside, since grouped pandas functions cannot read names with dots.
    inner = {c: f"c{i}" for i, c in enumerate(df.columns)}
    needed = [inner[c] for c in columns]
    wide = blocked.select(
        "__block",
        "position",
        *[
            F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(name)
            if name in needed
            else F.col(f"`{c}`").alias(name)
            for c, name in inner.items()
        ],
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in wide.schema.fields])

    def fill(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("position", kind="stable")
        block[needed] = _fill_block(block[needed].to_numpy(dtype="float64"), donors)
        return block

    # The work is in the distances, not the bytes, so tasks are counted by blocks; adaptive
    # coalescing goes by bytes and would leave one task.
    blocks = block_count(rows, block_rows)
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(blocks, max(4 * cores, blocks // BLOCKS_PER_TASK))
    filled = wide.repartition(tasks, "__block").groupBy("__block").applyInPandas(fill, schema)
    return filled.select(*[F.col(name).alias(c) for c, name in inner.items()])


def imputable_columns(df: DataFrame, excluded: Sequence[str]) -> list[str]:
    """Numeric columns other than calendar and indicator columns."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in set(excluded)
    ]
