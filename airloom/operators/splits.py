"""Train and test splits and folds of exact size, chosen by a hash of the row key.

The hash orders the rows. Counts per hash range, a fixed number per stratum, locate each cut;
only rows of the range that contains it are ranked. Rows are then labelled by comparing their
hash with the cuts, so the table itself is neither sorted nor shuffled. It is written once with its
hash, which may be a digest that costs more than the reading.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions.dates import season
from airloom.session import lookup_table, materialize

# Held-out share, seed and fold counts.
TEST_SHARE = 0.2
SEED = 42
FOLDS = 10
BASE_FOLDS = 5

HASH_RANGES = 65_536
_HASH_BITS = 52


def row_hash(keys: Sequence[str], seed: int = SEED) -> Column:
    """Whole number below 2**52 from the row key and seed."""
    mixed = F.xxhash64(*[F.col(k) for k in keys], F.lit(seed))
    return F.shiftrightunsigned(mixed, 64 - _HASH_BITS)


def text_hash(keys: Sequence[str], seed: int = SEED) -> Column:
    """The same from a digest of the key's text, which other engines can reproduce. Slower."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, _HASH_BITS // 4), 16, 10).cast("long")


def _range_of(h: Column) -> Column:
    return F.floor(h / (2**_HASH_BITS // HASH_RANGES)).cast("int")


def _hashed(df: DataFrame, order: Column) -> DataFrame:
    """The rows with their ``__hash``, written so that no pass makes it again."""
    return materialize(df.withColumn("__hash", order), "hashed")


def _cuts(
    df: DataFrame,
    keys: Sequence[str],
    strata: Sequence[str],
    wanted: DataFrame | None,
    ranks: Sequence[int] = (),
) -> DataFrame:
    """``__hash`` and key of the row at each wanted rank, per stratum.

    Ranks come as a list, or per stratum from ``wanted`` with a ``rank`` column.
    """
    hashed = df.select(*strata, *keys, "__hash")
    hashed = hashed.withColumn("__range", _range_of(F.col("__hash")))
    counts = hashed.groupBy(*strata, "__range").count()
    upto = Window.partitionBy(*strata).orderBy("__range")
    counts = counts.withColumn("__upto", F.sum("count").over(upto))
    counts = counts.withColumn("__before", F.col("__upto") - F.col("count"))
    if wanted is None:
        aimed = counts.withColumn("rank", F.explode(F.array(*[F.lit(r) for r in ranks])))
    else:
        aimed = counts.join(wanted, list(strata))
    aimed = aimed.where((F.col("__before") < F.col("rank")) & (F.col("rank") <= F.col("__upto")))
    # One row per stratum and cut.
    aimed = lookup_table(aimed.select(*strata, "__range", "__before", "rank"), "aimed")
    inside = hashed.join(aimed, [*strata, "__range"], "left_semi")
    order = Window.partitionBy(*strata, "__range").orderBy("__hash", *keys)
    placed = inside.withColumn("__place", F.row_number().over(order))
    cut = placed.join(aimed, [*strata, "__range"]).where(
        F.col("__place") + F.col("__before") == F.col("rank")
    )
    return cut.select(*strata, "rank", F.struct("__hash", *keys).alias("cut"))


def stratified_split(
    df: DataFrame,
    keys: Sequence[str],
    strata: Sequence[str],
    share: float = TEST_SHARE,
    out: str = "is_test",
    order: Column | None = None,
) -> DataFrame:
    """Mark ``share`` of each stratum, rounded half-even to whole rows, as test rows.

    ``keys`` must identify a row. ``order`` may replace the row hash.
    """
    df = _hashed(df, row_hash(keys) if order is None else order)
    sizes = df.groupBy(*strata).agg(
        F.bround(F.count(F.lit(1)) * F.lit(share)).cast("long").alias("rank")
    )
    cut = _cuts(df, keys, strata, sizes).drop("rank")
    labelled = df.join(lookup_table(cut, "cuts"), list(strata), "left")
    inside = F.struct("__hash", *keys) <= F.col("cut")
    return labelled.withColumn(out, F.coalesce(inside, F.lit(False))).drop("__hash", "cut")


def _label(df: DataFrame, keys: Sequence[str], ranks: Sequence[int]) -> Column:
    """How many of the cuts at ``ranks`` lie before a row."""
    found = _cuts(df, keys, [], None, ranks).orderBy("rank").collect()
    kinds = {f.name: f.dataType for f in df.schema.fields}
    here = F.struct("__hash", *keys)
    label = F.lit(0)
    for row in found:
        mark = F.struct(
            F.lit(row["cut"]["__hash"]).cast("long").alias("__hash"),
            *[F.lit(row["cut"][k]).cast(kinds[k]).alias(k) for k in keys],
        )
        label = label + (here > mark).cast("int")
    return label


def random_split(
    df: DataFrame,
    keys: Sequence[str],
    share: float = TEST_SHARE,
    out: str = "is_test",
    order: Column | None = None,
) -> DataFrame:
    """Mark ``share`` of all rows, rounded up to whole rows, as test rows."""
    df = _hashed(df, row_hash(keys) if order is None else order)
    wanted = math.ceil(df.count() * share)
    label = _label(df, keys, [wanted]) == 0 if wanted else F.lit(False)
    return df.withColumn(out, label).drop("__hash")


def k_folds(
    df: DataFrame,
    keys: Sequence[str],
    folds: int = FOLDS,
    out: str = "fold",
    order: Column | None = None,
) -> DataFrame:
    """Shuffled folds whose sizes differ by at most one row, longer ones first."""
    df = _hashed(df, row_hash(keys) if order is None else order)
    rows = df.count()
    size, longer = divmod(rows, folds)
    ranks, upto = [], 0
    for fold in range(folds - 1):
        upto += size + (1 if fold < longer else 0)
        ranks.append(upto)
    label = _label(df, keys, [r for r in ranks if 0 < r <= rows])
    return df.withColumn(out, label).drop("__hash")


def season_split(
    df: DataFrame,
    keys: Sequence[str],
    date: str = "date",
    share: float = TEST_SHARE,
    order: Column | None = None,
) -> DataFrame:
    """``Season`` and ``is_test`` with the same share held out in every season."""
    seasonal = df.withColumn("Season", season(F.col(date)))
    return stratified_split(seasonal, keys, ["Season"], share, order=order)


def rows_not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def hold_out(df: DataFrame, fold: str, value) -> tuple[DataFrame, DataFrame]:
    """Training rows outside the fold and test rows inside it."""
    test = F.col(fold).eqNullSafe(F.lit(value))
    return df.where(~test), df.where(test)


def fold_sizes(df: DataFrame, fold: str) -> DataFrame:
    """Rows inside (``is_test``) and outside each fold, from one count per fold."""
    counts = materialize(df.groupBy(fold).agg(F.count(F.lit(1)).alias("n")), "fold-sizes")
    total = counts.agg(F.sum("n")).first()[0] or 0
    parts = F.array(
        F.struct(F.lit(True).alias("is_test"), F.col("n").alias("rows")),
        F.struct(F.lit(False).alias("is_test"), (F.lit(total) - F.col("n")).alias("rows")),
    )
    return counts.select(fold, F.inline(parts)).where("rows > 0")
