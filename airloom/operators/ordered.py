"""Row-order operators that hold when one group has most of the rows.

A window over a group runs in one task. Where a group is larger than ``max_rows`` its rows
are cut into slices along the sort key, the window runs per slice, and the little each slice
needs from the ones before it is carried over from one summary row per slice.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.functions.cells import present
from airloom.session import broadcast_checked, lookup_table, materialize

# Rows one window task may sort, and the most slices cut in one pass.
MAX_GROUP_ROWS = 5_000_000
MAX_SLICES = 4096

_POSITION = "__position"


_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_TEXT_BYTES = 6


def _sliceable(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType
    return isinstance(kind, (T.NumericType, T.StringType, *_TIMES))


def _as_position(df: DataFrame, column: str) -> Column:
    """Sort column as a double that never runs against its order within a group.

    Of text it is the first bytes after the ``__shared`` letters all values of the group begin
    with.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampNTZType):
        # From its own parts: as an instant it would jump where the session's clock is changed.
        c = F.col(column)
        minutes = (F.unix_date(c.cast("date")) * 24 + F.hour(c)).cast("double") * 60 + F.minute(c)
        return minutes * 60_000_000 + F.extract(F.lit("SECOND"), c).cast("double") * 1_000_000
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("double")
    if isinstance(kind, T.StringType):
        tail = F.substring(F.col(column), F.col("__shared") + 1, F.lit(_TEXT_BYTES))
        start = F.substring(F.encode(tail, "UTF-8"), 1, _TEXT_BYTES)
        return F.conv(F.rpad(F.hex(start), 2 * _TEXT_BYTES, "0"), 16, 10).cast("double")
    return F.col(column).cast("double")


def _shared_letters(low: Column, high: Column) -> Column:
    """How many letters the smallest and the largest text of a group begin with alike."""
    lengths = F.sequence(F.lit(1), F.greatest(F.length(low), F.lit(1)))
    alike = F.filter(lengths, lambda i: F.left(low, i) == F.left(high, i))
    return F.size(alike)


def _cut_points(positions: DataFrame, parts: int) -> list[float]:
    """Quantile cut points; a repeated one also closes right after itself, so that copies
    of one position sit in a slice of their own."""
    probabilities = [i / parts for i in range(1, parts)]
    points = positions.approxQuantile(_POSITION, probabilities, 1.0 / (4 * parts))
    cuts = set(points)
    cuts |= {math.nextafter(p, math.inf) for p in points if points.count(p) > 1}
    return sorted(cuts)


def _too_large(
    df: DataFrame, keys: Sequence[str], column: str, earlier: Sequence[str], max_rows: int
) -> DataFrame:
    """Groups above the bound, and whether ``column`` can cut them: all rows agree in the
    earlier sort columns, and its own values differ or some are missing."""
    found = [F.count(F.lit(1)).alias("__rows")]
    differs = []
    for i, c in enumerate([*earlier, column]):
        found += [
            F.count(c).alias(f"__n{i}"), F.min(c).alias(f"__low{i}"), F.max(c).alias(f"__high{i}")
        ]
        mixed = (F.col(f"__n{i}") > 0) & (F.col(f"__n{i}") < F.col("__rows"))
        differs.append(mixed | F.coalesce(F.col(f"__low{i}") < F.col(f"__high{i}"), F.lit(False)))
    cuttable = differs[-1]
    for differ in differs[:-1]:
        cuttable = cuttable & ~differ
    sizes = df.groupBy(*keys).agg(*found).where(F.col("__rows") > max_rows)
    shared = F.lit(0)
    if isinstance(df.schema[column].dataType, T.StringType):
        last = len(earlier)
        shared = _shared_letters(F.col(f"__low{last}"), F.col(f"__high{last}"))
    return sizes.select(
        *keys, "__rows", cuttable.alias("__cuttable"), shared.alias("__shared")
    )


def slice_hot_groups(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    max_rows: int = MAX_GROUP_ROWS,
) -> tuple[DataFrame, list[str]]:
    """Add slice columns to the rows of groups larger than ``max_rows``.

    Slices follow ``order_by``: sorting by the slice columns and then ``order_by`` is sorting
    by ``order_by``. Groups within the bound carry -1. Returns the frame and the slice
    columns, none if no group is too large. A group gets about as many slices as it has times
    ``max_rows`` rows. Slices still too large are cut again, and those whose rows share one
    value by the next sort column.
    """
    keys: list[str] = []
    at, left = 0, math.inf
    while at < len(order_by):
        column = order_by[at]
        if not _sliceable(df, column):
            break
        cut_keys = [*group, *keys]
        candidates = df.where(F.col(keys[0]) >= 0) if keys else df
        # At most rows / max_rows groups are too large, so this side stays small.
        large = _too_large(candidates, cut_keys, column, order_by[:at], max_rows)
        large = materialize(large, "large-groups")
        hot = large.where("__cuttable").drop("__cuttable")
        hot_rows = hot.agg(F.sum("__rows")).first()[0]
        if not hot_rows:
            if not keys and not large.take(1):
                break
            at, left = at + 1, math.inf
            continue
        if hot_rows >= left:
            raise RuntimeError(f"no cut along {column} makes this group smaller: {hot.first()}")
        left = hot_rows
        parts = min(MAX_SLICES, math.ceil(hot_rows / max_rows) + 1)
        if cut_keys:
            marked = join_summary(df, hot, cut_keys, broadcast_checked)
        else:
            whole = hot.first()
            marked = df.withColumn("__rows", F.lit(hot_rows))
            marked = marked.withColumn("__shared", F.lit(whole["__shared"]))
        position = _as_position(df, column)
        marked = marked.withColumn(_POSITION, F.when(F.col("__rows").isNotNull(), position))
        points = _cut_points(marked.where(f"{_POSITION} is not null"), parts)
        key = f"__slice{len(keys)}"
        cutter = Bucketizer(
            splits=[-math.inf, *points, math.inf],
            inputCol=_POSITION,
            outputCol=key,
            handleInvalid="keep",
        )
        # Cuts are shared by all hot groups; a smaller group joins several into one slice.
        own = F.ceil(F.col("__rows") / max_rows) + 1
        step = F.greatest(F.floor(F.lit(len(points) + 1) / own), F.lit(1))
        # Null positions sort first, as the window does.
        df = cutter.transform(marked).withColumn(
            key,
            F.when(F.col("__rows").isNull(), F.lit(-1))
            .when(F.col(_POSITION).isNull(), F.lit(0))
            .otherwise(F.floor(F.col(key) / step) + 1)
            .cast("int"),
        ).drop("__rows", "__shared", _POSITION)
        keys.append(key)
    return df, keys


def _sorted_by(order_by: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order_by]


def _small_side(summary: DataFrame) -> DataFrame:
    return lookup_table(summary, "slice-summary")


def join_summary(
    df: DataFrame, summary: DataFrame, keys: Sequence[str], hint=_small_side
) -> DataFrame:
    """Attach summary rows, missing keys matching each other.

    Summaries of slices are written, and broadcast if they prove small; others bring their own
    ``hint``.
    """
    named = [F.col(k).alias(f"__s_{k}") for k in keys]
    rest = [c for c in summary.columns if c not in keys]
    side = hint(summary.select(*named, *rest))
    match = [F.col(k).eqNullSafe(F.col(f"__s_{k}")) for k in keys]
    return df.join(side, match, "left").drop(*[f"__s_{k}" for k in keys])


def _positions_overall(df: DataFrame, order_by: Sequence[str], out: str) -> DataFrame:
    """Row number over the whole frame, never in one task.

    Rows are dealt by ranges of the sort columns, copies by their other values, and sorted and
    counted within each range. What is added to a range's own numbers is the count of the ranges
    before it; the driver gets one count per range.
    """
    ties = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    order = [*_sorted_by(order_by), ties]
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # Range in the high bits, place within it in the lower 33.
    placed = materialize(dealt.withColumn("__id", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("__id", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    before, offsets = 0, []
    for size in sorted(sizes):
        offsets.append((size["part"], before))
        before += size["n"]
    side = df.sparkSession.createDataFrame(offsets, "__part long, __off long")
    placed = placed.join(F.broadcast(side), part == F.col("__part"))
    own = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.withColumn(out, F.col("__off") + own + 1).drop("__id", "__part", "__off")


def with_positions(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    out: str,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """1-based row number within each group, over the whole frame if ``group`` is empty."""
    if not group:
        return _positions_overall(df, order_by, out)
    df, keys = slice_hot_groups(df, group, order_by, max_rows)
    window = Window.partitionBy(*group, *keys).orderBy(*_sorted_by(order_by))
    numbered = df.withColumn(out, F.row_number().over(window).cast("long"))
    if not keys:
        return numbered
    before = Window.partitionBy(*group).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        df.where(F.col(keys[0]) >= 0)
        .groupBy(*group, *keys)
        .count()
        .select(*group, *keys, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__off"))
    )
    shifted = join_summary(numbered, offsets, [*group, *keys])
    return shifted.withColumn(out, F.col(out) + F.coalesce("__off", F.lit(0))).drop("__off", *keys)


def with_previous(
    df: DataFrame,
    group: Sequence[str],
    order_by: Sequence[str],
    columns: dict[str, str],
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Value of the row before, within the group: ``columns`` maps new names to columns."""
    df, keys = slice_hot_groups(df, group, order_by, max_rows)
    window = Window.partitionBy(*group, *keys).orderBy(*_sorted_by(order_by))
    lagged = [F.lag(c).over(window).alias(name) for name, c in columns.items()]
    if not keys:
        return df.select("*", *lagged)
    out = df.select("*", *lagged, F.row_number().over(window).alias("__row"))
    last = F.max_by(F.struct(*columns.values()), F.struct(*order_by))
    tails = (
        df.where(F.col(keys[0]) >= 0).groupBy(*group, *keys).agg(last.alias("__tail"))
    )
    along = Window.partitionBy(*group).orderBy(*keys)
    carried = tails.select(*group, *keys, F.lag("__tail").over(along).alias("__before"))
    out = join_summary(out, carried, [*group, *keys])
    for name, column in columns.items():
        first = (F.col("__row") == 1) & F.col("__before").isNotNull()
        out = out.withColumn(
            name, F.when(first, F.col("__before")[column]).otherwise(F.col(name))
        )
    return out.drop("__row", "__before", *keys)


def trim_null_runs(
    df: DataFrame,
    column: str,
    group: Sequence[str],
    order_by: Sequence[str],
    block_size: int = 10,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Drop each row that ends ``block_size`` or more missing values in a row.

    The first ``block_size - 1`` rows of a run stay, so shorter groups are never cut.
    """
    df, keys = slice_hot_groups(df, group, order_by, max_rows)
    window = Window.partitionBy(*group, *keys).orderBy(*_sorted_by(order_by))
    there = present(df, column).isNotNull()
    if not keys:
        missing = F.sum((~there).cast("int"))
        in_frame = missing.over(window.rowsBetween(-(block_size - 1), 0))
        return df.withColumn("__missing", in_frame).where(
            F.col("__missing") < block_size
        ).drop("__missing")

    numbered = df.withColumn("__row", F.row_number().over(window).cast("long"))
    seen = F.when(there, F.col("__row"))
    running = window.rowsBetween(Window.unboundedPreceding, 0)
    # Missing values since the last present one, counted from the start of the slice.
    numbered = numbered.withColumn("__last", F.max(seen).over(running))
    summary = (
        numbered.where(F.col(keys[0]) >= 0)
        .groupBy(*group, *keys)
        .agg(F.max("__row").alias("__n"), F.max("__last").alias("__seen"))
    )
    along = Window.partitionBy(*group).orderBy(*keys)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    summary = summary.select(
        *group,
        *keys,
        "__start",
        F.max(F.col("__start") + F.col("__seen")).over(before).alias("__carried"),
    )
    out = join_summary(numbered, summary, [*group, *keys])
    start = F.coalesce("__start", F.lit(0))
    carried = F.coalesce("__carried", F.lit(0))
    run = F.when(F.col("__last").isNotNull(), F.col("__row") - F.col("__last")).otherwise(
        start + F.col("__row") - carried
    )
    return out.where(run < block_size).drop("__row", "__last", "__start", "__carried", *keys)
