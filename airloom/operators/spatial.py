"""Nearest grid cells of each station and inverse-distance interpolation.

Cells are counted in square tiles at several levels, each tile split 4 x 4 at the next. From
the coarsest level down a station keeps only tiles that can hold one of its ``k`` nearest
cells, so a station meets a handful of tiles per level and the cells of the last few, however
far it lies from the grid and however uneven the grid is.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions.weather import squared_distance
from airloom.session import lookup_table, materialize

# Fixed value: neighbours per station.
NEIGHBOURS = 4

# Cells a tile of the last level should hold at most, and the deepest level tried.
TILE_CELLS = 64
MAX_LEVEL = 12
# Stations that meet the tiles of the first level in one part.
PART_STATIONS = 2000
# Pairs of a station and a granule that one task starts with.
PART_PAIRS = 200_000


def _tile(value: Column, origin: float, side: float, level: int) -> Column:
    """Tile number on one axis, cells on the far edge included in the last tile."""
    tiles = 4**level
    place = F.floor((value - F.lit(origin)) / F.lit(side) * F.lit(float(tiles)))
    return F.least(F.greatest(place, F.lit(0)), F.lit(tiles - 1)).cast("long")


def _gap(value: Column, low: Column, high: Column) -> Column:
    """Distance from a coordinate to an interval, 0 inside."""
    return F.greatest(low - value, value - high, F.lit(0.0))


def _reach(value: Column, low: Column, high: Column) -> Column:
    """Distance from a coordinate to the far end of an interval."""
    return F.greatest(high - value, value - low)


def nearest_cells(
    cells: DataFrame,
    stations: DataFrame,
    k: int = NEIGHBOURS,
    by: Sequence[str] = (),
    tile_cells: int = TILE_CELLS,
) -> DataFrame:
    """The ``k`` nearest cells of every station, per granule if ``by`` names its columns.

    ``cells`` has ``cell_id``, ``lat``, ``lon`` and the ``by`` columns, one row per cell;
    ``stations`` has ``station``, ``latitude``, ``longitude``. Distance is planar in degrees;
    equally near cells go by lower ``cell_id``. Returns ``by``, ``station``, ``cell_id``,
    ``d2`` and ``rank``; fewer than ``k`` rows where there are fewer cells.
    """
    by = list(by)
    cells = cells.select(*by, "cell_id", "lat", "lon").where("lat is not null and lon is not null")
    # Of cells at one point only the k lowest ids can be anyone's neighbour.
    at_point = Window.partitionBy(*by, "lat", "lon").orderBy("cell_id")
    cells = cells.withColumn("__n", F.row_number().over(at_point)).where(F.col("__n") <= k)
    cells = materialize(cells.drop("__n"), "cells")
    # One pass for the extent, the number of granules and the cells of the largest.
    own = [F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon"), F.count(F.lit(1))]
    per = cells.groupBy(*by).agg(*[c.alias(n) for c, n in zip(own, ("s", "n", "w", "e", "cells"), strict=True)])
    lat0, lat1, lon0, lon1, largest, granules = per.agg(
        F.min("s"), F.max("n"), F.min("w"), F.max("e"), F.max("cells"), F.count(F.lit(1))
    ).first()
    largest = largest or 0
    lat0, lon0 = lat0 or 0.0, lon0 or 0.0
    side = max((lat1 or 0.0) - lat0, (lon1 or 0.0) - lon0) or 1.0

    def tiled(level: int) -> DataFrame:
        return cells.select(
            "*",
            _tile(F.col("lat"), lat0, side, level).alias("ty"),
            _tile(F.col("lon"), lon0, side, level).alias("tx"),
        )

    level = 1
    while level < MAX_LEVEL and largest > tile_cells / 4 * 16**level:
        level += 1
    # Deeper where cells crowd together; one count per extra level.
    while level < MAX_LEVEL:
        crowd = tiled(level).groupBy(*by, "ty", "tx").count().agg(F.max("count")).first()[0]
        if (crowd or 0) <= tile_cells:
            break
        level += 1

    finest = tiled(level).groupBy(*by, "ty", "tx").agg(
        F.count(F.lit(1)).alias("cells"),
        F.min("lat").alias("s"),
        F.max("lat").alias("n"),
        F.min("lon").alias("w"),
        F.max("lon").alias("e"),
    )
    up = F.explode(F.sequence(F.lit(0), F.lit(level)))
    tiles = finest.select("*", up.alias("up")).select(
        *by,
        (F.lit(level) - F.col("up")).alias("level"),
        *[F.expr(f"{t} div cast(power(4, up) as bigint)").alias(t) for t in ("ty", "tx")],
        "cells", "s", "n", "w", "e",
    )
    tiles = materialize(
        tiles.groupBy(*by, "level", "ty", "tx").agg(
            F.sum("cells").alias("cells"),
            F.min("s").alias("s"),
            F.max("n").alias("n"),
            F.min("w").alias("w"),
            F.max("e").alias("e"),
        ),
        "tiles",
    )

    points = stations.select(
        "station",
        F.col("latitude").cast("double").alias("slat"),
        F.col("longitude").cast("double").alias("slon"),
    )
    # Every station meets the root tile of every granule, as many pairs as there will be groups of
    # neighbours. Granules and stations are dealt into parts both ways, each part of one meeting
    # each part of the other under a key of its own, so the pairs spread over tasks.
    count = points.count()
    rows = max(1, math.ceil(count / PART_STATIONS))
    columns = max(1, min(granules, math.ceil(granules * count / rows / PART_PAIRS)))
    if rows * columns == 1:
        rows = 2

    def part(key: Sequence[str], parts: int) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int") if key else F.lit(0)

    def each(parts: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    roots = tiles.where("level = 0").select(
        *by, F.col("ty").alias("py"), F.col("tx").alias("px"), part(by, columns).alias("column"), each(rows).alias("part")
    )
    dealt = points.select("*", part(["station"], rows).alias("part"), each(columns).alias("column"))
    held = roots.join(dealt, ["part", "column"]).drop("column")
    held = held.withColumn("bound", F.lit(math.inf))

    for z in range(1, level + 1):
        here = tiles.where(F.col("level") == z).select(
            *by, "ty", "tx", "cells", "s", "n", "w", "e",
            F.expr("ty div 4").alias("py"),
            F.expr("tx div 4").alias("px"),
        )
        keys = [*by, "py", "px"]
        if z == 1:
            here, keys = here.select("*", each(rows).alias("part")), [*keys, "part"]
        met = held.join(here, keys).drop(*keys[len(by) :])
        dy, dx = _gap(F.col("slat"), F.col("s"), F.col("n")), _gap(F.col("slon"), F.col("w"), F.col("e"))
        ry, rx = _reach(F.col("slat"), F.col("s"), F.col("n")), _reach(F.col("slon"), F.col("w"), F.col("e"))
        met = met.withColumn("near", dy * dy + dx * dx).withColumn("far", ry * ry + rx * rx)
        # A station meets at most 16 tiles for each it kept, so these windows stay small.
        one = Window.partitionBy(*by, "station")
        filled = F.sum("cells").over(
            one.orderBy("far", "ty", "tx").rowsBetween(Window.unboundedPreceding, 0)
        )
        met = met.withColumn("filled", filled)
        reach = F.min(F.when(F.col("filled") >= k, F.col("far"))).over(one)
        met = met.withColumn("bound", F.least(F.col("bound"), F.coalesce(reach, F.lit(math.inf))))
        held = met.where(F.col("near") <= F.col("bound")).select(
            *by, "station", "slat", "slon", "bound",
            F.col("ty").alias("py"), F.col("tx").alias("px"),
        )

    leaves = tiled(level).withColumnsRenamed({"ty": "py", "tx": "px"})
    d2 = squared_distance(F.col("slat"), F.col("slon"), F.col("lat"), F.col("lon"))
    pairs = held.join(leaves, [*by, "py", "px"]).select(
        *by, "station", "cell_id", d2.alias("d2"), "bound"
    )
    nearest = Window.partitionBy(*by, "station").orderBy("d2", "cell_id")
    return (
        pairs.where(F.col("d2") <= F.col("bound"))
        .withColumn("rank", F.row_number().over(nearest))
        .where(F.col("rank") <= k)
        .select(*by, "station", "cell_id", "d2", "rank")
    )


def interpolate(
    observations: DataFrame,
    neighbours: DataFrame,
    keys: Sequence[str],
    k: int = NEIGHBOURS,
    exact: str = "null",
    written: bool = False,
) -> DataFrame:
    """Inverse-distance weighted mean of each station's ``k`` cells per ``keys``.

    ``observations`` has ``cell_id``, ``value`` and ``keys`` (time, variable, ...); a granule
    column among the neighbours joins too. The mean is null unless all ``k`` cells have a
    value. A station on a cell has no finite weight: null, or that cell's value with
    ``exact="take"``. ``written`` says that the neighbours are a lookup table already.
    """
    shared = [c for c in neighbours.columns if c in observations.columns]
    near = neighbours.select(*shared, "station", "d2", "rank")
    near = near if written else lookup_table(near, "neighbours")
    value = F.nanvl(F.col("value").cast("double"), F.lit(None))
    joined = observations.join(near, shared).select(
        "station", *keys, "d2", "rank", value.alias("v")
    )
    # A cell's value is the largest of its observations, so one reported twice counts once.
    ranks = range(1, k + 1)
    grouped = joined.groupBy("station", *keys).agg(
        *[F.max(F.when(F.col("rank") == i, F.col("v"))).alias(f"v{i}") for i in ranks],
        *[F.max(F.when(F.col("rank") == i, F.col("d2"))).alias(f"d{i}") for i in ranks],
    )
    weights = {i: F.try_divide(F.lit(1.0), F.sqrt(f"d{i}")) for i in ranks}
    total = sum((weights[i] * F.col(f"v{i}") for i in ranks), F.lit(0.0))
    mean = F.try_divide(total, sum(weights.values(), F.lit(0.0)))
    if exact == "take":
        at_cell = F.col("d1") == 0
        on_cell = F.coalesce(*[F.when(F.col(f"d{i}") == 0, F.col(f"v{i}")) for i in ranks])
        mean = F.when(at_cell, on_cell).otherwise(mean)
    return grouped.select("station", *keys, mean.alias("value"))
