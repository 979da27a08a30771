"""Nearest cells against brute force, on grids, clusters, copies and far stations."""

import numpy as np
import pytest
from conftest import rows

from airloom.operators.spatial import interpolate, nearest_cells


def _brute(cells, stations, k=4):
    out = set()
    for name, lat, lon in stations:
        near = sorted(((lat - c[1]) ** 2 + (lon - c[2]) ** 2, c[0]) for c in cells)
        out |= {(name, cell, i + 1) for i, (_, cell) in enumerate(near[:k])}
    return out


def _frames(spark, cells, stations):
    return (
        spark.createDataFrame(cells, "cell_id long, lat double, lon double"),
        spark.createDataFrame(stations, "station string, latitude double, longitude double"),
    )


def _case(kind):
    rng = np.random.default_rng(5)
    if kind == "grid":
        points = [(36 + i * 0.25, 26 + j * 0.4) for i in range(20) for j in range(15)]
    elif kind == "clusters":
        spots = rng.uniform(0, 40, (6, 2))
        points = [tuple(spots[i % 6] + rng.normal(0, 0.001, 2)) for i in range(300)]
    elif kind == "copies":
        points = [(1.0, 1.0)] * 200 + [(float(i), 2.0) for i in range(40)]
    elif kind == "line":
        points = [(5.0, float(i)) for i in range(100)]
    else:
        points = [(0.0, 0.0), (1.0, 1.0)]
    cells = [(i, float(a), float(b)) for i, (a, b) in enumerate(points)]
    places = rng.uniform(-5, 45, (25, 2)).tolist() + [[1.0, 1.0], [500.0, -500.0]]
    stations = [(f"s{i}", float(a), float(b)) for i, (a, b) in enumerate(places)]
    return cells, stations


@pytest.mark.parametrize(
    "kind,tile_cells", [("grid", 64), ("grid", 4), ("clusters", 16), ("copies", 4), ("line", 4), ("two", 64)]
)
def test_against_brute_force(spark, kind, tile_cells):
    cells, stations = _case(kind)
    near = nearest_cells(*_frames(spark, cells, stations), tile_cells=tile_cells)
    got = {(r["station"], r["cell_id"], r["rank"]) for r in near.collect()}
    assert got == _brute(cells, stations)


def test_per_granule(spark):
    rng = np.random.default_rng(8)
    stations = [(f"s{i}", float(a), float(b)) for i, (a, b) in enumerate(rng.uniform(0, 9, (12, 2)))]
    granules = {
        "g1": [(i, *map(float, p)) for i, p in enumerate(rng.uniform(0, 9, (150, 2)))],
        "g2": [(i, *map(float, p)) for i, p in enumerate(rng.uniform(30, 60, (80, 2)))],
        "g3": [(0, 1.0, 1.0), (1, 2.0, 2.0)],
    }
    cells = spark.createDataFrame(
        [(g, *c) for g, cs in granules.items() for c in cs],
        "granule string, cell_id long, lat double, lon double",
    )
    _, places = _frames(spark, granules["g3"], stations)
    near = nearest_cells(cells, places, by=["granule"], tile_cells=8).collect()
    for name, members in granules.items():
        got = {(r["station"], r["cell_id"], r["rank"]) for r in near if r["granule"] == name}
        assert got == _brute(members, stations)


def test_equidistant_cells_go_by_id(spark):
    cells = [(i, 1.0 if i % 2 else -1.0, 0.0) for i in range(10)]
    near = nearest_cells(*_frames(spark, cells, [("s", 0.0, 0.0)]))
    assert [r[1] for r in rows(near.select("rank", "cell_id"), "rank")] == [0, 1, 2, 3]


def test_interpolation_edges(spark):
    cells = [(1, 0.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 0.0), (4, 1.0, 1.0)]
    stations = [("middle", 0.5, 0.5), ("on", 0.0, 0.0), ("near", 0.2, 0.1)]
    near = nearest_cells(*_frames(spark, cells, stations))
    full = [(i, 1, float(i * 10)) for i in range(1, 5)]
    gap = [(1, 2, 10.0), (2, 2, None), (3, 2, 30.0), (4, 2, float("nan"))]
    absent = [(1, 3, 10.0), (2, 3, 20.0), (3, 3, 30.0)]
    values = spark.createDataFrame(full + gap + absent, "cell_id long, time int, value double")
    got = {(r["station"], r["time"]): r["value"] for r in interpolate(values, near, ["time"]).collect()}
    assert np.isclose(got["middle", 1], 25.0)
    w = [1 / np.hypot(0.2 - a, 0.1 - b) for _, a, b in cells]
    assert np.isclose(got["near", 1], np.average([10, 20, 30, 40], weights=w))
    assert got["on", 1] is None
    assert got["middle", 2] is None and got["middle", 3] is None
    taken = interpolate(values, near, ["time"], exact="take").collect()
    assert {r["value"] for r in taken if r["station"] == "on" and r["time"] == 1} == {10.0}


def test_fewer_cells_than_neighbours(spark):
    cells, stations = [(1, 0.0, 0.0), (2, 1.0, 0.0)], [("s", 0.3, 0.3)]
    near = nearest_cells(*_frames(spark, cells, stations))
    assert near.count() == 2
    values = spark.createDataFrame([(1, 1, 5.0), (2, 1, 6.0)], "cell_id long, time int, value double")
    assert [r["value"] for r in interpolate(values, near, ["time"]).collect()] == [None]


def test_repeated_observation_counts_once(spark):
    cells = [(1, 0.0, 0.0), (2, 0.0, 1.0), (3, 1.0, 0.0), (4, 1.0, 1.0)]
    near = nearest_cells(*_frames(spark, cells, [("s", 0.5, 0.5)]))
    data = [(i, 1, float(i)) for i in range(1, 5)] + [(1, 1, 0.5), (1, 1, 1.0)]
    values = spark.createDataFrame(data, "cell_id long, time int, value double")
    (row,) = interpolate(values, near, ["time"]).collect()
    assert np.isclose(row["value"], 2.5)


def test_no_cross_join(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = [(i, float(i % 40), float(i // 40)) for i in range(1600)]
        stations = [(f"s{i}", i * 0.7, i * 0.3) for i in range(40)]
        near = nearest_cells(*_frames(spark, cells, stations), tile_cells=8)
        near.collect()
        plan = near._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
