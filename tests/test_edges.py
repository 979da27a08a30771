"""Hand-made edge frames."""

import datetime as dt
import math

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from airloom.functions.cells import nan_to_null, round_even, sentinel_to_null
from airloom.functions.dates import granule_date, to_local
from airloom.functions.names import (
    drop_periods,
    file_lookup_key,
    lookup_key,
    parse_decimal,
    pollutant_name,
    sheet_key,
    station_key,
)
from airloom.functions.weather import relative_humidity
from airloom.operators.assemble import (
    add_coordinates,
    left_merge,
    order_columns,
    station_at_rounded,
)
from airloom.operators.calendar import daily_mean, date_order, parse_dates, within_period
from airloom.operators.metrics import group_scores, score_table, season_scores
from airloom.operators.quality import (
    blank_particle_conflicts,
    drop_particle_conflicts,
    measured_at,
)
from airloom.operators.reshape import crosstab, drop_flat_series, unpivot_stations
from airloom.operators.stats import analysed_columns, correlations, summary
from airloom.sources.grids import station_dimension, with_coordinates


def _one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def test_names(spark):
    assert _one(spark, station_key(F.lit("İSTANBUL  Kadıköy"))) == "istanbul_kadikoy"
    assert _one(spark, station_key(F.lit("Łódź Ærø Straße Kőbánya čšž e\u0301"))) == "lodz_aero_strasse_kobanya_csz_e"
    assert _one(spark, sheet_key(F.lit("Ağrı - Doğubeyazıt (Merkez) İstasyonu"))) == (
        "agri_dogubeyazit_merkez_istasyonu"[:31]
    )
    assert _one(spark, lookup_key(F.lit("  şişli   üst "))) == "sisli_ust"
    assert _one(spark, lookup_key(F.lit(None).cast("string"))) == ""
    assert _one(spark, lookup_key(F.lit("nan"))) == ""
    assert _one(spark, file_lookup_key(F.lit("Şişli Üst.xlsx"))) == "sisli_ust"
    assert _one(spark, file_lookup_key(F.lit("a__b.v1.xlsx"))) == "a__b.v1"
    assert _one(spark, pollutant_name(F.lit("PM 2.5 ( µg/m3 )"))) == "PM2.5"


def test_text_numbers(spark):
    assert _one(spark, drop_periods(F.lit("1.234,5"))) == "1234,5"
    assert _one(spark, parse_decimal(F.lit("1.234,5"))) == 1234.5
    assert _one(spark, parse_decimal(F.lit("kapalı"))) is None


def test_granule_dates(spark):
    assert _one(spark, granule_date(F.lit("X.A2019366.h.nc"))) == dt.date(2020, 1, 1)
    assert _one(spark, granule_date(F.lit("/a/MOD.A2020060.nc"))) == dt.date(2020, 2, 29)
    assert _one(spark, granule_date(F.lit("readme.nc"))) is None


def test_zone_and_daily_mean(spark):
    """22:00 UTC counts on the next local day; days between observations are null rows."""
    data = [("a", "2019-01-01 22:00:00", 4.0), ("a", "2019-01-02 03:00:00", 8.0),
            ("a", "2019-01-05 01:00:00", 1.0), ("b", "2015-01-01 21:59:00", None)]
    frame = spark.createDataFrame(data, "station string, t string, v double")
    frame = frame.withColumn("date", to_local(F.col("t").cast("timestamp_ntz")))
    got = rows(daily_mean(frame, ["v"]), "station", "date")
    day = [dt.date(2019, 1, d) for d in range(2, 6)]
    assert got == [
        ("a", day[0], 6.0), ("a", day[1], None), ("a", day[2], None), ("a", day[3], 1.0),
        ("b", dt.date(2015, 1, 1), None),
    ]


def test_daily_mean_ignores_nan(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", float("nan"))], "station string, v double")
    frame = frame.withColumn("date", F.lit("2020-01-01").cast("timestamp_ntz"))
    assert daily_mean(frame, ["v"]).first()["v"] == 1.0


def test_period_bound_is_midnight(spark):
    hours = spark.createDataFrame(
        [("2017-12-31 23:00:00",), ("2018-01-01 00:00:00",), ("2023-12-31 00:00:00",),
         ("2023-12-31 01:00:00",), ("2024-01-01 00:00:00",)], "t string"
    ).select(F.col("t").cast("timestamp_ntz").alias("date"))
    assert within_period(hours).count() == 2
    assert within_period(hours, inclusive_day=True).count() == 3


def test_invalid_date_drops_its_row_only(spark):
    frame = spark.createDataFrame([("2020-01-01",), ("31.31.2020",), ("02/15/2020",)], "date string")
    got = rows(parse_dates(frame), "date")
    assert got == [(dt.datetime(2020, 1, 1),), (dt.datetime(2020, 2, 15),)]


def test_lexical_order(spark):
    frame = spark.createDataFrame([("2021-01-05",), ("2020-12-01",)], "d string").select(
        F.to_date("d").alias("date")
    )
    assert [r[0].year for r in frame.orderBy(date_order(lexical=True)).collect()] == [2021, 2020]
    assert [r[0].year for r in frame.orderBy(date_order()).collect()] == [2020, 2021]


def test_crosstab_duplicates_and_unknown(spark):
    frame = spark.createDataFrame(
        [(1, "a", 1.0), (1, "a", 3.0), (1, "z", 9.0), (2, "b", 2.0)], "t int, variable string, value double"
    )
    assert rows(crosstab(frame, ["t"], ["a", "b", "c"]), "t") == [(1, 3.0, None, None), (2, None, 2.0, None)]


def test_matrix_headers_and_flat_series(spark):
    frame = spark.createDataFrame(
        [("d1", 1.0, 5.0, None, 2.0), ("d2", 2.0, 5.0, None, 2.0)],
        "date string, `A|PM10` double, `NO2 ( ppb )` double, `B|PM10` double, `SO2` double",
    )
    long = unpivot_stations(frame)
    assert {(r["station"], r["pollutant"]) for r in long.collect()} == {
        ("A", "PM10"), ("A", "NO2"), ("B", "PM10"), ("B", "SO2")
    }
    kept = drop_flat_series(long).select("station", "pollutant").distinct()
    assert rows(kept) == [("A", "PM10")]


def test_dimension_repeats_do_not_multiply(spark):
    dimension = spark.createDataFrame(
        [("Şişli", 1.0, 10.0, 2), ("şişli", 3.0, 30.0, 1), ("şişli", 5.0, 50.0, 0)],
        "station string, latitude double, longitude double, seq int",
    )
    last = station_dimension(dimension, "seq")
    assert rows(last) == [("sisli", 1.0, 10.0)]
    table = spark.createDataFrame([("sisli", 7), ("none", 8)], "station string, v int")
    got = add_coordinates(table, dimension, "seq")
    assert rows(got.select("station", "v", "Longitude", "Latitude")) == [("sisli", 7, 50.0, 5.0)]


def test_rounded_lookup(spark):
    dimension = spark.createDataFrame(
        [("x", 10.00004, 20.0, 1), ("y", 10.00001, 20.0, 0)],
        "station string, longitude double, latitude double, seq int",
    )
    table = spark.createDataFrame([(10.0, 20.00004), (11.0, 20.0)], "Longitude double, Latitude double")
    got = station_at_rounded(table, dimension, "seq")
    assert [r["Station_Name"] for r in got.collect()] == ["y"]
    with pytest.raises(Exception, match="no station"):
        station_at_rounded(table, dimension, "seq", unmatched="error").collect()


def test_merge_suffixes_and_repeats(spark):
    left = spark.createDataFrame([(1, "l")], "k int, v string")
    right = spark.createDataFrame([(1, "r"), (1, "s")], "k int, v string")
    got = left_merge(left, right, ["k"])
    assert got.columns == ["k", "v_x", "v_y"]
    assert rows(got, "v_y") == [(1, "l", "r"), (1, "l", "s")]


def test_column_order_and_coordinates(spark):
    frame = spark.createDataFrame([(1, 2, 3, 4)], "other int, PM10 int, Month int, date int")
    assert order_columns(frame).columns == ["date", "Month", "PM10", "other"]
    both = spark.createDataFrame([(1.0, 2.0, 3.0)], "lat double, latitude double, Lon double")
    assert rows(with_coordinates(both)) == [(2.0, 3.0)]
    assert with_coordinates(frame) is None


def test_quality_rules_and_nulls(spark):
    frame = spark.createDataFrame(
        [(10.0, 5.0), (4.0, 5.0), (60.0, 5.0), (None, 5.0), (7.0, None)], "PM10 double, `PM2.5` double"
    )
    assert rows(drop_particle_conflicts(frame, "PM10", "PM2.5")) == [(10.0, 5.0)]
    kept = blank_particle_conflicts(frame, "PM10", "PM2.5").collect()
    assert [tuple(r) for r in kept] == [
        (10.0, 5.0), (None, None), (None, None), (None, 5.0), (7.0, None)
    ]


def test_station_choice(spark):
    frame = spark.createDataFrame(
        [("a", 1.0, None), ("a", None, None), ("b", 1.0, 2.0), ("c", None, None)],
        "station string, PM10 double, `PM2.5` double",
    )
    assert {r["station"] for r in measured_at(frame).collect()} == {"a"}


def test_cells(spark):
    assert _one(spark, sentinel_to_null(F.lit(-0.0000000009313226))) is None
    assert _one(spark, sentinel_to_null(F.lit(0.0))) == 0.0
    assert [_one(spark, round_even(F.lit(v), 0)) for v in (0.5, 1.5, 2.5)] == [0.0, 2.0, 2.0]
    frame = spark.createDataFrame([(float("nan"), "x")], "a double, b string")
    assert rows(nan_to_null(frame)) == [(None, "x")]
    assert math.isclose(_one(spark, relative_humidity(F.lit(20.0), F.lit(20.0))), 100.0)
    kelvin = _one(spark, relative_humidity(F.lit(293.15), F.lit(283.15), kelvin=True))
    assert math.isclose(kelvin, _one(spark, relative_humidity(F.lit(20.0), F.lit(10.0))), rel_tol=1e-9)


def _scores(y, p):
    """Straight from the definitions."""
    y, p = np.array(y), np.array(p)
    rmse = np.sqrt(np.mean((y - p) ** 2))
    mape = np.mean(np.abs(y - p) / np.maximum(np.abs(y), np.finfo(float).eps))
    mase = np.mean(np.abs(y[1:] - p[1:])) / np.mean(np.abs(np.diff(y)))
    r2 = 1 - np.sum((y - p) ** 2) / np.sum((y - y.mean()) ** 2)
    return [rmse, mape, mase, r2]


@pytest.mark.parametrize("max_rows", [4, 10**6])
def test_scores_by_definition(spark, max_rows):
    rng = np.random.default_rng(2)
    data = [("ab"[i % 3 == 0], i, float(rng.uniform(1, 9)), float(rng.uniform(1, 9))) for i in range(30)]
    frame = spark.createDataFrame(data, "station string, t int, actual double, predicted double")
    table = score_table(frame, ["station"], ["t"], "station", max_rows=max_rows)
    got = {}
    for r in table.collect():
        got.setdefault(r["station"], {})[r["Metric"]] = r["Value"]
    data.sort()
    for name in "ab":
        part = [d for d in data if d[0] == name]
        wanted = _scores([d[2] for d in part], [d[3] for d in part])
        assert np.allclose(list(got[name].values()), wanted)
    assert np.allclose(list(got["Overall"].values()), _scores([d[2] for d in data], [d[3] for d in data]))


def test_score_edges(spark):
    """Constant and zero actual values neither fail nor divide by zero."""
    data = [("c", i, 5.0, 4.0, "Winter") for i in range(3)] + [("z", 9, 0.0, 1.0, "Summer")]
    frame = spark.createDataFrame(data, "station string, t int, actual double, predicted double, Season string")
    got = {r["station"]: r for r in group_scores(frame, ["station"], ["t"]).collect()}
    assert got["c"]["MASE"] is None and got["c"]["R2"] == 0.0 and got["c"]["small_group"]
    assert got["z"]["MAPE"] > 1e15 and math.isfinite(got["z"]["MAPE"])
    seasons = {r["Season"]: r for r in season_scores(frame, ["t"]).collect()}
    assert seasons["Winter"]["MASE"] == 1.0 and math.isclose(seasons["Winter"]["MAPE"], 20.0)


def test_statistics(spark):
    rng = np.random.default_rng(4)
    a = [float(v) for v in rng.normal(size=50)]
    data = [(v, None if i % 5 == 0 else v * 2 + float(i), i % 2, 7, 1 if i else None)
            for i, v in enumerate(a)]
    frame = spark.createDataFrame(data, "a double, b double, flag int, same int, partial int")
    # A constant column goes; an incomplete indicator passes only if it varies.
    assert analysed_columns(frame) == ["a", "b"]
    got = {r["Metric"]: r for r in summary(frame, ["a", "b"]).collect()}
    assert got["b"]["missing_percent"] == 20.0 and got["b"]["total"] == 50
    assert got["a"]["p40"] == round(float(np.quantile(a, 0.4)), 2)
    b = np.array([np.nan if d[1] is None else d[1] for d in data])
    both = ~np.isnan(b)
    found = {(r["column_a"], r["column_b"]): r["correlation"] for r in correlations(frame, ["a", "b"]).collect()}
    assert np.isclose(found["a", "b"], np.corrcoef(np.array(a)[both], b[both])[0, 1])
    assert found["a", "b"] == found["b", "a"] and np.isclose(found["a", "a"], 1.0)
