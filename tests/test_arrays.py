"""The array source: formats, missing cells, packing, pruning by filters."""

from datetime import datetime

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from airloom.sources import arrays as A

LATS, LONS = np.array([36.0, 37.0, 38.0, 39.0]), np.array([26.0, 27.5, 29.0])


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    at = tmp_path_factory.mktemp("arrays")
    (at / "deep").mkdir()
    for day in (1, 2):
        t2m = np.arange(24 * 12, dtype=float).reshape(24, 4, 3) + day * 1000
        packed = ((np.arange(24 * 12).reshape(24, 4, 3) % 300) - 100).astype(">i2")
        t2m[3, 2, 1] = -9999.0
        packed[5, 0, 0] = -32767
        cells = {
            "t2m": (t2m.astype(">f8"), {"_FillValue": -9999.0, "long_name": "2 metre temperature"}),
            "tcc": (packed, {"missing_value": -32767, "scale_factor": 0.5, "add_offset": 10.0}),
        }
        data = A.encode_file(np.arange(24.0), datetime(2020, 1, day), LATS, LONS, cells)
        (at / "deep" / f"day{day}.nc").write_bytes(data)
    (at / "broken.nc").write_bytes(b"CDF\x01\0\0")
    (at / "other.nc").write_bytes(b"not an array file")
    (at / "notes.txt").write_text("x")
    return str(at)


def test_cells_are_decoded(spark, folder):
    df = A.read_arrays(spark, folder)
    assert df.count() == 2 * 2 * 24 * 12
    one = df.where("variable = 't2m' and time = timestamp_ntz'2020-01-02 03:00:00' and lon = 27.5")
    found = rows(one.select("lat", "cell_id", "value", "long_name"), "lat")
    first = 2000 + 3 * 12 + 1
    name = "2 metre temperature"
    assert found == [(36.0, 1, first, name), (37.0, 4, first + 3, name), (38.0, 7, None, name), (39.0, 10, first + 9, name)]
    packed = df.where("variable = 'tcc' and path like '%day1.nc' and time = timestamp_ntz'2020-01-01 05:00:00'")
    values = [r["value"] for r in packed.orderBy("cell_id").select("value").collect()]
    assert values[0] is None and values[1] == (61 - 100) * 0.5 + 10


@pytest.mark.parametrize("cells", [3, 7, 100])
def test_chunks_of_any_size_give_the_same_rows(spark, folder, cells):
    whole = A.read_arrays(spark, folder)
    small = A.read_arrays(spark, folder, cells)
    assert whole.exceptAll(small).isEmpty() and small.count() == whole.count()


def test_filters_decide_what_is_read(spark, folder):
    def chunks(*conditions):
        df = A.read_arrays(spark, folder, 12)
        for c in conditions:
            df = df.where(c)
        return df.rdd.getNumPartitions(), df.count()

    assert chunks() == (96, 1152)
    assert chunks("variable = 't2m'") == (48, 576)
    assert chunks("variable in ('t2m', 'none')", "time < timestamp_ntz'2020-01-01 02:30:00'") == (3, 36)
    assert chunks("time >= timestamp_ntz'2020-01-02 23:00:00'") == (2, 24)
    bands = A.read_arrays(spark, folder, 3).where("lat > 38.5 and variable = 'tcc'")
    assert (bands.rdd.getNumPartitions(), bands.count()) == (48, 144)
    assert chunks("lat > 80")[1] == 0


def test_what_is_skipped_is_listed(spark, folder):
    found = {(r["path"].rsplit("/", 1)[1], r["reason"]) for r in A.skipped(spark, folder).collect()}
    assert found == {("broken.nc", "header is cut off"), ("other.nc", "not a classic array file")}


def test_round_trip(spark, tmp_path):
    given = spark.range(200).select(
        F.concat(F.lit("f"), F.col("id") % 2).alias("name"),
        F.expr("timestamp_ntz'2021-03-01 00:00:00' + make_interval(0, 0, 0, cast(id % 5 as int), cast(id % 3 as int))").alias("time"),
        F.element_at(F.array(*map(F.lit, LATS.tolist())), (F.col("id") % 4 + 1).cast("int")).alias("lat"),
        F.element_at(F.array(*map(F.lit, LONS.tolist())), (F.col("id") % 3 + 1).cast("int")).alias("lon"),
        F.lit("v").alias("variable"),
        F.col("id").cast("double").alias("value"),
    ).dropDuplicates(["name", "time", "lat", "lon"])
    given.cache()
    A.write_arrays(given, str(tmp_path), "name", LATS.tolist(), LONS.tolist()).collect()
    back = A.read_arrays(spark, str(tmp_path)).where("value is not null")
    columns = ["time", "lat", "lon", "variable", "value"]
    assert rows(back.select(*columns), "value") == rows(given.select(*columns), "value")


def test_no_coordinates_and_times(tmp_path):
    data = A.encode_file(np.arange(2.0), datetime(2020, 1, 1), LATS, LONS, {})
    (tmp_path / "x.nc").write_bytes(data.replace(b"latitude", b"latitudX"))
    assert A.plan_file(f"{tmp_path}/x.nc", A.Wanted(), 10)[1] == [(f"{tmp_path}/x.nc", None, "no coordinates")]
    found = A.decoded_times(np.array([0.0, 1.5]), "days since 1900-01-01 00:00:0.0")
    assert found.astype(str).tolist() == ["1900-01-01T00:00:00.000000", "1900-01-02T12:00:00.000000"]
