"""Ledgered ingestion, skip channel, bucketed tables and two-row matrices."""

import time
import uuid

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from airloom.session import fresh_path, materialize
from airloom.sources.bucketed import left_join_chain, write_bucketed
from airloom.sources.matrices import read_two_row_matrices, write_two_row_matrices
from airloom.sources.skips import Skips
from airloom.streaming.ledger import Ledger, ingest

FACTS = "id long, value double, station int"


def _facts(df):
    return df.select("id", "value", "station")


@pytest.fixture
def files(spark):
    folder = fresh_path(spark, "files")
    frame = spark.range(120).select("id", (F.col("id") % 7 * 1.5).alias("value"), (F.col("id") % 4).cast("int").alias("station"))
    for i in range(6):
        frame.where(F.col("id") % 6 == i).coalesce(1).write.mode("append").parquet(folder)
    return folder, frame


def test_a_killed_batch_is_taken_again(spark, files, monkeypatch):
    folder, frame = files
    ledger, log = Ledger(spark, fresh_path(spark, "root")), fresh_path(spark, "log")
    commit, calls = ledger.commit, []

    def failing(taken, batch):
        calls.append(batch)
        if len(calls) == 2:
            raise RuntimeError("lost half-way")
        commit(taken, batch)

    monkeypatch.setattr(ledger, "commit", failing)
    with pytest.raises(Exception, match="lost half-way"):
        ingest(spark, folder, frame.schema, _facts, ledger, log, files_per_batch=2)
    half = ledger.read(FACTS).count()
    assert half == 40
    ingest(spark, folder, frame.schema, _facts, ledger, log, files_per_batch=2)
    assert rows(ledger.read(FACTS), "id") == rows(frame.select("id", "value", "station"), "id")
    # The killed batch left its facts; nobody reads them.
    assert spark.read.parquet(ledger.facts).count() == 160
    # A second stream without the first one's log takes nothing twice.
    ingest(spark, folder, frame.schema, _facts, ledger, fresh_path(spark, "log"))
    assert ledger.read(FACTS).count() == 120


def test_compaction_keeps_facts_and_station_folders(spark, files):
    folder, frame = files
    ledger = Ledger(spark, fresh_path(spark, "root"))
    assert ledger.read(FACTS).count() == 0
    ingest(spark, folder, frame.schema, _facts, ledger, fresh_path(spark, "log"), files_per_batch=1)
    before = len(ledger.read(FACTS).inputFiles())
    ledger.compact(FACTS, "station")
    assert len(ledger.batches()) == 1 and ledger.entries().count() == 6
    found = ledger.read(FACTS)
    assert rows(found, "id") == rows(frame.select("id", "value", "station"), "id")
    assert len(found.inputFiles()) < before
    one = found.where("station = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(station" in one
    ledger.compact(FACTS, "station")
    assert len(ledger.batches()) == 1


def test_skips_are_collected_in_the_same_pass(spark):
    skips = Skips()
    frame = spark.range(100).select("id", F.concat(F.lit("f"), F.col("id") % 3).alias("file"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("lat"))
    kept = skips.drop(frame, {"bad file": (F.col("file") == "f1", F.col("file")), "no place": (F.col("lat").isNull(), F.lit("lat"))})
    group = f"skips-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "")
    assert materialize(kept, "kept").where("file = 'f1' or lat is null").isEmpty()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    assert skips._seen[0][1].get["n0"] == 33
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == jobs
    assert rows(skips.counts(spark), "reason") == [("bad file", 33), ("no place", 7)]
    assert rows(skips.items(spark), "item") == [("bad file", "f1"), ("no place", "lat")]
    assert kept.columns == frame.columns


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_bucketed_tables_join_and_lag_without_exchange(spark):
    def saved(value, n):
        frame = spark.range(n).select((F.col("id") % 13).alias("station"), F.expr("date_add(date'2020-01-01', cast(id div 13 as int))").alias("date"), (F.col("id") * n).alias(value))
        return frame, write_bucketed(frame, f"t_{uuid.uuid4().hex}", buckets=4)

    plain, tables = zip(*(saved(v, n) for v, n in (("a", 300), ("b", 200), ("c", 100))), strict=True)
    keys = ["station", "date"]
    joined = left_join_chain(tables, keys)
    lag = F.lag("a").over(Window.partitionBy("station").orderBy("date"))
    filled = F.sum(F.col("b").isNull().cast("int")).over(Window.partitionBy("station").orderBy("date"))
    out = joined.withColumn("previous", lag).withColumn("missing", filled)
    assert _exchanges(out) == 0
    wanted = plain[0].join(plain[1], keys, "left").join(plain[2], keys, "left").withColumn("previous", lag).withColumn("missing", filled)
    assert _exchanges(wanted) > 0
    assert rows(out, *keys) == rows(wanted, *keys)
    again = left_join_chain([tables[0], tables[1].withColumn("a", F.lit(0))], keys)
    assert again.columns == [*keys, "a", "b"]


def test_two_row_headers(spark, tmp_path):
    (tmp_path / "one.csv").write_text('﻿Tarih,Ankara,,"İzmir, Merkez",\n,PM10,PM2.5,PM10,SO2\n2020-01-01,1,2,,4\n2020-01-02,"1,5",,3,\n')
    (tmp_path / "two.csv").write_text("date,Bursa\r\n,NO2\r\n2020-01-01,7\r\n\r\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "heads.csv").write_text(",A,\n,x,y\n")
    found = read_two_row_matrices(spark, str(tmp_path)).where("value is not null")
    wanted = [
        ("Ankara", "PM10", "2020-01-01", "1"), ("Ankara", "PM10", "2020-01-02", "1,5"), ("Ankara", "PM2.5", "2020-01-01", "2"),
        ("Bursa", "NO2", "2020-01-01", "7"), ("İzmir, Merkez", "PM10", "2020-01-02", "3"), ("İzmir, Merkez", "SO2", "2020-01-01", "4"),
    ]
    assert sorted(tuple(r) for r in found.select("station", "variable", "date", "value").collect()) == sorted(wanted)


def test_matrix_of_many_columns(spark, tmp_path):
    """The work grows with the cells: by the square of the columns this takes many minutes."""
    begun, stations = time.monotonic(), 30_000
    day = F.when(F.col("id") % 2 == 0, F.lit("2024-01-01")).otherwise(F.lit("2024-01-02"))
    rows = spark.range(stations).select(
        F.lit(1).alias("file"), F.col("id").alias("station"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("variable"),
        day.alias("date"), F.when(F.col("id") % 5 != 0, F.col("id") / 4).alias("value"),
    )
    write_two_row_matrices(rows, str(tmp_path / "wide"), "file")
    found = read_two_row_matrices(spark, str(tmp_path / "wide"))
    # Blank cells of the other day come back as nulls.
    assert found.count() == 4 * stations
    wanted = rows.where("value is not null").select(F.col("station").cast("string"), "variable", "date", F.col("value").cast("string"))
    found = found.where("value is not null").select("station", "variable", "date", "value")
    assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()
    assert time.monotonic() - begun < 120


def test_matrix_takes_one_value_a_cell(spark, tmp_path):
    rows = spark.createDataFrame([(1, "s", "a", "d", 1.0), (1, "s", "a", "d", 2.0)], "file int, station string, variable string, date string, value double")
    with pytest.raises(Exception, match="two values"):
        write_two_row_matrices(rows, str(tmp_path / "twice"), "file")
