"""Station tables bucketed by station and sorted by date, for joins and windows without a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.session import fresh_path

BUCKETS = 32


def write_bucketed(
    df: DataFrame, name: str, station: str = "station", order_by: Sequence[str] = ("date",), buckets: int = BUCKETS
) -> DataFrame:
    """Saves ``df`` as table ``name``, in the shared folder, and reads it back.

    One file per bucket, so a scan knows its order; all tables of a flow need one number of
    buckets. A hot station makes its bucket large: give it more columns to be bucketed by, or use
    the sliced windows of ``operators.ordered``.
    """
    dealt = df.repartition(buckets, F.col(f"`{station}`"))
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, station)
    path = fresh_path(df.sparkSession, name)
    writer.sortBy(station, *order_by).option("path", path).saveAsTable(name)
    return read_bucketed(df.sparkSession, name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def left_join_chain(tables: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left joins of bucketed tables; merge joins, since both sides lie as the join needs them.

    Columns that an earlier table has are not taken again. The keys may be more than the tables
    are bucketed by; the session is told that this is enough.
    """
    spark = tables[0].sparkSession
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    out = tables[0]
    for table in tables[1:]:
        new = [c for c in table.columns if c in keys or c not in out.columns]
        out = out.join(table.select(*new).hint("merge"), list(keys), "left")
    return out
