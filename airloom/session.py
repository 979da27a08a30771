"""Session-wide helpers: shared scratch space, durable intermediates, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table of at most so many bytes may be broadcast.
BROADCAST_BYTES = 32_000_000


def local_session(app: str = "airloom", cores: str = "*", partitions: int = 8) -> SparkSession:
    """Session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local master without that setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="airloom-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage at a table that outlives any executor, so later branches neither
    recompute it nor see a differently partitioned copy.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes a row takes in memory: eight a column, and what texts and nested values
    hold."""
    total = F.lit(8 * len(df.columns) + 16)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return total


def broadcast_checked(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint if the frame is shown to hold at most ``max_bytes``.

    It is read for that, so it should be a table. Larger frames come back unhinted: Spark then
    shuffles the join and splits skewed keys.
    """
    least = 8 * len(df.columns) + 16
    sizes = df.limit(max_bytes // least + 1).select(_row_bytes(df).alias("b"))
    if (sizes.agg(F.sum("b")).first()[0] or 0) <= max_bytes:
        return F.broadcast(df)
    return df


def lookup_table(df: DataFrame, name: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A derived join side, computed once, then broadcast if its size allows."""
    return broadcast_checked(materialize(df, name), max_bytes)
