"""Shared storage between stages, and order over whole tables without gathering them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: A key is hot when it holds over one in HOT_SHARE rows; so at most HOT_SHARE keys are.
HOT_SHARE = 1000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names none, a temporary folder serves on one machine; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strandweave-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``groups`` (one row a key, ``size`` rows each): groups of hot keys are
    broadcast, at most HOT_SHARE of them, so their rows stay where they are; others are merged."""
    hot = groups.where(F.col(size) * HOT_SHARE > F.lit(total))
    cold = groups.where(F.col(size) * HOT_SHARE <= F.lit(total))
    near = rows.join(F.broadcast(hot), key)
    return near.unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``rows`` rows, else as it is, to be merged."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores where its files give fewer splits than there are, as one file of one
    row group does; larger inputs stay as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def materialize(df: DataFrame, name: str = "stage", path: str | None = None) -> DataFrame:
    """Write and read back: cuts lineage in storage that outlives executors."""
    path = path or shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def number_rows(df: DataFrame, out: str, *keys: Column | str) -> DataFrame:
    """``df`` with 1, 2, ... in the order of ``keys``, sorted by ranges in parallel.

    Only the number of rows of each range reaches the driver.
    """
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    ordered = materialize(ordered, "numbered")
    part = F.shiftright("_at", 33).cast("int")
    sizes = {r[0]: r[1] for r in ordered.groupBy(part).count().collect()}
    before, starts = 0, {}
    for p in sorted(sizes):
        starts[p], before = before, before + sizes[p]
    base = F.create_map(*(F.lit(x) for p in starts.items() for x in p)) if starts else F.create_map(F.lit(0), F.lit(0))
    return ordered.withColumn(out, (base[part] + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).cast("long")).drop("_at")


def running_sum(df: DataFrame, place: str, value: Column, out: str, partition: list[str] | None = None, block: int = 65_536) -> DataFrame:
    """Running sum of ``value`` by integer ``place``: within blocks of places, plus the blocks before."""
    from pyspark.sql import Window

    keys = partition or []
    rows = df.withColumn("_block", F.floor(F.col(place) / block)).withColumn("_value", value)
    totals = rows.groupBy(*keys, "_block").agg(F.sum("_value").alias("_sum"))
    ahead = totals.withColumn("_ahead", F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    inside = F.sum("_value").over(Window.partitionBy(*keys, "_block").orderBy(place))
    return rows.withColumn("_inside", inside).join(ahead, [*keys, "_block"]).withColumn(out, F.col("_ahead") + F.col("_inside")).drop("_block", "_value", "_inside", "_ahead")
