"""Shared helpers of the training-data operators: shared storage and skew-safe joins."""

from __future__ import annotations

import pickle
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key counts as hot when it holds more than one in HOT_SHARE rows; so at most HOT_SHARE keys are.
HOT_SHARE = 1000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names none, a temporary folder serves on one machine; on a cluster, whose
    executors would each write to a disk of their own, that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="strandweave-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts lineage and survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_to_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` to ``groups`` (one row per key, ``size`` = that key's rows).

    Keys with over 1/HOT_SHARE of all rows number at most HOT_SHARE, so those few groups are
    broadcast and the rows of a hot key stay where they are; all other keys are sort-merged.
    """
    hot = groups.where(F.col(size) * HOT_SHARE > F.lit(total))
    cold = groups.where(F.col(size) * HOT_SHARE <= F.lit(total))
    near = rows.join(F.broadcast(hot), key)
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold.hint("merge"), key)
    return near.unionByName(far)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_order(id_col: str, text_col: str) -> Column:
    """What a row is told apart by, which no re-read or re-split of the input changes: its id (nulls
    last in the order) and 128 bits of its text's hash."""
    text = F.col(text_col).cast("binary")
    return F.struct(
        F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"),
    )


def pick_rows(docs: DataFrame, chosen: DataFrame, id_col: str, text_col: str, folder: str) -> DataFrame:
    """Rows of ``docs``, columns as they are, whose ``row_order`` is among ``chosen`` (key, copies):
    one for each key, ``copies`` being the number of rows that have it.

    Keys are hashed and texts move once, unsorted. Only rows that repeat both id and text take
    another way: they are reduced to one each before they move.
    """
    chosen = stored(chosen, f"{folder}/chosen")
    name = fresh_name(docs, "_row")
    keyed = docs.withColumn(name, row_order(id_col, text_col))
    once = chosen.where("copies = 1").select(F.col("key").alias(name))
    out = keyed.join(once.hint("shuffle_hash"), name, "left_semi")
    repeated = chosen.where("copies > 1").select(F.col("key").alias(name), "copies")
    if not repeated.isEmpty():
        count = fresh_name(docs, "_copies")
        again = join_to_groups(keyed, repeated.withColumnRenamed("copies", count), name, count, docs.count())
        out = out.unionByName(again.drop(count).dropDuplicates([name]))
    return out.drop(name)


def fitted_in_task(sample: DataFrame, fit):
    """``fit(rows)`` of a bounded sample (a list of tuples in no order), run in one task, where the
    memory it takes is an executor's and a lost one is tried again; None where there are no rows."""

    def run(batches):
        rows = [row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        if rows:
            yield pa.record_batch([pa.array([pickle.dumps(fit(rows))], pa.binary())], names=["model"])

    found = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return pickle.loads(bytes(found[0].model)) if found else None
