"""Arriving sequences: off-target hits and column votes without reading old data again.

Hits of a sequence depend on it alone, so they are a stateless map of the stream. Column votes are
sums, so each batch's votes are appended and summed when read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.operators import conserve
from strandweave.operators.match import Oligo, scan_compatible
from strandweave.plans.config import SpecificityConfig


def stream_hits(sequences: DataFrame, oligos: list[Oligo], config: SpecificityConfig, keys: list[str]) -> DataFrame:
    """Compatible hits of a streaming (keys..., sequence)."""
    return scan_compatible(sequences, oligos, config, keys)


def accumulate_votes(aligned: DataFrame, path: str, checkpoint: str):
    """Start a query that appends each batch's column votes below ``path``; a replayed batch overwrites
    its own part."""

    def add(batch: DataFrame, number: int) -> None:
        conserve.aligned_votes(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return aligned.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)


def votes(spark, path: str) -> DataFrame:
    """Column votes of all batches so far."""
    rows = spark.read.parquet(path)
    sums = [F.sum(c).alias(c) for c in ("depth", "n", *(f"votes_{b}" for b in conserve.BASES))]
    return rows.groupBy("alignment_position").agg(*sums, F.bit_or("support").alias("support"))
