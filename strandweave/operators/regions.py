"""Candidate regions from conserved windows, and where primers must not bind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandweave.functions.intervals import expanded, overlap_fraction
from strandweave.operators.ranges import interval_aggregates
from strandweave.plans.config import PrimerDesignConfig
from strandweave.plans.storage import materialize

#: Means are compared after rounding to this many digits, as sums of doubles depend on their order.
DIGITS = 12


def usable(c: PrimerDesignConfig) -> Column:
    return (
        (F.col("major_allele_frequency") >= c.min_minimum_conservation) & (F.col("coverage") >= c.min_mean_coverage)
        & (F.col("gap_frequency") <= c.max_mean_gap_frequency) & (F.col("entropy_bits") <= c.max_mean_entropy_bits)
    )


def bindable(c: PrimerDesignConfig) -> Column:
    """Where a primer or probe may bind; entropy plays no part here."""
    return (
        (F.col("major_allele_frequency") >= c.min_minimum_conservation) & (F.col("coverage") >= c.min_mean_coverage)
        & (F.col("gap_frequency") <= c.max_mean_gap_frequency)
    )


def eligible(c: PrimerDesignConfig) -> Column:
    """Thresholds on a region's or window's means and usable share."""
    r = lambda name: F.round(name, DIGITS)
    return (
        (r("mean_conservation") >= c.min_mean_conservation) & (F.col("minimum_conservation") >= c.min_minimum_conservation)
        & (r("mean_coverage") >= c.min_mean_coverage) & (r("mean_gap_frequency") <= c.max_mean_gap_frequency)
        & (r("mean_entropy_bits") <= c.max_mean_entropy_bits) & (F.col("usable_length") / F.col("position_count") >= c.min_usable_fraction)
    )


def rank_key(prefix: str = "") -> list[Column]:
    """Best first: conservation, least conservation, coverage, entropy, gaps, usable length, place."""
    r = lambda name: F.round(prefix + name, DIGITS)
    return [
        -r("mean_conservation"), -F.col(prefix + "minimum_conservation"), -r("mean_coverage"), r("mean_entropy_bits"), r("mean_gap_frequency"),
        -F.col(prefix + "usable_length"), F.col(prefix + "reference_start"), F.col(prefix + "reference_end"),
    ]


def interval_metrics(intervals: DataFrame, positions: DataFrame, c: PrimerDesignConfig, levels: list[int] | None = None) -> DataFrame:
    """Means over the reference positions of distinct (reference_start, reference_end) intervals.

    Intervals without positions are left out. ``levels``: see ``interval_aggregates``.
    """
    sums = {
        "position_count": F.col("reference_position").isNotNull().cast("int"), "usable_length": F.when(usable(c), 1).otherwise(0),
        "_major": F.col("major_allele_frequency"), "_coverage": F.col("coverage"), "_gap": F.col("gap_frequency"), "_entropy": F.col("entropy_bits"),
    }
    rows = interval_aggregates(intervals, positions, "reference_position", sums, {"minimum_conservation": F.col("major_allele_frequency")}, levels)
    mean = lambda name: F.col(name) / F.col("position_count")
    return rows.where("position_count > 0").select(
        "reference_start", "reference_end", F.col("position_count").cast("int").alias("position_count"), F.col("usable_length").cast("int").alias("usable_length"),
        mean("_major").alias("mean_conservation"), "minimum_conservation", mean("_coverage").alias("mean_coverage"), mean("_gap").alias("mean_gap_frequency"), mean("_entropy").alias("mean_entropy_bits"),
    )


def expanded_windows(windows: DataFrame, reference_length: int, c: PrimerDesignConfig) -> DataFrame:
    """Windows with the design region about each: peak_start and peak_end are the window's own."""
    first, last = expanded(F.col("reference_start"), F.col("reference_end"), F.lit(reference_length), c.candidate_region_length)
    return windows.withColumns({"peak_start": F.col("reference_start"), "peak_end": F.col("reference_end"), "_first": first, "_last": last})


def candidate_regions(windows: DataFrame, positions: DataFrame, reference_length: int, c: PrimerDesignConfig) -> DataFrame:
    """Eligible regions, one per interval, with the best window of each as its peak.

    ``windows`` need usable_length. Eligibility is that of the whole region.
    """
    wide = expanded_windows(windows, reference_length, c)
    best = wide.groupBy("_first", "_last").agg(F.min_by(F.struct("peak_start", "peak_end"), F.struct(*(k.alias(f"k{i}") for i, k in enumerate(rank_key())))).alias("peak"))
    spans = best.select(F.col("_first").alias("reference_start"), F.col("_last").alias("reference_end"), "peak.peak_start", "peak.peak_end")
    length = min(c.candidate_region_length, reference_length)
    metrics = interval_metrics(spans.select("reference_start", "reference_end"), positions, c, [length.bit_length() - 1])
    return metrics.where(eligible(c)).join(spans, ["reference_start", "reference_end"]).withColumn("usable_fraction", F.col("usable_length") / F.col("position_count"))


def suppress(candidates: DataFrame, keys: list[Column], limit: int, max_overlap: float, name: str = "region-%03d") -> DataFrame:
    """Greedy choice: the best candidate that overlaps none chosen by more than ``max_overlap``.

    Each of at most ``limit`` rounds is one argmin over the stored candidates, so nothing is sorted
    and one row a round reaches the driver.
    """
    stored = materialize(candidates.withColumn("_key", F.struct(*(k.alias(f"k{i}") for i, k in enumerate(keys)))), "regions")
    rest, chosen = stored, []
    row = F.struct("reference_start", "reference_end")
    while len(chosen) < limit:
        best = rest.agg(F.min_by(row, "_key").alias("best")).first().best
        if best is None:
            break
        chosen.append((best.reference_start, best.reference_end))
        near = overlap_fraction(F.col("reference_start"), F.col("reference_end"), F.lit(best.reference_start), F.lit(best.reference_end)) > max_overlap
        rest = rest.where(~near & ~((F.col("reference_start") == best.reference_start) & (F.col("reference_end") == best.reference_end)))
    spark = candidates.sparkSession
    ranks = spark.createDataFrame([(i, name % i, a, b) for i, (a, b) in enumerate(chosen, 1)], "rank int, region_id string, reference_start int, reference_end int")
    return stored.drop("_key").join(F.broadcast(ranks), ["reference_start", "reference_end"])


def select_regions(windows: DataFrame, positions: DataFrame, reference_length: int, c: PrimerDesignConfig) -> DataFrame:
    return suppress(candidate_regions(windows, positions, reference_length, c), rank_key(), c.max_candidate_regions, c.max_region_overlap_fraction)


def exclusions(regions: DataFrame, positions: DataFrame, c: PrimerDesignConfig) -> DataFrame:
    """(region_id, start, end) runs of positions of each region where nothing may bind.

    A region with a position that has no metrics fails the query, whether or not it has such runs;
    without any metrics at all nothing is excluded.
    """
    spans = F.broadcast(regions.select("region_id", "reference_start", "reference_end"))  # one row a region, of which a design has few
    inside = F.col("reference_position").between(F.col("reference_start"), F.col("reference_end"))
    rows = positions.where("reference_position is not null").join(spans, inside)
    known = rows.groupBy("region_id").agg(F.countDistinct("reference_position").alias("n"))
    bad = rows.where(~bindable(c)).withColumn("_island", F.col("reference_position") - F.row_number().over(Window.partitionBy("region_id").orderBy("reference_position")))
    runs = bad.groupBy("region_id", "_island").agg(F.min("reference_position").alias("start"), F.max("reference_position").alias("end")).drop("_island")
    some = positions.agg(F.count(F.lit(1)).alias("some"))
    told = spans.join(known, "region_id", "left").crossJoin(F.broadcast(some))  # one row
    short = F.coalesce("n", F.lit(0)) < F.col("reference_end") - F.col("reference_start") + 1
    said = F.concat(F.lit("no metrics for some positions of region "), F.col("region_id"))
    fine = told.select("region_id", F.when((F.col("some") > 0) & short, F.raise_error(said).cast("boolean")).otherwise(True).alias("ok"))
    return fine.where("ok").join(runs, "region_id", "left").where("start is not null").select("region_id", "start", "end")


def excluded_tags(runs: DataFrame) -> DataFrame:
    """(region_id, tag): runs as ``start,length`` pairs with 0-based starts, in order."""
    parts = F.sort_array(F.collect_list(F.struct("start", "end")))
    return runs.groupBy("region_id").agg(parts.alias("r")).select(
        "region_id", F.array_join(F.transform("r", lambda x: F.concat(x["start"] - 1, F.lit(","), x["end"] - x["start"] + 1)), " ").alias("tag")
    )
