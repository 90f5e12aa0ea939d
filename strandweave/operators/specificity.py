"""Off-target hits, plausible amplicons, and what of them is published."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandweave.operators.match import MAX_OLIGOS, ROLES, Oligo, scan_compatible
from strandweave.operators.seed_index import search_once
from strandweave.plans.config import SpecificityConfig
from strandweave.plans.storage import materialize

KEYS = ["dataset", "dataset_ordinal", "ordinal", "sequence_id"]


def role_ordinal():
    return F.array_position(F.array(*map(F.lit, ROLES)), F.col("role"))


def off_target_hits(sequences: DataFrame, oligos: DataFrame, config: SpecificityConfig) -> DataFrame:
    """All compatible hits in (dataset, dataset_ordinal, ordinal, sequence_id, sequence), uncapped.

    ``oligos``: (assay_id, assay_ordinal, role, sequence). Hits carry what orders them. Up to MAX_OLIGOS
    oligos are sent to the sequences; more are searched for in a seed index.
    """
    spark = sequences.sparkSession
    order = oligos.select("assay_id", "assay_ordinal").distinct()
    rows = oligos.select("assay_id", "assay_ordinal", "role", F.upper("sequence").alias("sequence")).limit(MAX_OLIGOS + 1).collect()
    if len(rows) > MAX_OLIGOS:
        hits = materialize(search_once(sequences, oligos, config, KEYS), "hits")  # read more than once
    else:
        hits = scan_compatible(sequences, [Oligo(r.assay_id, r.role, r.sequence) for r in rows], config, KEYS)
        order = spark.createDataFrame(sorted({(r.assay_id, r.assay_ordinal) for r in rows}), order.schema)  # no more than what the tasks were sent
    return hits.join(order, "assay_id").withColumn("role_ordinal", role_ordinal()).withColumn("compatible", F.lit(True))


def enumeration_order() -> list:
    """Assay, record, role, orientation, place, mismatches."""
    return [F.col(c) for c in ("assay_ordinal", "ordinal", "role_ordinal", "orientation", "source_start", "source_end", "mismatch_count", "mismatch_positions")]


def retained(hits: DataFrame, config: SpecificityConfig) -> DataFrame:
    """First hits in enumeration order of each dataset, assay and role, with their rank."""
    k = config.max_hits_per_oligo_per_dataset
    w = Window.partitionBy("dataset", "assay_id", "role").orderBy(*enumeration_order())
    return hits.withColumn("hit_rank", F.row_number().over(w)).where(F.col("hit_rank") <= k)


def retention(hits: DataFrame, datasets: DataFrame, assays: DataFrame, config: SpecificityConfig) -> DataFrame:
    """Totals of every dataset, assay and role, zero where there is no hit."""
    roles = hits.sparkSession.createDataFrame([(r,) for r in ROLES], "role string")
    keys = datasets.select("dataset").crossJoin(assays.select("assay_id")).crossJoin(F.broadcast(roles))  # every total is a row of the result; three roles
    totals = hits.groupBy("dataset", "assay_id", "role").agg(F.count(F.lit(1)).alias("n"))
    n = F.coalesce("n", F.lit(0).cast("long"))
    kept = F.least(n, F.lit(config.max_hits_per_oligo_per_dataset).cast("long"))
    return keys.join(totals, ["dataset", "assay_id", "role"], "left").select("dataset", "assay_id", "role", n.alias("total_hit_count"), kept.alias("retained_hit_count"), (n > kept).alias("truncated"))


def amplicons(hits: DataFrame, config: SpecificityConfig) -> DataFrame:
    """Every forward and reverse hit in order on one strand of one record, with the probes between.

    An equi-join on record, orientation and a bin of max_amplicon_size: a reverse site lies in its
    forward site's bin or the next, so a record with many hits is joined in pieces.
    """
    keys = ["dataset", "assay_id", "ordinal", "sequence_id", "orientation"]
    size = config.max_amplicon_size
    bin_of = lambda c: F.floor(F.col(c) / size)
    side = lambda role, p: hits.where(F.col("role") == role).select(*keys, *(F.col(c).alias(f"{p}_{c}") for c in ("oriented_start", "oriented_end", "source_start", "source_end")))
    forward = side("FORWARD", "f").withColumn("_bin", F.explode(F.array(bin_of("f_oriented_start"), bin_of("f_oriented_start") + 1)))
    reverse = side("REVERSE", "r").withColumn("_bin", bin_of("r_oriented_start"))
    length = F.col("r_oriented_end") - F.col("f_oriented_start") + 1
    pairs = forward.join(reverse, [*keys, "_bin"]).where((F.col("f_oriented_end") < F.col("r_oriented_start")) & (length <= size)).withColumn("amplicon_size", length).drop("_bin")
    probe = side("PROBE", "p").withColumn("_bin", bin_of("p_oriented_start"))
    spots = pairs.withColumn("_bin", F.explode(F.array(bin_of("f_oriented_start"), bin_of("f_oriented_start") + 1)))
    between = (F.col("f_oriented_end") < F.col("p_oriented_start")) & (F.col("p_oriented_end") < F.col("r_oriented_start"))
    found = spots.join(probe, [*keys, "_bin"]).where(between)
    pair = [*keys, "f_oriented_start", "r_oriented_start"]
    sites = found.groupBy(*pair).agg(F.sort_array(F.collect_list(F.struct("p_source_start", "p_source_end"))).alias("p"))
    probes = F.coalesce(F.transform("p", lambda s: F.struct(s["p_source_start"].alias("start"), s["p_source_end"].alias("end"))), F.array().cast("array<struct<start:bigint,end:bigint>>"))
    out = pairs.join(sites, pair, "left").withColumn("probe_source_sites", probes).drop("p")
    return out.select(
        *keys, F.least("f_source_start", "r_source_start").alias("source_start"), F.greatest("f_source_end", "r_source_end").alias("source_end"), "amplicon_size",
        F.col("f_source_start").alias("forward_source_start"), F.col("f_source_end").alias("forward_source_end"),
        F.col("r_source_start").alias("reverse_source_start"), F.col("r_source_end").alias("reverse_source_end"), "probe_source_sites",
        F.lit(True).alias("primer_amplicon_plausible"), (F.size("probe_source_sites") > 0).alias("detectable_off_target"),
    )


def with_ranks(amplicons_: DataFrame, kept: DataFrame) -> DataFrame:
    """Amplicons with their hits' published ranks: null, or left out of the list, where not published."""
    keys = ["dataset", "assay_id", "ordinal", "sequence_id", "orientation"]
    rank = lambda role, p: kept.where(F.col("role") == role).select(*keys, F.col("source_start").alias(f"{p}_source_start"), F.col("hit_rank").alias(f"{p}_hit_rank"))
    out = amplicons_.join(rank("FORWARD", "forward"), [*keys, "forward_source_start"], "left").join(rank("REVERSE", "reverse"), [*keys, "reverse_source_start"], "left")
    probes = kept.where(F.col("role") == "PROBE").groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col("source_start"), F.col("hit_rank")))).alias("_ranks"))
    ranks = F.filter(F.transform("probe_source_sites", lambda s: F.try_element_at("_ranks", s["start"])), lambda r: r.isNotNull())
    return out.join(probes, keys, "left").withColumn("probe_hit_ranks", F.coalesce(ranks, F.array().cast("array<int>"))).drop("_ranks")


def summary(hits: DataFrame, amplicons_: DataFrame) -> DataFrame:
    """One row of totals."""
    a = amplicons_.agg(
        F.count(F.lit(1)).alias("plausible_amplicon_count"), F.count_if("detectable_off_target").alias("detectable_amplicon_count"),
        F.count_distinct(F.when(F.col("detectable_off_target"), F.struct("dataset", "assay_id"))).alias("detectable_dataset_assay_count"),
    )
    return hits.agg(F.count(F.lit(1)).alias("compatible_hit_count")).crossJoin(a)


def by_dataset(hits: DataFrame, amplicons_: DataFrame, datasets: DataFrame, assays: DataFrame) -> DataFrame:
    """Hits, plausible and detectable amplicons of every assay and dataset, zero where none."""
    keys = ["assay_id", "dataset"]
    base = assays.select("assay_id").crossJoin(datasets.select("dataset"))  # every pair is a row of the result
    h = hits.groupBy(*keys).agg(F.count(F.lit(1)).alias("hit_count"))
    a = amplicons_.groupBy(*keys).agg(F.count(F.lit(1)).alias("plausible_count"), F.count_if("detectable_off_target").alias("detectable_count"))
    return base.join(h, keys, "left").join(a, keys, "left").fillna(0, ["hit_count", "plausible_count", "detectable_count"])
