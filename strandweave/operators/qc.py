"""Quality control of sequences: the first rule that fails, and keep-first de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions import iupac
from strandweave.plans.config import QCConfig
from strandweave.plans.storage import join_groups, materialize

REJECTED, ACCEPTED = "REJECTED", "ACCEPTED"


def rule_code(config: QCConfig):
    """Code of the first failing rule that looks at the sequence alone; null where all pass."""
    seq, n = F.col("sequence"), F.length("sequence")
    rules = F.when(iupac.invalid_position(seq) > 0, "INVALID_NUCLEOTIDE")
    if config.min_length is not None:
        rules = rules.when(n < config.min_length, "TOO_SHORT")
    if config.max_ambiguous_fraction is not None:
        rules = rules.when((n > 0) & (iupac.ambiguous_fraction(seq) > config.max_ambiguous_fraction), "EXCESSIVE_AMBIGUITY")
    if config.expected_length is not None and config.length_tolerance_fraction is not None:
        slack = config.expected_length * config.length_tolerance_fraction
        rules = rules.when(~n.between(config.expected_length - slack, config.expected_length + slack), "INCONSISTENT_LENGTH")
    return rules


def evaluate(sequences: DataFrame, config: QCConfig) -> DataFrame:
    """``sequences`` (ordinal, sequence_id, sequence, ...) with status and reason_codes.

    A sequence that passes the rules and repeats an earlier one that passed is a duplicate. Rules
    depend on the sequence alone, so equal sequences share one answer and the earliest stays. Each
    sequence is read once for its rule and digest, which are stored; only those and ordinals move,
    and a sequence that is often repeated takes its answer to its rows.
    """
    told = materialize(sequences.select("ordinal", rule_code(config).alias("code"), F.unhex(F.sha2("sequence", 256)).alias("digest")), "qc")
    passed = told.where("code is null").select("ordinal", "digest")
    first = passed.groupBy("digest").agg(F.min("ordinal").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = join_groups(passed, first, "digest", "n", told.count()).where("ordinal > first").select("ordinal", F.lit("DUPLICATE_SEQUENCE").alias("_code"))
    rows = sequences.join(told.where("code is not null").select("ordinal", F.col("code").alias("_code")).unionByName(later), "ordinal", "left")
    fine = F.col("_code").isNull()
    return rows.withColumns(
        {
            "status": F.when(fine, ACCEPTED).otherwise(REJECTED),
            "reason_codes": F.when(fine, F.array().cast("array<string>")).otherwise(F.array("_code")),
        }
    ).drop("_code")


def approved(sequences: DataFrame, evaluated: DataFrame) -> DataFrame:
    """Sequences whose id was accepted, in their order; an id accepted once admits all its rows."""
    return sequences.join(evaluated.where(F.col("status") == ACCEPTED).select("sequence_id"), "sequence_id", "left_semi")


def counts(evaluated: DataFrame) -> DataFrame:
    code = F.coalesce(F.try_element_at("reason_codes", F.lit(1)), F.lit(ACCEPTED))
    return evaluated.groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))


def stage_counts(evaluated: DataFrame) -> DataFrame:
    """One row of totals for the run's report."""
    return evaluated.agg(
        F.count(F.lit(1)).alias("input_count"), F.count_if(F.col("status") == ACCEPTED).alias("accepted_count"),
        F.count_if(F.col("status") == REJECTED).alias("rejected_count"),
    )
