"""Classes, scores and order of assays from their evidence, with reasons that can be audited."""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.operators.match import ROLES
from strandweave.plans.config import RankingConfig
from strandweave.plans.storage import number_rows

CLASSES = ("IN SILICO PASS", "REVIEW", "HIGH_RISK")
SEVERITIES = ("HIGH_RISK", "REVIEW", "ADVISORY")
COMPONENTS = ("inclusivity", "specificity", "conservation", "primer3_quality", "robustness")
# What each reason says.
MESSAGES = {
    "INCLUSIVITY_EVIDENCE_MISSING": "Inclusivity evidence was not evaluated.",
    "INCLUSIVITY_EVIDENCE_EMPTY": "Inclusivity evidence has an empty Evaluation Set.",
    "SPECIFICITY_EVIDENCE_MISSING": "Specificity evidence was not evaluated.",
    "INCLUSIVITY_BELOW_MINIMUM": "Original assay inclusivity is below the configured high-risk floor.",
    "INCLUSIVITY_BELOW_PASS": "Original assay inclusivity is below the configured PASS threshold.",
    "DETECTABLE_OFF_TARGET": "At least one plausible off-target amplicon contains a compatible probe.",
    "PLAUSIBLE_OFF_TARGET_AMPLICON": "At least one plausible forward/reverse off-target amplicon was found without a compatible probe.",
    "ISOLATED_OFF_TARGET_HITS": "Compatible isolated off-target oligo hits were found without a plausible amplicon.",
    "IUPAC_PROPOSAL_ACCEPTED": "An accepted IUPAC degeneracy proposal is available as contextual evidence.",
    "IUPAC_PROPOSAL_REJECTED": "A rejected IUPAC degeneracy proposal is preserved as contextual evidence.",
    "EVIDENCE_INCOMPLETE": "One or more score components cannot be computed from the available evidence.",
    "RUN_EVIDENCE_INCOMPLETE": "Run-level evidence is incomplete.",
}
REASON = "struct<code: string, severity: string, source: string, message: string, evidence: map<string, string>>"


def _reason(code: str, severity: str, source: str, evidence: dict[str, Column] | None = None, message: str | None = None) -> Column:
    entries = [x for k, v in (evidence or {}).items() for x in (F.lit(k), v.cast("string"))]
    told = F.create_map(*entries) if entries else F.create_map().cast("map<string,string>")
    return F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), F.lit(source).alias("source"), F.lit(message or MESSAGES[code]).alias("message"), told.alias("evidence"))


def classify(evidence: DataFrame, c: RankingConfig, run: Column | None = None) -> DataFrame:
    """``evidence`` per assay with reasons, missing_components and classification; ``run`` is a reason
    that all assays share.

    Columns read: assay_id, pair_penalty, inclusivity_status, evaluation_sequence_count,
    original_compatible_count, specificity_status, compatible_hit_count, plausible_count,
    detectable_count, accepted_roles and rejected_roles (arrays, in role order).
    """
    n, ok = F.col("evaluation_sequence_count"), F.col("original_compatible_count")
    skipped, empty = F.col("inclusivity_status") == "SKIPPED", (F.col("inclusivity_status") != "SKIPPED") & (F.coalesce(n, F.lit(0)) == 0)
    measured = (F.col("inclusivity_status") == "COMPLETE") & (n > 0)
    share = F.when(measured, ok / n)
    counted = lambda floor: {"compatible_count": ok, "evaluation_sequence_count": n, "fraction": share, "threshold": F.lit(floor)}
    off = F.col("specificity_status") == "COMPLETE"
    detectable, plausible, hits = F.col("detectable_count"), F.col("plausible_count"), F.col("compatible_hit_count")
    lacking = F.filter(
        F.array(
            F.when(skipped | empty, "inclusivity"), F.when(F.col("pair_penalty").isNull(), "primer3_quality"),
            F.when(skipped | empty, "robustness"), F.when(F.col("specificity_status") == "SKIPPED", "specificity"),
        ),
        lambda x: x.isNotNull(),
    )
    roles = lambda name: {"roles": F.array_join(name, ",")}
    low, high = c.min_inclusivity_before_high_risk, c.min_inclusivity_for_pass
    rows = evidence.withColumn("missing_components", F.array_sort(lacking))
    # by severity, source and code; at most one of each, so nothing is left to sort or to drop
    every = F.array(
        F.when(share < low, _reason("INCLUSIVITY_BELOW_MINIMUM", "HIGH_RISK", "inclusivity", counted(low))),
        F.when(off & (detectable > 0), _reason("DETECTABLE_OFF_TARGET", "HIGH_RISK", "specificity", {"detectable_off_target_count": detectable, "plausible_off_target_count": plausible})),
        F.lit(None).cast(REASON) if run is None else run,
        F.when((share >= low) & (share < high), _reason("INCLUSIVITY_BELOW_PASS", "REVIEW", "inclusivity", counted(high))),
        F.when(skipped, _reason("INCLUSIVITY_EVIDENCE_MISSING", "REVIEW", "inclusivity"))
        .when(empty, _reason("INCLUSIVITY_EVIDENCE_MISSING", "REVIEW", "inclusivity", {"evaluation_sequence_count": F.lit(0)}, MESSAGES["INCLUSIVITY_EVIDENCE_EMPTY"])),
        F.when(F.size("missing_components") > 0, _reason("EVIDENCE_INCOMPLETE", "REVIEW", "ranking", {"components": F.array_join("missing_components", ",")})),
        F.when(off & (detectable == 0) & (plausible > 0), _reason("PLAUSIBLE_OFF_TARGET_AMPLICON", "REVIEW", "specificity", {"plausible_off_target_count": plausible})),
        F.when(F.col("specificity_status") == "SKIPPED", _reason("SPECIFICITY_EVIDENCE_MISSING", "REVIEW", "specificity")),
        F.when(F.size("accepted_roles") > 0, _reason("IUPAC_PROPOSAL_ACCEPTED", "ADVISORY", "degeneracy", roles("accepted_roles"))),
        F.when(F.size("rejected_roles") > 0, _reason("IUPAC_PROPOSAL_REJECTED", "ADVISORY", "degeneracy", roles("rejected_roles"))),
        F.when(off & (detectable == 0) & (plausible == 0) & (hits > 0), _reason("ISOLATED_OFF_TARGET_HITS", "ADVISORY", "specificity", {"compatible_hit_count": hits})),
    )
    rows = rows.withColumn("reasons", F.array_compact(every))
    return rows.withColumn("classification", classification(F.col("reasons")))


def classification(reasons: Column) -> Column:
    has = lambda s: F.exists(reasons, lambda r: r["severity"] == s)
    return F.when(has("HIGH_RISK"), "HIGH_RISK").when(has("REVIEW"), "REVIEW").otherwise("IN SILICO PASS")


def score_components(rows: DataFrame) -> DataFrame:
    """Five parts of the score, null where their evidence is missing.

    Further columns read: the region's means, and accepted_degeneracies, an array of (original,
    proposed) of accepted proposals.
    """
    n = F.col("evaluation_sequence_count")
    measured = (F.col("inclusivity_status") == "COMPLETE") & (n > 0)
    hits = F.col("compatible_hit_count")
    specificity = F.when(F.col("detectable_count") > 0, 0.0).when(F.col("plausible_count") > 0, 0.40).when(hits > 0, F.greatest(F.lit(0.80), 1.0 - 0.02 * hits)).otherwise(1.0)
    region = (
        F.col("mean_conservation") + F.col("minimum_conservation") + F.col("mean_coverage") + (1.0 - F.col("mean_gap_frequency"))
        + (1.0 - F.least(F.col("mean_entropy_bits") / 2.0, F.lit(1.0)))
    ) / 5.0
    gained = F.aggregate("accepted_degeneracies", F.lit(0.0), lambda acc, d: acc + d["original"] / d["proposed"])
    robustness = (gained + (len(ROLES) - F.size("accepted_degeneracies"))) / float(len(ROLES))
    return rows.withColumns(
        {
            "inclusivity_score": F.when(measured, F.col("original_compatible_count") / n),
            "specificity_score": F.when(F.col("specificity_status") == "COMPLETE", specificity),
            "conservation_score": region, "primer3_quality_score": 1.0 / (1.0 + F.col("pair_penalty")), "robustness_score": F.when(measured, robustness),
        }
    )


def final_score(c: RankingConfig) -> Column:
    """Weighted sum times 100; null where any part is, even one of weight 0."""
    parts = [F.lit(getattr(c.weights, f.name)) * F.col(f"{f.name}_score") for f in fields(c.weights)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return 100.0 * total


def sort_keys() -> list[Column]:
    order = F.array(*map(F.lit, CLASSES))
    return [
        F.array_position(order, F.col("classification")), F.when(F.col("score_status") == "COMPLETE", 0).otherwise(1), F.col("final_score").desc_nulls_last(),
        F.col("inclusivity_score").desc_nulls_last(), F.col("pair_penalty").asc_nulls_last(), F.col("primer3_index"), F.col("assay_id"),
    ]


def rank(evidence: DataFrame, c: RankingConfig, missing_run_evidence: list[str] | None = None) -> DataFrame:
    """All assays classified, scored and ranked from 1; a total order.

    With ``missing_run_evidence`` (codes of what a run lacks) every assay gets a reason for review,
    lacks the component ``execution`` and has no score; earlier reasons stay as they were.
    """
    run = _reason("RUN_EVIDENCE_INCOMPLETE", "REVIEW", "execution", {"missing": F.lit(",".join(sorted(missing_run_evidence)))}) if missing_run_evidence else None
    rows = score_components(classify(evidence, c, run)).withColumn("final_score", final_score(c))
    if missing_run_evidence:
        rows = rows.withColumns(
            {"final_score": F.lit(None).cast("double"), "missing_components": F.array_sort(F.array_union("missing_components", F.array(F.lit("execution"))))}
        )
    rows = rows.withColumn("score_status", F.when(F.col("final_score").isNull(), "INCOMPLETE").otherwise("COMPLETE"))
    return number_rows(rows, "rank", *sort_keys())


def recommended(ranked: DataFrame) -> DataFrame:
    """One row: the first passing assay, null where none passes."""
    return ranked.agg(F.min_by("assay_id", F.when(F.col("classification") == "IN SILICO PASS", F.col("rank"))).alias("assay_id"))


def report_counts(ranked: DataFrame) -> DataFrame:
    return ranked.groupBy("classification", "score_status").agg(F.count(F.lit(1)).alias("n"))


def evidence_gaps(assays: DataFrame, rows: DataFrame, keys: list[str], expected: DataFrame) -> DataFrame:
    """What is wrong with an evidence table: (problem, keys): unknown, repeated or missing rows.

    ``expected`` has every combination that must occur once.
    """
    unknown = rows.join(assays.select("assay_id"), "assay_id", "left_anti").select(F.lit("UNKNOWN_ASSAY").alias("problem"), *keys)
    repeated = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("DUPLICATE").alias("problem"), *keys)
    missing = expected.join(rows.select(*keys), keys, "left_anti").select(F.lit("MISSING").alias("problem"), *keys)
    return unknown.unionByName(repeated).unionByName(missing)


def invalid_evidence(rows: DataFrame) -> DataFrame:
    """(problem, assay_id) of rows whose evidence contradicts itself, the first problem of each."""
    share = lambda *names: [F.col(n).isNull() | F.isnan(n) | ~F.col(n).between(0.0, 1.0) for n in names]
    least = lambda *names: [F.col(n) < 0 for n in names]
    of = lambda tests: F.coalesce(F.exists(F.array(*tests), lambda x: x), F.lit(False))
    done = lambda stage: F.col(f"{stage}_status") == "COMPLETE"
    code = (
        F.when(~F.col("inclusivity_status").isin("COMPLETE", "SKIPPED") | ~F.col("specificity_status").isin("COMPLETE", "SKIPPED"), "STATUS")
        .when(of(least("evaluation_sequence_count", "original_compatible_count", "compatible_hit_count", "plausible_count", "detectable_count")), "NEGATIVE_COUNT")
        .when(done("inclusivity") & F.col("evaluation_sequence_count").isNull(), "INCLUSIVITY_COUNT")
        .when(F.col("original_compatible_count") > F.col("evaluation_sequence_count"), "MORE_COMPATIBLE_THAN_EVALUATED")
        .when(done("specificity") & (F.col("compatible_hit_count").isNull() | F.col("plausible_count").isNull() | F.col("detectable_count").isNull()), "SPECIFICITY_COUNT")
        .when(F.col("detectable_count") > F.col("plausible_count"), "MORE_DETECTABLE_THAN_PLAUSIBLE")
        .when(of(share("mean_conservation", "minimum_conservation", "mean_coverage", "mean_gap_frequency")), "REGION_SHARE")
        .when(F.col("mean_entropy_bits").isNull() | F.isnan("mean_entropy_bits") | (F.col("mean_entropy_bits") < 0), "REGION_ENTROPY")
        .when(F.isnan("pair_penalty") | (F.col("pair_penalty") < 0), "PENALTY")
        .when(F.exists("accepted_degeneracies", lambda d: (d["original"] < 1) | (d["proposed"] < d["original"])), "DEGENERACY")
    )
    return rows.select(code.alias("problem"), "assay_id").where("problem is not null")
