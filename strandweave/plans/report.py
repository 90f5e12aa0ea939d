"""Read side of a run: observations reconciled with counts, curves, heat maps, provenance, the pages."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.operators import conserve, contrast, design, qc, ranking, specificity
from strandweave.plans.recorder import outcome
from strandweave.plans.storage import number_rows
from strandweave.sources import sinks


def observations(results: DataFrame, ranked: DataFrame) -> DataFrame:
    """Compatible and evaluated sequences of each assay by the matrix and by the ranking, side by side."""
    mine = results.groupBy("assay_id").agg(F.count(F.lit(1)).alias("observed_sequences"), F.count_if("original_compatible").alias("observed_compatible"))
    told = ranked.select("assay_id", F.col("evaluation_sequence_count").alias("recorded_sequences"), F.col("original_compatible_count").alias("recorded_compatible"))
    both = mine.join(told, "assay_id", "full_outer")
    agree = F.col("observed_sequences").eqNullSafe(F.col("recorded_sequences")) & F.col("observed_compatible").eqNullSafe(F.col("recorded_compatible"))
    return both.withColumn("reconciled", agree)


def curve_segments(points: DataFrame, place: str, value: str) -> DataFrame:
    """(start, end, n) of runs of places with a value; a missing value ends a run. Places are numbered
    by ranges in parallel, so no task holds the whole curve."""
    known = number_rows(points.where(F.col(value).isNotNull()).select(F.col(place).alias("_place")), "_n", "_place")
    return known.groupBy((F.col("_place") - F.col("_n")).alias("_run")).agg(F.min("_place").alias("start"), F.max("_place").alias("end"), F.count(F.lit(1)).alias("n")).drop("_run")


def stage_counts(run) -> dict:
    """Row counts of what each stage left."""
    names = {"input": "sequences", "qc": "sequences", "clustering": "discovery", "primer_design": "assays"}
    out = {s: run.get(s, n).count() for s, n in names.items() if run.has(s, n)}
    if run.has("qc", "sequences"):
        out["qc"] = qc.stage_counts(run.get("qc", "sequences")).first().asDict()
    return out


def _curve(windows: DataFrame) -> str:
    """The conservation curve at windows' middles, and where it is interrupted."""
    points = windows.orderBy("reference_start").select(((F.col("reference_start") + F.col("reference_end")) / 2).alias("x"), F.col("mean_conservation").alias("y")).toLocalIterator()
    return "<h2>Conservation</h2>" + sinks.line_chart([(r.x, r.y) for r in points])


def _heat_map(run) -> str:
    names = [o.name for o in run.config.off_targets]
    states = contrast.heat_map(run.get("contrastive_conservation", "evidence"), names).orderBy("reference_start").toLocalIterator()
    return sinks.html_table("Similarity to other datasets", ("reference_start", "reference_end", *names), (r.asDict() for r in states))


def contrast_page(run) -> None:
    """The contrast's own page: its curve, each window's worst case, the heat map and the regions chosen."""
    worst = ("reference_start", "reference_end", "worst_dataset", "worst_similarity", "conservation_margin")
    told = run.get("contrastive_conservation", "summaries").orderBy("reference_start").select(*worst).toLocalIterator()
    keys = ("rank", "region_id", "reference_start", "reference_end", "peak_start", "peak_end", "worst_dataset", "worst_similarity")
    chosen = run.get("contrastive_conservation", "regions").orderBy("rank").select(*keys).toLocalIterator()
    parts = [_curve(run.get("conservation", "windows")), sinks.html_table("Regions", keys, (r.asDict() for r in chosen)), sinks.html_table("Windows", worst, (r.asDict() for r in told)), _heat_map(run)]
    sinks.replace_text(run.root / "contrastive_conservation" / "report.html", sinks.page("Contrast with other datasets", *parts))


def assay_page(run) -> None:
    """The assays' own page: oligos, product and whether the amplicon holds the region's anchor."""
    assays, regions = run.get("primer_design", "assays"), run.get("primer_design", "regions")
    rows = assays.join(design.contains_anchor(assays, regions), "assay_id").orderBy("assay_id")
    names = ("forward", "probe", "reverse")
    shown = rows.select("assay_id", "region_id", *(F.col(f"{n}.sequence").alias(n) for n in names), *(F.round(f"{n}.tm", 2).alias(f"{n} Tm") for n in names), "product_size", F.round("pair_penalty", 4).alias("penalty"), "contains_anchor")
    table = sinks.html_table("Assays", tuple(shown.columns), (r.asDict() for r in shown.toLocalIterator()))
    sinks.replace_text(run.root / "primer_design" / "report.html", sinks.page("Assay candidates", table))


def researcher_page(run, status: str) -> str:
    """The HTML page of a finished run: all rows of its tables, except that the best windows are a top 10."""
    parts, classes = [], []
    if run.has("ranking", "ranked"):
        rows = run.get("ranking", "ranked").orderBy("rank").select("rank", "assay_id", "classification", F.round("final_score", 3).alias("final_score"), F.array_join("reasons.code", ", ").alias("reasons")).toLocalIterator()
        classes = [r.classification for r in run.get("ranking", "ranked").select("classification").distinct().collect()]
        best = ranking.recommended(run.get("ranking", "ranked")).first().assay_id
        parts.append(f"<p>Recommended: {best or 'none'}</p>" + sinks.html_table("Assays", ("rank", "assay_id", "classification", "final_score", "reasons"), (r.asDict() for r in rows)))
        anchors = design.contains_anchor(run.get("primer_design", "assays"), run.get("primer_design", "regions")).orderBy("assay_id").toLocalIterator()
        parts.append(sinks.html_table("Anchor", ("assay_id", "contains_anchor"), (r.asDict() for r in anchors)))
    if run.has("inclusivity", "results") and run.has("ranking", "ranked"):
        told = observations(run.get("inclusivity", "results"), run.get("ranking", "ranked")).orderBy("assay_id")
        parts.append(sinks.html_table("Observations", tuple(told.columns), (r.asDict() for r in told.toLocalIterator())))
    if run.has("conservation", "windows"):
        win = run.get("conservation", "windows")
        parts.append(_curve(win))
        parts.append(sinks.html_table("Best windows", sinks.WINDOWS, (r.asDict() for r in conserve.top_windows(win).collect())))
    if run.has("conservation", "positions"):
        runs = curve_segments(run.get("conservation", "positions").where("reference_position is not null"), "reference_position", "major_allele_frequency").orderBy("start")
        parts.append(sinks.html_table("Positions with metrics", ("start", "end", "n"), (r.asDict() for r in runs.toLocalIterator())))
    if run.has("contrastive_conservation", "evidence"):
        parts.append(_heat_map(run))
    if run.has("specificity", "hits"):
        names = run.spark.createDataFrame([(o.name,) for o in run.config.off_targets], "dataset string")
        told = specificity.by_dataset(run.get("specificity", "hits"), run.get("specificity", "amplicons"), names, run.assays()).orderBy("assay_id", "dataset").toLocalIterator()
        parts.append(sinks.html_table("Off-target evidence", ("assay_id", "dataset", "hit_count", "plausible_count", "detectable_count"), (r.asDict() for r in told)))
    text = sinks.page("Assay evidence", f"<p>{outcome(status, classes)}</p>", *parts)
    sinks.replace_text(Path(run.root) / "report.html", text)
    return text


def _input_provenance(run, counts: dict) -> dict:
    """Where the target's records come from, by hash and by what was asked for."""
    c = run.config
    sources = json.loads(run.points.manifest_path("input").read_text(encoding="utf-8"))["request"]["inputs"]
    if c.ncbi is None:
        path = c.fasta or c.genbank
        return {"kind": "fasta" if c.fasta else "genbank", "configured_path": path, "source_sha256": f"sha256:{sources[path]}", **counts}
    m = json.loads((run.root / "ncbi_dataset_manifest.json").read_text(encoding="utf-8"))
    asked = {k: m["source"][k] for k in ("query", "requested_accessions") if k in m["source"]}
    out = {"kind": "ncbi", "mode": "frozen_dataset" if c.ncbi.frozen_dataset else m["source"]["mode"], "dataset_sha256": f"sha256:{m['consolidated']['sha256']}", **asked, **counts}
    if c.ncbi.frozen_dataset:
        out |= {"source_dataset_mode": m["source"]["mode"], "configured_path": c.ncbi.frozen_dataset}
    return out | {"resolved_accession_versions": [e["accession_version"] for e in m["resolved_entries"]]}


def provenance(run) -> dict:
    """What a run's results rest on: input, reference, panel, attempts, and each stage's fingerprints."""
    stages = {}
    for path in sorted((Path(run.root) / ".checkpoints").glob("*/manifest.json")):
        m = json.loads(path.read_text(encoding="utf-8"))
        stages[m["stage"]] = {k: m.get(k) for k in ("status", "fingerprint", "result_fingerprint")} | {k: m["request"][k] for k in ("software", "tools", "inputs")}
    counts = qc.stage_counts(run.get("qc", "sequences")).first().asDict() if run.has("qc", "sequences") else {}
    ref = run.get("alignment", "reference").first() if run.has("alignment", "reference") else None
    panel = {"mode": "legacy_unconfigured"}
    if run.config.panel and run.config.panel.frozen_manifest:
        from strandweave.plans.checkpoint import tree_sha256
        from strandweave.sources.panel import approved

        definition = approved(run.config.panel.frozen_manifest)["definition"]
        panel = {"mode": "approved_manifest", "manifest_sha256": "sha256:" + tree_sha256(Path(run.root) / "panel" / "approved_panel.json"), "target_mode": definition["target"]["mode"], "non_target_count": len(definition["non_targets"])}
    return {
        "attempts": [{k: a.get(k) for k in ("number", "status", "started_at", "ended_at")} for a in run.recorder.manifest["attempts"]], "stages": stages, "input": _input_provenance(run, counts),
        "reference": {"id": ref and ref.reference_id, "mode": ref and ref.mode}, "panel": panel,
    }


def publish_summary(run, status: str, missing: list[str]) -> None:
    """The run's page, its summary with provenance, and the quality report of every record."""
    rows = run.get("qc", "sequences").join(run.get("clustering", "discovery").select("sequence_id", F.lit(True).alias("d")), "sequence_id", "left")
    accepted = F.col("status") == qc.ACCEPTED
    rows = rows.select("ordinal", "sequence_id", "status", "reason_codes", accepted.alias("in_evaluation_set"), F.coalesce("d", F.lit(False)).alias("in_discovery_set"))
    counts = stage_counts(run)
    codes = {r.code: r.n for r in qc.counts(run.get("qc", "sequences")).collect()}  # one row a rule
    stages = {s: run.status(s) for s in ("contrastive_conservation", "inclusivity", "specificity", "ranking")}
    sinks.write_json_rows(run.path("qc_report.json"), "records", rows, "ordinal", codes=codes, counts=counts, stages=stages)
    unreconciled = 0
    if run.has("inclusivity", "results") and run.has("ranking", "ranked"):
        unreconciled = observations(run.get("inclusivity", "results"), run.get("ranking", "ranked")).where("not reconciled").count()
    summary = {"schema_version": 1, "status": status, "missing_evidence": missing, "target": run.config.target_name, "counts": counts, "unreconciled_assays": unreconciled, "provenance": provenance(run)}
    sinks.replace_text(Path(run.root) / "run_summary.json", json.dumps(summary, indent=2, sort_keys=True, allow_nan=False) + "\n")
    researcher_page(run, status)
