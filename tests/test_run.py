"""A whole run over small synthetic sequences: design, evidence, ranking, resume, page."""

import json
import random
from dataclasses import replace

import pytest

from strandweave.plans import dag, report
from strandweave.plans.config import (
    AlignmentConfig, ClusteringConfig, ConservationConfig, ContrastConfig, InclusivityConfig, NcbiInputConfig, OffTargetConfig, OligoConstraints, PanelConfig, PipelineConfig, PrimerDesignConfig, RankingConfig,
    SpecificityConfig, validate,
)
from strandweave.plans.run import Run
from strandweave.sources import ncbi, panel, sinks


def mutated(rng, seq, share):
    return "".join(rng.choice("ACGT") if rng.random() < share else c for c in seq)


@pytest.fixture(scope="module")
def setup(tmp_path_factory):
    rng = random.Random(5)
    root = tmp_path_factory.mktemp("run")
    base = "".join(rng.choice("ACGT") for _ in range(420))
    targets = [base, base, base[:200] + "A" + base[201:], base[:300] + "GT" + base[300:]]
    (root / "target.fasta").write_text("".join(f">t{i} x\n{s}\n" for i, s in enumerate(targets)))
    (root / "other.fasta").write_text("".join(f">o{i}\n{mutated(rng, base, 0.25)}\n" for i in range(2)))
    panel.propose(str(root / "p.yaml"), "target", [{"name": "Other", "criticality": "CRITICAL", "roles": ["CHALLENGE"]}])
    panel.approve(str(root / "p.yaml"), str(root / "m.json"))
    loose = OligoConstraints(18, 20, 22, 50.0, 58.0, 66.0, 25.0, 75.0)
    config = PipelineConfig(
        fasta=str(root / "target.fasta"), panel=PanelConfig(frozen_manifest=str(root / "m.json")), clustering=ClusteringConfig(True, 0.99), alignment=AlignmentConfig(True),
        conservation=ConservationConfig(True, 60, 30), contrastive_conservation=ContrastConfig(True),
        primer_design=PrimerDesignConfig(True, 2, 2, 200, product_size_min=80, product_size_max=160, primer=loose, probe=replace(loose, max_size=24, min_tm=55.0, opt_tm=62.0, max_tm=70.0)),
        inclusivity=InclusivityConfig(True), off_targets=(OffTargetConfig("other ", fasta=str(root / "other.fasta")),), specificity=SpecificityConfig(True), ranking=RankingConfig(True),
    )
    return root, validate(config)


def test_run_resume_and_page(spark, setup):
    root, config = setup
    run = Run(spark, config, str(root / "out"))
    assert run.execute() == "COMPLETED"
    ranked = run.get("ranking", "ranked").orderBy("rank").collect()
    assert ranked and [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1))
    assert all(r.evaluation_sequence_count == 3 for r in ranked)  # one of four is a duplicate
    table = (root / "out/ranking/assay_ranking.tsv").read_text().splitlines()
    assert tuple(table[0].split("\t")) == sinks.RANKING and len(table) == len(ranked) + 1
    assert run.get("clustering", "clusters").select("cluster_id").distinct().count() <= 3
    aligned = {r.sequence_id: r for r in run.get("alignment", "aligned").collect()}
    assert len({len(r.aligned_sequence) for r in aligned.values()}) == 1
    text = (root / "out/report.html").read_text()
    assert "Recommended" in text and "Observations" in text and "Positions with metrics" in text
    out, told = root / "out", lambda name: (root / "out" / name).read_text().splitlines()
    assert told("inclusivity/assay_inclusivity.tsv")[0] == "\t".join(sinks.ASSAY_INCLUSIVITY) and len(told("inclusivity/assay_inclusivity.tsv")) == 3 * len(ranked) + 1
    assert len(told("inclusivity/degeneracy_proposals.tsv")) == 3 * len(ranked) + 1 and told("inclusivity/oligo_matches.tsv")[0] == "\t".join(sinks.OLIGO_MATCHES)
    assert told("specificity/plausible_amplicons.tsv")[0] == "\t".join(sinks.AMPLICONS) and told("inclusivity/oligo_variations.tsv")[0] == "\t".join(sinks.VARIATIONS)
    assert len(told("primer_design/assays.tsv")) == len(ranked) + 1 and told("primer_design/assays.tsv")[0] == "\t".join(sinks.ASSAYS)
    assert told("contrastive_conservation/window_metrics.tsv")[0] == "\t".join(sinks.CONTRAST_WINDOWS) and told("contrastive_conservation/candidate_regions.tsv")[0] == "\t".join(sinks.CONTRAST_REGIONS)
    windows = len(told("conservation/window_metrics.tsv")) - 1
    assert len(told("contrastive_conservation/dataset_metrics.tsv")) == windows + 1
    assert any(x.startswith("SEQUENCE_INCLUDED_REGION=") for x in told("primer_design/primer3_input.txt"))
    assert told("discovery_set.fasta")[0] == ">t3" and (out / "alignment/discovery_alignment.fasta").exists() and told("conservation/consensus_major.fasta")[0] == ">major-consensus"
    qc_report, summary = json.loads((out / "qc_report.json").read_text()), json.loads((out / "run_summary.json").read_text())
    assert [r["sequence_id"] for r in qc_report["records"]] == ["t0", "t1", "t2", "t3"] and [r["in_evaluation_set"] for r in qc_report["records"]] == [True, False, True, True]
    assert qc_report["codes"] == {"ACCEPTED": 3, "DUPLICATE_SEQUENCE": 1} and summary["unreconciled_assays"] == 0 and summary["provenance"]["panel"]["mode"] == "approved_manifest"
    assert summary["provenance"]["input"]["kind"] == "fasta" and summary["provenance"]["reference"]["id"] == "t3"
    for name in ("alignment_report.json", "clustering_report.json", "conservation/conservation_report.json", "contrastive_conservation/contrastive_conservation_report.json", "primer_design/primer_design_report.json", "inclusivity/inclusivity_report.json", "specificity/specificity_report.json", "ranking/ranking_report.json"):
        assert json.loads((out / name).read_text())["status"] == "COMPLETE", name
    assert (out / "contrastive_conservation/report.html").exists() and "contains_anchor" in (out / "primer_design/report.html").read_text()
    assert report.observations(run.get("inclusivity", "results"), run.get("ranking", "ranked")).where("not reconciled").count() == 0
    again = Run(spark, config, str(root / "out"))
    assert set(dag.plan(dag.Policy(resume=True), again.valid).values()) == {"REUSE"}
    other = Run(spark, replace(config, ranking=replace(config.ranking, min_inclusivity_for_pass=0.95)), str(root / "out"))
    plan = dag.plan(dag.Policy(resume=True), other.valid)
    assert plan["ranking"] == "RUN" and plan["specificity"] == "REUSE"
    state = root / "out/.checkpoints/qc/state"
    next(state.rglob("*.parquet")).write_bytes(b"changed")
    assert again.points.problem(again.request("qc")) == "STATE_HASH_MISMATCH"
    plan = dag.plan(dag.Policy(resume=True), again.valid)
    assert plan["qc"] == "RUN" and plan["conservation"] == "FORCED" and plan["input"] == "REUSE"
    names = sinks.bundle(str(root / "out"), str(root / "b.zip"))
    first = (root / "b.zip").read_bytes()
    assert {"run_manifest.json", "qc_report.json", "panel/approved_panel.json", ".checkpoints/qc/manifest.json"} <= set(names) and not any("state" in n for n in names)
    assert sinks.bundle(str(root / "out"), str(root / "b.zip")) == names and (root / "b.zip").read_bytes() == first


def test_unapproved_panel_stops_a_run(spark, setup, tmp_path):
    root, config = setup
    proposal = panel.load_proposal(str(root / "p.yaml"))["definition"]
    run = Run(spark, replace(config, panel=PanelConfig(proposal=proposal)), str(tmp_path / "o"))
    assert run.execute() == "ACTION_REQUIRED" and panel.load_proposal(str(tmp_path / "o/panel_proposal.yaml"))["definition"] == proposal
    assert json.loads((tmp_path / "o/run_manifest.json").read_text())["attempts"][0]["status"] == "ACTION_REQUIRED"


def test_page_has_all_rows(spark, tmp_path):
    """More windows, assays and datasets than a first page's worth."""
    n = 2100
    win = spark.range(1, n + 1).selectExpr("int(id) reference_start", "int(id) reference_end", "1 position_count", *(f"0.5D {c}" for c in sinks.WINDOWS[3:]))
    evidence = win.selectExpr("reference_start", "reference_end", "'other' dataset", "0.5D similarity", "'o1' sequence_id")

    class Finished:
        root, config = str(tmp_path), PipelineConfig(off_targets=(OffTargetConfig("other", fasta="x"),))
        tables = {("conservation", "windows"): win, ("contrastive_conservation", "evidence"): evidence}

        def has(self, stage, name):
            return (stage, name) in self.tables

        def get(self, stage, name):
            return self.tables[stage, name]

    text = report.researcher_page(Finished(), "COMPLETED")
    assert len(text.split('points="')[1].split('"')[0].split()) == n
    assert text.count("<td>observed</td>") == n and f"<td>{n}</td>" in text


def test_run_on_an_archive_and_frozen_off_targets(spark, tmp_path):
    from tests.test_sources import Archive

    client = Archive(3)
    ncbi.acquire(NcbiInputConfig(query="o", batch_size=20, retries=5), str(tmp_path / "off"), Archive(2))
    c = validate(PipelineConfig(ncbi=NcbiInputConfig(query="q", max_records=3), alignment=AlignmentConfig(True), conservation=ConservationConfig(True, 2, 1), off_targets=(OffTargetConfig("o", frozen_dataset=str(tmp_path / "off")),)))
    run = Run(spark, c, str(tmp_path / "out"), client)
    assert run.execute() == "PARTIAL" and run.datasets().count() == 2
    assert {"features", "annotations"} <= set(run.get("input", "sequences").columns) and client.fetched
    summary = json.loads((tmp_path / "out/run_summary.json").read_text())
    assert summary["provenance"]["input"]["query"] == "q" and summary["provenance"]["input"]["resolved_accession_versions"] == ["R0.1", "R1.1", "R2.1"]
    assert (tmp_path / "out/ncbi_dataset_manifest.json").exists() and run.get("conservation", "annotations").first().label == "g"
    (tmp_path / "off" / ncbi.RECORDS).write_text("changed")
    with pytest.raises(ValueError, match="byte_size"):
        Run(spark, c, str(tmp_path / "out2"), client).datasets()
