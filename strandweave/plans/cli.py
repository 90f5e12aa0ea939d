"""Command line: doctor, panel approve, guided prepare and finalize, run, report, bundle."""

from __future__ import annotations

import argparse
import importlib.util
import json
import re
import shutil
import sys
from pathlib import Path

from strandweave.plans import config, dag


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="strandweave")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("doctor")
    approve = sub.add_parser("panel").add_subparsers(dest="action", required=True).add_parser("approve")
    approve.add_argument("proposal")
    approve.add_argument("--output", required=True)
    guided = sub.add_parser("guided").add_subparsers(dest="action", required=True)
    prepare = guided.add_parser("prepare")
    prepare.add_argument("--target", required=True)
    prepare.add_argument("--non-target", action="append", default=[])
    prepare.add_argument("--workspace", required=True)
    finalize = guided.add_parser("finalize")
    finalize.add_argument("--target", required=True)
    finalize.add_argument("--workspace", required=True)
    finalize.add_argument("--approved-panel", required=True)
    run = sub.add_parser("run")
    run.add_argument("config")
    run.add_argument("--outdir")
    run.add_argument("--resume", action="store_true")
    run.add_argument("--from-step")
    run.add_argument("--force-step")
    run.add_argument("--dry-run", action="store_true")
    for name in ("report", "bundle"):
        one = sub.add_parser(name)
        one.add_argument("config" if name == "report" else "outdir")
        one.add_argument("--outdir" if name == "report" else "--output", required=True)
    return p


def doctor() -> dict:
    """What this machine offers."""
    from pyspark import __version__

    return {"python": sys.version.split()[0], "spark": __version__, "java": shutil.which("java"), "yaml": importlib.util.find_spec("yaml") is not None}


# What is known of targets that have suggestions of their own, and how a guided project runs.
KNOWN = {
    "west nile virus": {
        "name": "West Nile virus", "syndrome": "arboviral febrile disease", "vector": "mosquito",
        "challenges": {
            "Usutu virus": ("CRITICAL", "phylogenetic_neighbor"), "Japanese encephalitis virus": ("CRITICAL", "phylogenetic_neighbor"), "Dengue virus": ("IMPORTANT", "clinical_differential"),
        },
    },
}
TARGET_RECORDS, CHALLENGE_RECORDS = 50, 20
FETCH = {"batch_size": 20, "retries": 5}
STAGES_ON = {
    "alignment": {"enabled": True, "threads": 2}, "conservation": {"enabled": True, "window_size": 100, "step_size": 20},
    "primer_design": {"enabled": True, "max_candidate_regions": 6, "assays_per_region": 3}, "inclusivity": {"enabled": True}, "specificity": {"enabled": True}, "ranking": {"enabled": True},
}


def _named(name: str, what: str) -> str:
    if not isinstance(name, str) or not name.strip() or '"' in name or any(ord(ch) < 32 for ch in name.strip()):
        raise ValueError(f"{what} must be a name without quotes or control characters")
    return name.strip()


def _slug(name: str) -> str:
    return re.sub("[^a-z0-9]+", "-", name.casefold()).strip("-") or "dataset"


def guided_config(target: str, non_targets: list[str] | None = None) -> dict:
    """The configuration of a guided project: a proposal for review, nothing fetched yet.

    Without ``non_targets`` the suggestions for the target are taken; a target that has none is an error.
    """
    from strandweave.sources import panel

    target = _named(target, "the target")
    known = KNOWN.get(target.casefold())
    if non_targets is None and known is None:
        raise ValueError(f"no suggestions for {target!r}; name its non-targets")
    name = known["name"] if known else target
    complete = "complete genome[Title]" if known else "(complete genome[Title] OR complete sequence[Title])"
    suggested = known["challenges"] if known else {}
    if non_targets is None:
        chosen, by = {n: suggested[n] for n in suggested}, "curated_suggestions"
    else:
        chosen, by = {}, "researcher_selected"
        for n in (_named(n, "a non-target") for n in non_targets):
            if n.casefold() not in {x.casefold() for x in chosen}:
                chosen[n] = ("IMPORTANT", "researcher_selected")
    if not chosen:
        raise ValueError("a guided project needs at least one non-target")
    others = [{"name": n, "criticality": c, "roles": ["CHALLENGE"], "reason": why} for n, (c, why) in chosen.items()]
    definition = panel.definition_of(name, others, by)
    if known:
        definition["diagnostic_context"] |= {"syndrome": known["syndrome"], "vector": known["vector"]}
    return {
        "target": {"name": name}, "input": {"ncbi": {"query": f'"{name}"[Organism] AND {complete}'} | FETCH | {"max_records": TARGET_RECORDS}}, **STAGES_ON,
        "off_targets": [{"name": n, "frozen_dataset": f"guided_challenges/{i:03d}-{_slug(n)}"} for i, n in enumerate(chosen, 1)],
        "panel": {"proposal": definition}, "contrastive_conservation": {"enabled": False},
    }


def _write_mapping(path: Path, raw: dict) -> str:
    from strandweave.sources import panel, sinks

    try:
        import yaml
    except ImportError:
        panel.write_json(path, raw)
    else:
        sinks.replace_text(path, yaml.safe_dump(raw, sort_keys=False, allow_unicode=True))
    return str(path)


def guided_prepare(target: str, non_targets: list[str] | None, workspace: str) -> str:
    """A panel proposal and a config that holds it; nothing is fetched."""
    from strandweave.sources import panel

    root = Path(workspace)
    raw = guided_config(target, non_targets or None)
    panel.write_proposal(str(root / "panel_proposal.yaml"), raw["panel"]["proposal"])
    return _write_mapping(root / "config-proposal.yaml", raw)


def guided_finalize(target: str, workspace: str, approved: str, client=None) -> str:
    """Freeze the challenge datasets of an approved panel and write a config that runs on them."""
    from strandweave.plans.checkpoint import tree_sha256
    from strandweave.sources import ncbi, panel

    root = Path(workspace).resolve()
    target = _named(target, "the target")
    frozen_target, entries = panel.load_manifest(approved)
    if frozen_target.strip().casefold() != target.casefold():
        raise ValueError("the approved panel is for another target")
    wanted = [e for e in entries if "CHALLENGE" in e.roles]
    if not wanted:
        raise ValueError("the approved panel has no challenge")
    known = KNOWN.get(target.casefold(), {}).get("challenges", {})
    off, told = [], []
    for i, e in enumerate(wanted, 1):
        complete = "complete genome[Title]" if e.name.casefold() in {n.casefold() for n in known} else "(complete genome[Title] OR complete sequence[Title])"
        query, folder = f'"{_named(e.name, "a challenge")}"[Organism] AND {complete}', root / "guided_challenges" / f"{i:03d}-{_slug(e.name)}"
        m = ncbi.acquire(config.NcbiInputConfig(query=query, max_records=CHALLENGE_RECORDS, **FETCH), str(folder), client)
        if m["consolidated"]["record_count"] < 1:
            raise ValueError(f"no records for {e.name!r}")
        off.append({"name": e.name, "frozen_dataset": str(folder)})
        told.append({"name": e.name, "criticality": e.criticality, "query": query, "frozen_dataset": str(folder), "record_count": m["consolidated"]["record_count"], "records_sha256": m["consolidated"]["sha256"], "manifest_sha256": tree_sha256(folder / ncbi.MANIFEST)})
    raw = guided_config(target, [e.name for e in wanted]) | {"panel": {"frozen_manifest": str(Path(approved).resolve())}, "contrastive_conservation": {"enabled": True}, "off_targets": off}
    panel.write_json(root / "guided_acquisition_manifest.json", {
        "schema_version": 1, "target": target, "approved_panel_sha256": tree_sha256(Path(approved)), "datasets": told,
        "limitations": ["Bounds on records keep acquisition small and are no claim of representative sampling."],
    })
    return _write_mapping(root / "config-approved.yaml", raw)


def dry_run(c: config.PipelineConfig, policy: dag.Policy, outdir: str | None = None) -> dict:
    """What a run would do about each stage and what it lacks, without Spark, network or writing."""
    from strandweave.plans.run import Run

    root = Path(outdir) if outdir else None
    run = Run(None, c, outdir) if root is not None and root.exists() else None
    problems = {s: run.points.problem(run.request(s)) if run else "MISSING_MANIFEST" for s in dag.STAGES}
    actions = dag.plan(policy, lambda s: problems[s] is None)
    told = {s: {"action": actions[s]} | ({"checkpoint": problems[s]} if problems[s] else {}) for s in dag.STAGES}
    files = [p for p in (c.fasta, c.genbank, c.ncbi and c.ncbi.frozen_dataset, c.panel and c.panel.frozen_manifest, *(o.fasta or o.frozen_dataset for o in c.off_targets)) if p]
    return {
        "target": c.target_name, "stages": told, "enabled": [s for s in dag.STAGES if getattr(getattr(c, s, None), "enabled", True)],
        "missing_inputs": [p for p in files if not Path(p).exists()], "needs_network": bool(c.ncbi and c.ncbi.frozen_dataset is None),
        "action_required": "PANEL_APPROVAL" if c.panel and c.panel.proposal is not None else None,
    }


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "doctor":
        print(json.dumps(doctor(), indent=2))
        return 0
    if a.command == "panel":
        from strandweave.sources import panel

        panel.approve(a.proposal, a.output)
        return 0
    if a.command == "guided":
        print(guided_prepare(a.target, a.non_target or None, a.workspace) if a.action == "prepare" else guided_finalize(a.target, a.workspace, a.approved_panel))
        return 0
    if a.command == "bundle":
        from strandweave.sources import sinks

        sinks.bundle(a.outdir, a.output)
        return 0
    c = config.load(a.config)
    if a.command == "run":
        policy = dag.Policy(a.resume, a.from_step, a.force_step)
        if a.dry_run or not a.outdir:
            print(json.dumps(dry_run(c, policy, a.outdir), indent=2))
            return 0
    from pyspark.sql import SparkSession

    from strandweave.plans import report
    from strandweave.plans.run import Run

    run = Run(SparkSession.builder.getOrCreate(), c, a.outdir)
    if a.command == "report":
        report.researcher_page(run, run.recorder.attempt["status"])
        return 0
    status = run.execute(policy)
    if status == "ACTION_REQUIRED":
        return 3
    return 0


if __name__ == "__main__":
    sys.exit(main())
