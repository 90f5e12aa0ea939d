"""Records of runs: an append-only event log, a manifest of attempts, and what evidence is missing."""

from __future__ import annotations

import json
import re
from datetime import datetime, timezone
from pathlib import Path

from strandweave.functions.text import LOG_CHARS, NUCLEOTIDE_RUN, REDACTED
from strandweave.sources.panel import write_json

# Events and the fields each may carry; parts of names that hold secrets.
EVENTS = {
    "run_started": ("target_name", "status"), "environment_inspected": (), "plan_created": (), "stage_started": ("stage", "action"),
    "stage_completed": ("stage", "action", "checkpoint_path"), "stage_reused": ("stage", "action", "checkpoint_path"), "stage_failed": ("stage", "message", "error_type"),
    "run_completed": ("status", "missing_evidence"), "run_action_required": ("status", "code", "artifact"), "run_failed": ("status", "stage", "message", "error_type"),
}
SECRET = ("token", "api_key", "secret", "password", "authorization", "email")
RUN = re.compile(NUCLEOTIDE_RUN)


def clean(value, name: str = ""):
    """A value fit for a log: no secrets, no long runs of nucleotides, at most 1000 characters."""
    plain = name.lower().replace("-", "_")
    if any(plain == s or plain.endswith("_" + s) for s in SECRET):
        return "[REDACTED]"
    if isinstance(value, str):
        return RUN.sub(REDACTED, value)[:LOG_CHARS]
    if isinstance(value, dict):
        return {k: clean(v, k) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [clean(v, name) for v in value]
    return value


def missing_evidence(evaluation_sequences: int, assays: int, inclusivity: str, specificity: str, ranking: str | None = None) -> list[str]:
    """Codes of what a run lacks for a conclusion; empty where it lacks nothing."""
    out = [code for bad, code in (
        (evaluation_sequences == 0, "EMPTY_EVALUATION_SET"), (assays == 0, "NO_ASSAYS"), (inclusivity != "COMPLETE", "INCLUSIVITY_NOT_COMPLETE"),
        (specificity != "COMPLETE", "SPECIFICITY_NOT_COMPLETE"), (ranking not in (None, "COMPLETE"), "RANKING_NOT_COMPLETE"),
    ) if bad]
    return out


def outcome(run_status: str, classifications: list[str]) -> str:
    """How a report may word what was found."""
    if run_status == "FAILED":
        return "Execution failed - no conclusive scientific outcome"
    if run_status == "ACTION_REQUIRED":
        return "Inconclusive - scientific review required before execution"
    if run_status != "COMPLETED" or not classifications:
        return "Inconclusive - insufficient evidence"
    if "IN SILICO PASS" in classifications:
        return "In-silico pass - experimental validation required"
    if "REVIEW" in classifications:
        return "Scientific review required"
    return "High risk - no assay passes in silico"


class Recorder:
    """One run folder's log and attempts. An attempt left running by a dead process counts as failed."""

    def __init__(self, folder: str, clock=lambda: datetime.now(timezone.utc).isoformat()):
        self.root, self.clock = Path(folder), clock
        self.path = self.root / "run_manifest.json"
        self.manifest = json.loads(self.path.read_text()) if self.path.exists() else {"schema_version": 1, "attempts": []}

    def log(self, event: str, **values) -> None:
        if extra := set(values) - set(EVENTS[event]):
            raise ValueError(f"{event} has no fields {sorted(extra)}")
        self.root.mkdir(parents=True, exist_ok=True)
        with (self.root / "run.log.jsonl").open("a", encoding="utf-8") as f:
            f.write(json.dumps({"time": self.clock(), "event": event} | clean(values), sort_keys=True) + "\n")

    def begin(self, target: str) -> None:
        for a in self.manifest["attempts"]:
            if a["status"] == "RUNNING":
                a |= {"status": "FAILED", "error_type": "INTERRUPTED", "ended_at": self.clock()}
        self.manifest["attempts"].append({"number": len(self.manifest["attempts"]) + 1, "status": "RUNNING", "started_at": self.clock(), "stages": {}})
        write_json(self.path, self.manifest)
        self.log("run_started", target_name=target, status="RUNNING")

    @property
    def attempt(self) -> dict:
        return self.manifest["attempts"][-1]

    def stage(self, stage: str, action: str, event: str, **more) -> None:
        self.attempt["stages"][stage] = {"action": action, "event": event}
        write_json(self.path, self.manifest)
        self.log(event, stage=stage, **({"action": action} if "action" in EVENTS[event] else {}), **more)

    def finish(self, missing: list[str]) -> str:
        status = "PARTIAL" if missing else "COMPLETED"
        self.attempt.update(status=status, ended_at=self.clock(), missing_evidence=missing)
        write_json(self.path, self.manifest)
        self.log("run_completed", status=status, missing_evidence=missing)
        return status

    def action_required(self, code: str, artifact: str) -> str:
        self.attempt.update(status="ACTION_REQUIRED", ended_at=self.clock())
        write_json(self.path, self.manifest)
        self.log("run_action_required", status="ACTION_REQUIRED", code=code, artifact=artifact)
        return "ACTION_REQUIRED"

    def fail(self, stage: str, error: Exception) -> None:
        self.attempt.update(status="FAILED", ended_at=self.clock(), error_type=type(error).__name__)
        write_json(self.path, self.manifest)
        self.log("run_failed", status="FAILED", stage=stage, message=str(error), error_type=type(error).__name__)
