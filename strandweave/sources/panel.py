"""Panels of non-targets: proposals, approval, frozen manifests, and the datasets bound to them."""

from __future__ import annotations

import hashlib
import json
import os
import re
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What the published format allows.
CRITICALITIES = ("CRITICAL", "IMPORTANT", "BACKGROUND")
ROLES = ("DESIGN", "CHALLENGE")
MODES = ("broad_detection", "subtype_specific")
PROPOSAL = ("schema_version", "status", "definition")
APPROVED = ("schema_version", "status", "approved_by_user", "proposal_sha256", "definition")


@dataclass(frozen=True)
class NonTarget:
    name: str
    criticality: str
    roles: tuple[str, ...]


def canonical_sha256(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False).encode()).hexdigest()


def write_json(path: Path, value) -> None:
    _replace(path, json.dumps(value, indent=2, sort_keys=True, allow_nan=False) + "\n")


def _replace(path: Path, text: str) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(path.name + ".part")
    part.write_text(text, encoding="utf-8")
    os.replace(part, path)


def _need(fine: bool, where: str, said: str) -> None:
    if not fine:
        raise ValueError(f"{where} {said}")


def _text(value, where, blank=False):
    _need(value is None and blank or isinstance(value, str) and bool(value.strip()), where, "must be a non-blank string")


def _taxid(value, where):
    _need(value is None or isinstance(value, int) and not isinstance(value, bool) and value > 0, where, "must be a positive integer or null")


def _one_of(allowed):
    return lambda value, where: _need(value in allowed, where, f"must be one of {', '.join(allowed)}")


def _list(each, least=0, unique=False):
    def check(value, where):
        _need(isinstance(value, (list, tuple)) and len(value) >= least, where, f"must be a list of at least {least}")
        for i, item in enumerate(value):
            each(item, f"{where}[{i}]")
        _need(not unique or len(set(value)) == len(value), where, "must not repeat a value")

    return check


def _record(**checks):
    """A mapping with exactly these fields, each as its check wants it."""

    def check(value, where):
        _need(isinstance(value, dict) and set(value) == set(checks), where, f"must have exactly the fields {', '.join(checks)}")
        for name, one in checks.items():
            one(value[name], f"{where}.{name}")

    return check


def _yes_no(value, where):
    _need(isinstance(value, bool), where, "must be true or false")


def _or_null(value, where):
    _text(value, where, blank=True)


# The fields of a definition.
_SELECTION = _record(dataset_role=_one_of(ROLES), method=_text, source=_text, details=_list(_text))
_SAID = {"dataset_roles": _list(_one_of(ROLES), 1, True), "reasons": _list(_text, 1), "proposed_by": _list(_text, 1), "sequence_selection": _list(_SELECTION)}
_GROUP = _record(name=_text, required=_yes_no, **_SAID)
_TARGET = _record(name=_text, taxid=_taxid, mode=_one_of(MODES), subtype=_or_null, groups=_list(_GROUP, 1))
_NON_TARGET = _record(name=_text, taxid=_taxid, criticality=_one_of(CRITICALITIES), **_SAID)
_CONTEXT = _record(syndrome=_or_null, geography=_or_null, sample_type=_or_null, vector=_or_null)
_DEFINITION = _record(target=_TARGET, non_targets=_list(_NON_TARGET), diagnostic_context=_CONTEXT)


def check_definition(definition: dict) -> dict:
    """A definition whose fields, and what they ask of each other, all hold."""
    _DEFINITION(definition, "panel")
    target, others = definition["target"], definition["non_targets"]
    _need((target["subtype"] is not None) == (target["mode"] == "subtype_specific"), "panel.target.subtype", "goes with mode subtype_specific only")
    folded = [x["name"].strip().casefold() for x in others]
    groups = [x["name"].strip().casefold() for x in target["groups"]]
    ids = [x["taxid"] for x in [target, *others] if x["taxid"] is not None]
    _need(len(set(groups)) == len(groups), "panel.target.groups", "must have unique names")
    _need(len(set(folded)) == len(folded), "panel.non_targets", "must have unique names")
    _need(target["name"].strip().casefold() not in folded, "panel.non_targets", "must not name the target")
    _need(len(set(ids)) == len(ids), "panel", "must have unique TaxIDs")
    return definition


def _headed(raw, fields: tuple[str, ...], status: str, where: str) -> dict:
    _need(isinstance(raw, dict) and set(raw) == set(fields), where, f"must have exactly the fields {', '.join(fields)}")
    version = raw["schema_version"]
    _need(version == 1 and not isinstance(version, bool), where, "must have schema_version 1")
    _need(raw["status"] == status, where, f"must have status {status}")
    check_definition(raw["definition"])
    return raw


def definition_of(target: str, non_targets: list[dict], proposed_by: str = "manual") -> dict:
    """A plain definition: a broadly detected target, and non-targets of (name, criticality, roles)."""
    said = lambda roles, reason: {"dataset_roles": list(roles), "reasons": [reason], "proposed_by": [proposed_by], "sequence_selection": []}
    group = {"name": "broad target diversity", "required": True} | said(["DESIGN"], "broad_detection_target")
    others = [{"name": x["name"], "taxid": x.get("taxid"), "criticality": x["criticality"]} | said(x["roles"], x.get("reason", "researcher_selected")) for x in non_targets]
    context = dict.fromkeys(("syndrome", "geography", "sample_type", "vector"))
    return {"target": {"name": target, "taxid": None, "mode": "broad_detection", "subtype": None, "groups": [group]}, "non_targets": others, "diagnostic_context": context}


def write_proposal(path: str, definition: dict) -> dict:
    """A proposal as YAML (JSON without PyYAML, which is YAML too); nothing runs on it before it is approved."""
    proposal = {"schema_version": 1, "status": "PROPOSED", "definition": check_definition(definition)}
    try:
        import yaml
    except ImportError:
        write_json(Path(path), proposal)
    else:
        _replace(Path(path), yaml.safe_dump(json.loads(json.dumps(proposal)), sort_keys=False, allow_unicode=True))
    return proposal


def propose(path: str, target: str, non_targets: list[dict]) -> dict:
    return write_proposal(path, definition_of(target, non_targets))


def load_proposal(path: str) -> dict:
    from strandweave.plans.config import read_mapping

    return _headed(read_mapping(Path(path).read_text(encoding="utf-8")), PROPOSAL, "PROPOSED", "panel proposal")


def approve(proposal_path: str, manifest_path: str) -> dict:
    """Freeze a proposal as it is, with the hash of its meaning."""
    proposal = load_proposal(proposal_path)
    text = json.dumps(proposal, sort_keys=True, separators=(",", ":"), ensure_ascii=False) + "\n"
    digest = "sha256:" + hashlib.sha256(text.encode()).hexdigest()
    manifest = {"schema_version": 1, "status": "APPROVED", "approved_by_user": True, "proposal_sha256": digest, "definition": proposal["definition"]}
    _replace(Path(manifest_path), json.dumps(manifest, indent=2, sort_keys=True, ensure_ascii=False) + "\n")
    return manifest


def approved(path: str) -> dict:
    """An approved manifest, checked."""
    raw = _headed(json.loads(Path(path).read_text(encoding="utf-8")), APPROVED, "APPROVED", "approved panel")
    _need(raw["approved_by_user"] is True, "approved panel", "must be approved by a user")
    _need(isinstance(raw["proposal_sha256"], str) and re.fullmatch(r"sha256:[0-9a-f]{64}", raw["proposal_sha256"]) is not None, "approved panel", "must name its proposal's hash")
    return raw


def load_manifest(path: str) -> tuple[str, list[NonTarget]]:
    """Target name and non-targets of an approved manifest, in order."""
    definition = approved(path)["definition"]
    return definition["target"]["name"], [NonTarget(x["name"], x["criticality"], tuple(x["dataset_roles"])) for x in definition["non_targets"]]


def preflight(panel, folder: str, target: str | None = None) -> dict:
    """READY with a frozen manifest, which is copied beside the results, ACTION_REQUIRED with a
    proposal only, which is written out for review, LEGACY without a panel. ``target`` must be the
    panel's own."""
    if panel is None:
        return {"status": "LEGACY"}
    frozen = approved(panel.frozen_manifest) if panel.frozen_manifest else None
    definition = check_definition(panel.proposal) if frozen is None else frozen["definition"]
    if target is not None:
        _need(definition["target"]["name"].strip() == target.strip(), f"panel target {definition['target']['name']!r}", f"is not the run's target {target!r}")
    if frozen is None:
        path = Path(folder) / "panel_proposal.yaml"
        write_proposal(str(path), definition)
        return {"status": "ACTION_REQUIRED", "proposal": str(path)}
    copy = Path(folder) / "panel" / "approved_panel.json"
    _replace(copy, json.dumps(frozen, indent=2, sort_keys=True, ensure_ascii=False) + "\n")
    return {"status": "READY", "manifest": panel.frozen_manifest, "copy": str(copy)}


def bind_challenges(panel: DataFrame, datasets: DataFrame) -> DataFrame:
    """Challenge entries of (name, criticality, roles, panel_ordinal) with their datasets, by name
    without case and outer blanks. An entry without a dataset fails the query."""
    key = lambda c: F.lower(F.btrim(F.col(c)))
    wanted = panel.where(F.array_contains("roles", "CHALLENGE")).withColumn("_key", key("name"))
    rows = wanted.join(datasets.withColumn("_key", key("dataset")), "_key", "left")
    found = F.when(F.col("dataset").isNotNull(), F.col("dataset")).otherwise(F.raise_error(F.concat(F.lit("no dataset for panel entry "), F.col("name"))).cast("string"))
    return rows.withColumn("dataset", found).drop("_key")
