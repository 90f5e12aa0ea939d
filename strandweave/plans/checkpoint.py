"""Checkpoints of stages: a manifest of fingerprints on the driver, the state as Parquet.

A checkpoint holds for a request with the same inputs, parameters, software and dependencies, as
long as its state and outputs have the bytes they had. The first check that fails says why not.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass
from pathlib import Path

import pyarrow as pa

from strandweave.sources.panel import canonical_sha256, write_json

# Fixed values, in the order they are looked for.
PROBLEMS = (
    "MISSING_MANIFEST", "INVALID_MANIFEST", "NON_COMPLETE_STATUS", "FINGERPRINT_MISMATCH", "MISSING_STATE", "STATE_HASH_MISMATCH", "INVALID_STATE", "MISSING_OUTPUT",
    "OUTPUT_HASH_MISMATCH", "RESULT_FINGERPRINT_MISMATCH",
)


#: Folders of so many files or more are hashed in tasks.
DISTRIBUTED = 64


@dataclass(frozen=True)
class Request:
    stage: str
    dependencies: dict
    inputs: dict
    parameters: dict
    software: dict
    tools: dict

    @property
    def fingerprint(self) -> str:
        return canonical_sha256(asdict(self))


def file_sha256(path: str | Path) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def tree_sha256(path: Path, spark=None) -> str:
    """Hash of a file, or of the data files below a folder by name; with ``spark`` many files are read
    in tasks, which see the run's folder, and only their hashes come to the driver."""
    if path.is_file():
        return file_sha256(path)
    files = sorted(p for p in path.rglob("*") if p.is_file() and p.suffix != ".crc" and p.name != "_SUCCESS")
    names = [p.relative_to(path).as_posix() for p in files]
    if spark is None or len(files) < DISTRIBUTED:
        return canonical_sha256([[n, file_sha256(p)] for n, p in zip(names, files, strict=True)])
    root = str(path.resolve())

    def run(batches):
        for batch in batches:
            yield pa.record_batch([batch.column(0), pa.array([file_sha256(f"{root}/{n}") for n in batch.column(0).to_pylist()])], names=["name", "sha"])

    rows = spark.createDataFrame([(n,) for n in names], "name string").repartition(min(len(names), 2 * spark.sparkContext.defaultParallelism))
    told = {r.name: r.sha for r in rows.mapInArrow(run, "name string, sha string").collect()}
    return canonical_sha256([[n, told[n]] for n in names])


class Checkpoints:
    def __init__(self, folder: str, spark=None):
        self.root, self.spark = Path(folder), spark

    def manifest_path(self, stage: str) -> Path:
        return self.root / ".checkpoints" / stage / "manifest.json"

    def state_path(self, stage: str) -> Path:
        return self.root / ".checkpoints" / stage / "state"

    def _write(self, request: Request, **more) -> dict:
        manifest = {"schema_version": 1, "stage": request.stage, "fingerprint": request.fingerprint, "request": asdict(request)} | more
        write_json(self.manifest_path(request.stage), manifest)
        return manifest

    def begin(self, request: Request) -> dict:
        return self._write(request, status="RUNNING")

    def fail(self, request: Request, error: Exception) -> dict:
        return self._write(request, status="FAILED", error={"type": type(error).__name__, "message": str(error)[:1000]})

    def complete(self, request: Request, outputs: list[str] = ()) -> dict:
        state = tree_sha256(self.state_path(request.stage), self.spark)
        listed = [{"path": p, "sha256": tree_sha256(self.root / p)} for p in sorted(outputs)]
        result = canonical_sha256({"fingerprint": request.fingerprint, "state_sha256": state, "outputs": listed})
        return self._write(request, status="COMPLETE", state_sha256=state, outputs=listed, result_fingerprint=result)

    def problem(self, request: Request) -> str | None:
        """Why the stage's checkpoint doesn't hold for the request; None where it does."""
        path, state = self.manifest_path(request.stage), self.state_path(request.stage)
        if not path.is_file():
            return "MISSING_MANIFEST"
        try:
            m = json.loads(path.read_text(encoding="utf-8"))
            status, fingerprint = m["status"], m["fingerprint"]
        except (ValueError, KeyError, TypeError):
            return "INVALID_MANIFEST"
        if status != "COMPLETE":
            return "NON_COMPLETE_STATUS"
        if fingerprint != request.fingerprint:
            return "FINGERPRINT_MISMATCH"
        if not state.exists():
            return "MISSING_STATE"
        if tree_sha256(state, self.spark) != m.get("state_sha256"):
            return "STATE_HASH_MISMATCH"
        if state.is_dir() and not any(state.rglob("*.parquet")):
            return "INVALID_STATE"
        for o in m.get("outputs", []):
            if not (self.root / o["path"]).exists():
                return "MISSING_OUTPUT"
            if tree_sha256(self.root / o["path"]) != o["sha256"]:
                return "OUTPUT_HASH_MISMATCH"
        if m.get("result_fingerprint") != canonical_sha256({"fingerprint": fingerprint, "state_sha256": m["state_sha256"], "outputs": m.get("outputs", [])}):
            return "RESULT_FINGERPRINT_MISMATCH"
        return None

    def result_fingerprint(self, stage: str) -> str | None:
        path = self.manifest_path(stage)
        return json.loads(path.read_text(encoding="utf-8")).get("result_fingerprint") if path.is_file() else None
