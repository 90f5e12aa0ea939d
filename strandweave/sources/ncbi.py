"""Records from a remote archive by query or accession, kept as a frozen dataset that can be resumed.

Only the driver talks to an archive, through a client that may be injected; ``EntrezClient`` speaks
to the public E-utilities. Records are GenBank text, so features and annotations are kept.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import time
import urllib.error
import urllib.parse
import urllib.request
from datetime import datetime, timedelta, timezone
from pathlib import Path
from typing import Protocol

from strandweave.plans.config import ConfigError, NcbiInputConfig

# Limits, file names and fields of the published dataset format.
PAGE, LONGEST_PAUSE, SCHEMA = 10_000, 16, 1
MANIFEST, RECORDS, BATCHES, BATCH = "dataset_manifest.json", "records.gb", "batches", "batch-{:05d}.gb"
FIELDS = ("schema_version", "status", "source", "batch_size", "retries", "resolved_entries", "completed_batches", "consolidated", "created_at", "updated_at", "tool")
QUERY_SOURCE = ("mode", "database", "query", "resolved_uids", "reported_count", "selected_count", "max_records", "query_translation")
ACCESSION_SOURCE = ("mode", "database", "requested_accessions")
ENTRY = ("requested_accession", "uid", "accession", "accession_version")
BATCH_FIELDS = ("filename", "requested_identifiers", "record_count", "byte_size", "sha256", "record_ids", "resolved_entries")
CONSOLIDATED = ("filename", "record_count", "byte_size", "sha256")
TOOL = "strandweave"


class Client(Protocol):
    def search(self, query: str, start: int, size: int) -> tuple[int, list[str], str]:
        """(number of matches, ids of this page, the query as it was understood)."""

    def fetch(self, ids: list[str], kind: str) -> list[tuple[str, str]]:
        """(id asked for, GenBank record) of uids or accessions, in any order."""


def strip_version(accession: str) -> str:
    return re.sub(r"\.\d+$", "", accession)


def split_records(text: str) -> list[str]:
    """GenBank records of a text, each with its end line."""
    return [r.lstrip("\r\n") + "//\n" for r in re.split(r"(?m)^//[ \t]*\r?\n?", text) if r.strip()]


def record_id(record: str) -> str:
    """accession.version of a GenBank record, or its accession where it has no version."""
    for name in ("VERSION", "ACCESSION", "LOCUS"):
        if m := re.search(rf"(?m)^{name}[ \t]+(\S+)", record):
            return m.group(1)
    raise ValueError("a record has no id")


def by_accession(ids: list[str], records: list[str]) -> list[tuple[str, str]]:
    """Records with the accession, with or without version, that asked for each; none may be left over."""
    out: dict[str, str] = {}
    for record in records:
        own = record_id(record)
        asked = next((x for x in (own, strip_version(own)) if x in ids and x not in out), None)
        if asked is None:
            raise ValueError("the answer's accessions are not those asked for")
        out[asked] = record
    if set(out) != set(ids):
        raise ValueError("the answer's accessions are not those asked for")
    return list(out.items())


class EntrezClient:
    """The public E-utilities over HTTPS. The address and key of the caller come from the environment
    (NCBI_EMAIL, NCBI_API_KEY), as the service asks for, and are never shown or written."""

    BASE = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils/"

    def __init__(self, email: str | None = None, api_key: str | None = None, opener=urllib.request.urlopen):
        self._email = (email or os.environ.get("NCBI_EMAIL", "")).strip()
        self._key = (api_key or os.environ.get("NCBI_API_KEY", "")).strip()
        self._open = opener
        if not self._email:
            raise ValueError("NCBI_EMAIL must be set to reach the archive")

    def __repr__(self) -> str:
        return "EntrezClient()"

    def _ask(self, tool: str, **asked) -> bytes:
        values = {"db": "nuccore", "tool": TOOL, "email": self._email} | ({"api_key": self._key} if self._key else {}) | asked
        try:
            with self._open(self.BASE + tool, urllib.parse.urlencode(values).encode(), timeout=120) as answer:
                return answer.read()
        except urllib.error.HTTPError as error:  # its text may hold what was sent
            raise urllib.error.HTTPError(tool, error.code, "the archive refused a request", None, None) from None

    def search(self, query, start, size):
        answer = json.loads(self._ask("esearch.fcgi", term=query, retstart=start, retmax=size, retmode="json"))["esearchresult"]
        return int(answer["count"]), list(answer["idlist"]), str(answer.get("querytranslation", ""))

    def fetch(self, ids, kind):
        records = split_records(self._ask("efetch.fcgi", id=",".join(ids), rettype="gb", retmode="text").decode())
        if len(records) != len(ids):
            raise ValueError("a batch must hold one record for each id")
        # uids come back in the order asked for; a record doesn't name its own
        return list(zip(ids, records, strict=True)) if kind == "uid" else by_accession(ids, records)


def transient(error: Exception) -> bool:
    if isinstance(error, urllib.error.HTTPError):
        return error.code == 429 or 500 <= error.code <= 599
    return isinstance(error, (urllib.error.URLError, TimeoutError, OSError))


def with_retries(call, retries: int, sleep=time.sleep):
    """``call()``, again after 1, 2, 4, ... seconds (16 at most) where it failed for a passing reason."""
    for i in range(retries + 1):
        try:
            return call()
        except Exception as error:
            if i == retries or not transient(error):
                raise
            sleep(min(2**i, LONGEST_PAUSE))


def resolve(client: Client, config: NcbiInputConfig, sleep=time.sleep) -> dict:
    """The source of a dataset: the accessions asked for, or the ids of a query in order, page by
    page; pages must agree on the total and the query's meaning and not repeat ids."""
    if config.query is None:
        if len(set(config.accessions)) != len(config.accessions) or not config.accessions:
            raise ConfigError("accessions must be unique")
        return {"mode": "accessions", "database": "nuccore", "requested_accessions": list(config.accessions)}
    ids: list[str] = []
    total = meaning = None
    while total is None or len(ids) < min(total, config.max_records or total):
        room = min(PAGE, (config.max_records or len(ids) + PAGE) - len(ids))
        count, page, said = with_retries(lambda room=room: client.search(config.query, len(ids), room), config.retries, sleep)
        if total is not None and (count, said) != (total, meaning):
            raise ValueError("the matches changed between pages")
        total, meaning = count, said
        if not page and len(ids) < min(total, config.max_records or total):
            raise ValueError("an empty page before the end of the matches")
        ids += page
    if len(set(ids)) != len(ids) or len(ids) != min(total, config.max_records or total):
        raise ValueError("pages repeat an id or hold too many")
    return {
        "mode": "query", "database": "nuccore", "query": config.query, "resolved_uids": ids, "reported_count": total, "selected_count": len(ids),
        "max_records": config.max_records, "query_translation": meaning,
    }


def _write(path: Path, text: str) -> None:
    part = path.with_name(path.name + ".part")
    part.write_bytes(text.encode())
    os.replace(part, path)


def _sha(path: Path) -> str:
    digest = hashlib.sha256()
    with path.open("rb") as f:
        while block := f.read(1 << 20):
            digest.update(block)
    return digest.hexdigest()


def _planned(source: dict, size: int) -> tuple[str, list[list[str]]]:
    kind = "uid" if source["mode"] == "query" else "accession"
    ids = source["resolved_uids" if kind == "uid" else "requested_accessions"]
    return kind, [ids[i : i + size] for i in range(0, len(ids), size)]


def _entry(kind: str, asked: str, own: str) -> dict:
    return {"requested_accession": asked if kind == "accession" else None, "uid": asked if kind == "uid" else None, "accession": strip_version(own), "accession_version": own}


def _batch_holds(root: Path, i: int, some: list[str], kind: str, told) -> bool:
    try:
        _check_batch(root, i, some, kind, told)
    except (ValueError, OSError):
        return False
    return True


def acquire(config: NcbiInputConfig, folder: str, client: Client | None = None, sleep=time.sleep, clock=lambda: datetime.now(timezone.utc).isoformat()) -> dict:
    """Fetch a dataset in batches, or go on with one: a batch on disk that is as its manifest says is
    used again. Records are kept in the order asked for, whatever order they came in. The manifest is
    complete only once the joined records are written, and is then checked as any frozen dataset."""
    if config.frozen_dataset is not None:
        raise ConfigError("a frozen dataset isn't acquired")
    client = client or EntrezClient()
    root = Path(folder)
    (root / BATCHES).mkdir(parents=True, exist_ok=True)
    path = root / MANIFEST
    if path.exists():
        manifest = _exact(json.loads(path.read_text(encoding="utf-8")), FIELDS, "manifest")
        source = manifest["source"]
        same = (source.get("query"), source.get("max_records")) == (config.query, config.max_records) if config.query is not None else source.get("requested_accessions") == list(config.accessions)
        if not same or (manifest["batch_size"], manifest["retries"]) != (config.batch_size, config.retries):
            raise ValueError("the folder holds another dataset")
    else:
        now = clock()
        manifest = {
            "schema_version": SCHEMA, "status": "PARTIAL", "source": resolve(client, config, sleep), "batch_size": config.batch_size, "retries": config.retries,
            "resolved_entries": [], "completed_batches": [], "consolidated": None, "created_at": now, "updated_at": now, "tool": TOOL,
        }
        _write(path, json.dumps(manifest, indent=2, sort_keys=True))
    kind, batches = _planned(manifest["source"], config.batch_size)
    told = {b["filename"]: b for b in manifest["completed_batches"]}
    done: list[dict] = []
    for i, some in enumerate(batches):
        name = BATCH.format(i)
        if not (name in told and _batch_holds(root, i, some, kind, told[name])):
            got = dict(with_retries(lambda some=some: client.fetch(some, kind), config.retries, sleep))
            if set(got) != set(some):
                raise ValueError("a batch must hold one record for each id")
            text = "".join(got[x] if got[x].endswith("\n") else got[x] + "\n" for x in some)
            _write(root / BATCHES / name, text)
            ids = [record_id(got[x]) for x in some]
            told[name] = {
                "filename": name, "requested_identifiers": some, "record_count": len(some), "byte_size": len(text.encode()), "sha256": _sha(root / BATCHES / name),
                "record_ids": ids, "resolved_entries": [_entry(kind, x, own) for x, own in zip(some, ids, strict=True)],
            }
        done.append(told[name])
        entries = [e for b in done for e in b["resolved_entries"]]
        manifest |= {"status": "PARTIAL", "completed_batches": done, "resolved_entries": entries, "consolidated": None, "updated_at": clock()}
        _write(path, json.dumps(manifest, indent=2, sort_keys=True))
    part = root / (RECORDS + ".part")
    with part.open("wb") as out:
        for i in range(len(batches)):
            out.write((root / BATCHES / BATCH.format(i)).read_bytes())
    os.replace(part, root / RECORDS)
    joined = {"filename": RECORDS, "record_count": sum(map(len, batches)), "byte_size": (root / RECORDS).stat().st_size, "sha256": _sha(root / RECORDS)}
    manifest |= {"status": "COMPLETE", "consolidated": joined, "updated_at": clock()}
    _write(path, json.dumps(manifest, indent=2, sort_keys=True))
    return validate_frozen(folder)


def _fail(where: str, said: str):
    raise ValueError(f"dataset manifest field {where!r} {said}")


def _exact(value, expected: tuple[str, ...], where: str) -> dict:
    if not isinstance(value, dict):
        _fail(where, "must be an object")
    if extra := sorted(set(value) - set(expected)):
        _fail(where, f"has unknown fields: {', '.join(extra)}")
    if missing := sorted(set(expected) - set(value)):
        _fail(where, f"lacks: {', '.join(missing)}")
    return value


def _number(value, where: str, low: int, high: float = float("inf")) -> int:
    if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
        _fail(where, f"must be an integer from {low} to {high}")
    return value


def _strings(value, where: str, empty: bool = False) -> list[str]:
    if not isinstance(value, list) or not (value or empty) or any(not isinstance(x, str) or not x.strip() for x in value) or len(set(value)) != len(value):
        _fail(where, "must be a list of unique non-blank strings")
    return value


def _time(value, where: str) -> None:
    try:
        fine = datetime.fromisoformat(value).utcoffset() == timedelta(0)
    except (TypeError, ValueError):
        fine = False
    if not fine:
        _fail(where, "must be a UTC time")


def _check_source(source) -> None:
    mode = source.get("mode") if isinstance(source, dict) else None
    if mode == "accessions":
        _exact(source, ACCESSION_SOURCE, "source")
        _strings(source["requested_accessions"], "source.requested_accessions")
    elif mode == "query":
        _exact(source, QUERY_SOURCE, "source")
        if not isinstance(source["query"], str) or not source["query"].strip():
            _fail("source.query", "must be a non-blank string")
        if not isinstance(source["query_translation"], str):
            _fail("source.query_translation", "must be a string")
        ids = _strings(source["resolved_uids"], "source.resolved_uids", empty=True)
        total, most = _number(source["reported_count"], "source.reported_count", 0), source["max_records"]
        if most is not None:
            _number(most, "source.max_records", 1)
        if _number(source["selected_count"], "source.selected_count", 0) != len(ids) or len(ids) != min(total, most or total):
            _fail("source.selected_count", "does not match the ids")
    else:
        _fail("source.mode", "must be query or accessions")
    if source["database"] != "nuccore":
        _fail("source.database", "must be nuccore")


def _check_entries(entries, ids: list[str], kind: str, where: str) -> list[str]:
    if not isinstance(entries, list) or len(entries) != len(ids):
        _fail(where, "does not match the source")
    for i, (e, asked) in enumerate(zip(entries, ids, strict=True)):
        at = f"{where}[{i}]"
        _exact(e, ENTRY, at)
        own = e["accession_version"]
        if not isinstance(own, str) or not own.strip() or e["accession"] != strip_version(own):
            _fail(f"{at}.accession", "does not match accession_version")
        if e != _entry(kind, asked, own) or (kind == "accession" and asked not in (own, e["accession"])):
            _fail(at, "does not match the source")
    return _strings([e["accession_version"] for e in entries], f"{where}[*].accession_version", empty=True)


def _check_file(path: Path, told: dict, where: str) -> list[str]:
    """Ids of the records of a file that has the size, hash and number of records it should have."""
    _number(told["byte_size"], f"{where}.byte_size", 0)
    if not isinstance(told["sha256"], str) or not re.fullmatch("[0-9a-f]{64}", told["sha256"]):
        _fail(f"{where}.sha256", "must be a lower-case SHA-256")
    if not path.is_file():
        raise ValueError(f"dataset file {path.name!r} is missing")
    if path.stat().st_size != told["byte_size"]:
        _fail(f"{where}.byte_size", f"does not match {path.name!r}")
    if _sha(path) != told["sha256"]:
        _fail(f"{where}.sha256", f"does not match {path.name!r}, which was changed")
    ids = []
    with path.open(encoding="utf-8") as f:  # line by line: a dataset may be large
        own = None
        for line in f:
            if line.startswith(("LOCUS", "ACCESSION", "VERSION")) and len(line.split()) > 1 and not line.startswith("LOCUS" if own else "\0"):
                own = line.split()[1]
            elif line.startswith("//") and own:
                ids.append(own)
                own = None
    if len(ids) != _number(told["record_count"], f"{where}.record_count", 0):
        _fail(f"{where}.record_count", f"does not match {path.name!r}")
    return ids


def _check_batch(root: Path, i: int, some: list[str], kind: str, told) -> None:
    where, name = f"completed_batches[{i}]", BATCH.format(i)
    _exact(told, BATCH_FIELDS, where)
    if told["filename"] != name or told["requested_identifiers"] != some or told["record_count"] != len(some):
        _fail(where, "does not match the source")
    own = _check_entries(told["resolved_entries"], some, kind, f"{where}.resolved_entries")
    if told["record_ids"] != own:
        _fail(f"{where}.record_ids", "does not match its entries")
    if _check_file(root / BATCHES / name, told, where) != own:
        _fail(f"{where}.record_ids", f"does not match {name!r}")


def validate_frozen(folder: str) -> dict:
    """The manifest of a complete dataset whose fields, hashes, records and their order all hold."""
    root = Path(folder)
    if not (root / MANIFEST).is_file():
        raise ValueError("dataset manifest is missing")
    try:
        raw = json.loads((root / MANIFEST).read_text(encoding="utf-8"))
    except ValueError:
        raise ValueError("dataset manifest is not JSON") from None
    m = _exact(raw, FIELDS, "manifest")
    if _number(m["schema_version"], "schema_version", 0) != SCHEMA:
        _fail("schema_version", "is not supported")
    if m["status"] != "COMPLETE":
        _fail("status", "must be COMPLETE")
    if not isinstance(m["tool"], str) or not m["tool"].strip():
        _fail("tool", "must be a non-blank string")
    _time(m["created_at"], "created_at")
    _time(m["updated_at"], "updated_at")
    _number(m["batch_size"], "batch_size", 1, 500)
    _number(m["retries"], "retries", 0, 10)
    _check_source(m["source"])
    kind, batches = _planned(m["source"], m["batch_size"])
    ids = [x for some in batches for x in some]
    own = _check_entries(m["resolved_entries"], ids, kind, "resolved_entries")
    if not isinstance(m["completed_batches"], list) or len(m["completed_batches"]) != len(batches):
        _fail("completed_batches", "does not cover the source")
    for i, some in enumerate(batches):
        _check_batch(root, i, some, kind, m["completed_batches"][i])
    if [e for b in m["completed_batches"] for e in b["resolved_entries"]] != m["resolved_entries"]:
        _fail("resolved_entries", "does not match the batches")
    joined = _exact(m["consolidated"], CONSOLIDATED, "consolidated")
    if joined["filename"] != RECORDS or joined["record_count"] != len(ids):
        _fail("consolidated", "does not match the source")
    if _check_file(root / RECORDS, joined, "consolidated") != own:
        _fail("resolved_entries[*].accession_version", f"does not match the order of {RECORDS!r}")
    return m
