"""Matching oligos to sequences: one vectorised scan behind inclusivity and specificity.

Sequences are scanned where they lie: the oligos, whose number is checked, go to every task and no
sequence moves. Bases are bit masks, so a site's mismatches are the places where the target has a
base that the oligo lacks. Both orientations are scanned; a reverse primer is compared with the
reverse complement of its target, which is the same as its own reverse complement with the target.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions.iupac import CODES, PAIRED
from strandweave.plans.config import InclusivityConfig, SpecificityConfig

ROLES = ("FORWARD", "PROBE", "REVERSE")
ORIENTATIONS = ("FORWARD", "REVERSE_COMPLEMENT")
#: Oligos sent to every task at once; more are scanned in turns.
MAX_OLIGOS = 3_000
#: Longer sequences are scanned in parts that overlap by the longest oligo.
PART = 4_000_000

#: Letters of sequences that are scanned together, and the mask that parts them, which no oligo covers.
TOGETHER, BETWEEN = 1 << 18, 16
_MASK = np.zeros(256, np.uint8)
_MASK[0] = BETWEEN
_BACK = np.zeros(BETWEEN + 1, np.uint8)
_BACK[BETWEEN] = BETWEEN
for _i, _c in enumerate(CODES, 1):
    _MASK[ord(_c)] = _MASK[ord(_c.lower())] = _i
_BACK[1:BETWEEN] = [CODES.index(c) + 1 for c in PAIRED]


def to_masks(seq: str | bytes) -> np.ndarray:
    return _MASK[np.frombuffer(seq.encode() if isinstance(seq, str) else seq, np.uint8)]


def reverse_masks(masks: np.ndarray) -> np.ndarray:
    return _BACK[masks[::-1]]


@dataclass(frozen=True)
class Oligo:
    assay_id: str
    role: str
    sequence: str
    reference_start: int = 0
    reference_end: int = 0

    @property
    def pattern(self) -> np.ndarray:
        """Masks in the target's direction."""
        own = to_masks(self.sequence)
        return reverse_masks(own) if self.role == "REVERSE" else own


def mismatch_rows(target: np.ndarray, starts: np.ndarray, pattern: np.ndarray, role: str) -> np.ndarray:
    """A boolean row per start: mismatches by place in the oligo, 5' first."""
    rows = (target[starts[:, None] + np.arange(len(pattern))] & ~pattern) != 0
    return rows[:, ::-1] if role == "REVERSE" else rows


def compatible_starts(target: np.ndarray, pattern: np.ndarray, role: str, cap: int, protected: int) -> np.ndarray:
    """0-based starts with at most ``cap`` mismatches, none in the oligo's last ``protected`` bases."""
    k, n = len(pattern), len(target) - len(pattern) + 1
    if n < 1 or not k:
        return np.empty(0, np.int64)
    order = list(range(k)) if role == "REVERSE" else list(range(k - 1, -1, -1))  # from the 3' end
    must, may = order[: min(protected, k)], order[min(protected, k) :]
    alive = np.ones(n, bool)
    for p in must:
        alive &= (target[p : p + n] & ~pattern[p]) == 0
    bad = np.zeros(n, np.uint8)
    if not must:
        for p in may[: cap + 4]:
            bad += (target[p : p + n] & ~pattern[p]) != 0
        alive, may = bad <= cap, may[cap + 4 :]
    at = np.flatnonzero(alive)
    bad = bad[at]
    for p in may:  # few sites are left by now
        bad = bad + ((target[at + p] & ~pattern[p]) != 0)
        keep = bad <= cap
        if not keep.all():
            at, bad = at[keep], bad[keep]
    return at


HITS = pa.schema(
    [("assay_id", pa.string()), ("role", pa.string()), ("orientation", pa.string()), ("oriented_start", pa.int64()), ("oriented_end", pa.int64()), ("source_start", pa.int64()), ("source_end", pa.int64())]
    + [("mismatch_positions", pa.list_(pa.int32())), ("mismatch_count", pa.int32()), ("exact_match", pa.bool_()), ("three_prime_mismatch", pa.bool_())]
)
HITS_DDL = (
    "assay_id string, role string, orientation string, oriented_start long, oriented_end long, source_start long, source_end long, "
    "mismatch_positions array<int>, mismatch_count int, exact_match boolean, three_prime_mismatch boolean"
)


def scan_compatible(sequences: DataFrame, oligos: list[Oligo], config: SpecificityConfig, keys: list[str]) -> DataFrame:
    """Every compatible site of every oligo in (keys..., sequence): exhaustive, without any cap."""
    if not oligos:
        return sequences.sparkSession.createDataFrame([], sequences.select(*keys).schema).select("*", *(F.lit(None).cast(t.partition(" ")[2]).alias(t.partition(" ")[0]) for t in HITS_DDL.split(", "))).limit(0)
    out = None
    for at in range(0, len(oligos), MAX_OLIGOS):
        part = _scan_part(sequences, oligos[at : at + MAX_OLIGOS], config, keys)
        out = part if out is None else out.unionByName(part)
    return out


def _scan_part(sequences: DataFrame, oligos: list[Oligo], config: SpecificityConfig, keys: list[str]) -> DataFrame:
    overlap = max(len(o.sequence) for o in oligos) - 1
    length = F.length("sequence")
    parts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(length / PART) - 1).cast("int"))
    rows = sequences.select(
        *keys, length.cast("long").alias("_length"), F.explode(parts).alias("_part"), F.col("sequence")
    ).select(*keys, "_length", (F.col("_part").cast("long") * PART).alias("_from"), F.upper(F.substr("sequence", F.col("_part") * PART + 1, F.lit(PART + overlap))).alias("_seq"))
    fields = {f.name: f for f in rows.schema}
    ddl = ", ".join(f"{k} {fields[k].dataType.simpleString()}" for k in keys)

    def scan(group, lengths, froms, prepared):
        """(row, hit...) of sequences laid end to end; a site belongs to the part where it starts."""
        sizes = np.array([len(seq) for _, seq in group])
        begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        target = to_masks("\x00".join(seq for _, seq in group))
        for orientation in ORIENTATIONS:
            flipped = orientation != "FORWARD"
            view = reverse_masks(target) if flipped else target
            for o, pattern in prepared:
                k, role = len(pattern), o.role
                primer = role != "PROBE"
                cap = config.max_primer_mismatches if primer else config.max_probe_mismatches
                protected = config.primer_3_prime_bases if primer and config.reject_primer_3_prime_mismatch else 0
                starts = compatible_starts(view, pattern, role, cap, protected)
                plain = len(target) - starts - k if flipped else starts
                which = np.searchsorted(begins, plain, side="right") - 1
                local = plain - begins[which]
                own = local + k <= sizes[which]  # not across two sequences
                own &= (local < PART) | (froms[which] + PART >= lengths[which])
                if not own.any():
                    continue
                bad = mismatch_rows(view, starts[own], pattern, role)
                source = local[own] + froms[which[own]] + 1
                oriented = lengths[which[own]] - (source + k - 1) + 1 if flipped else source
                for i, s, e, b in zip(which[own].tolist(), source.tolist(), oriented.tolist(), bad, strict=True):
                    places = (np.flatnonzero(b) + 1).tolist()
                    tail = primer and any(p > k - config.primer_3_prime_bases for p in places)
                    yield group[i][0], o.assay_id, role, orientation, e, e + k - 1, s, s + k - 1, places, len(places), not places, tail

    def run(batches):
        prepared = [(o, o.pattern) for o in oligos]
        n_keys = len(keys)
        for batch in batches:
            lengths, froms = (batch.column(n_keys + i).to_numpy(zero_copy_only=False) for i in range(2))
            seqs = batch.column(n_keys + 2)
            group, size = [], 0
            for row in range(batch.num_rows + 1):
                if row == batch.num_rows or size >= TOGETHER:
                    at = np.array([r for r, _ in group], np.int64)
                    found = list(scan(group, lengths[at], froms[at], prepared)) if group else []
                    if found:
                        columns = list(zip(*found, strict=True))
                        same = [batch.column(i).take(pa.array(columns[0])) for i in range(n_keys)]
                        yield pa.record_batch([*same, *(pa.array(list(c), f.type) for c, f in zip(columns[1:], HITS, strict=True))], names=[*keys, *HITS.names])
                    group, size = [], 0
                if row < batch.num_rows and (seq := seqs[row].as_py()):
                    group.append((row, seq))
                    size += len(seq) + 1

    return rows.mapInArrow(run, f"{ddl}, {HITS_DDL}")


def local_sites(target: np.ndarray, o: Oligo, config: InclusivityConfig) -> list[dict]:
    """Best sites of an oligo near its designed place in one oriented sequence, compatible or not."""
    pattern = o.pattern
    k, n = len(pattern), len(target)
    first = max(1, o.reference_start - config.search_flank)
    last = min(n - k + 1, min(n, o.reference_end + config.search_flank) - k + 1)
    if n < k or first > last:
        return []
    starts = np.arange(first - 1, last)
    bad = mismatch_rows(target, starts, pattern, o.role)
    count = bad.sum(axis=1)
    tail = bad[:, max(0, k - config.primer_3_prime_bases) :].sum(axis=1) if o.role != "PROBE" else np.zeros(len(bad), np.int64)
    away = np.abs(starts + 1 - o.reference_start)
    order = np.lexsort((starts, away, tail, count))[: config.max_hits_per_oligo]
    primer = o.role != "PROBE"
    cap = config.max_primer_mismatches if primer else config.max_probe_mismatches
    out = []
    for rank, i in enumerate(order.tolist(), 1):
        site = target[starts[i] : starts[i] + k]
        site = reverse_masks(site) if o.role == "REVERSE" else site
        fine = count[i] <= cap and not (primer and config.reject_primer_3_prime_mismatch and tail[i])
        out.append(
            {
                "hit_rank": rank, "oriented_start": int(starts[i]) + 1, "oriented_end": int(starts[i]) + k, "displacement": int(away[i]),
                "mismatch_positions": (np.flatnonzero(bad[i]) + 1).tolist(), "mismatch_count": int(count[i]), "tail": int(tail[i]), "compatible": bool(fine),
                "site": "".join(CODES[m - 1] for m in site.tolist()),
            }
        )
    return out
