"""Star alignment: every sequence against one reference, merged on the reference's positions; letters
inserted at one place are aligned among themselves."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions import iupac
from strandweave.operators.insertions import align_insertions
from strandweave.plans.storage import join_groups, materialize

OPEN, EXTEND, MATCH, MISMATCH = 3.0, 0.5, 1.0, -1.0
#: Length of the exact words that anchor long sequences, and letters between anchors aligned in full.
ANCHOR, FULL = 24, 2_000
#: Cells of the matrices that are held at once; larger alignments are halved until they fit.
CELLS = 16_000_000
_TABLE = str.maketrans(iupac.CODES, iupac.PAIRED)


def reverse_text(seq: str) -> str:
    return seq.translate(_TABLE)[::-1]


def choose_reference(sequences: DataFrame, explicit: str | None = None) -> tuple[str, str]:
    """(sequence_id, mode): the one asked for, else least ambiguous, then longest, then first."""
    if explicit is not None:
        if sequences.where(F.col("sequence_id") == explicit).isEmpty():
            raise ValueError(f"reference {explicit!r} is not among the sequences")
        return explicit, "explicit"
    return sequences.agg(reference_key().alias("id")).first().id, "automatic"


def reference_key():
    share = F.coalesce(iupac.ambiguous_fraction(F.col("sequence")), F.lit(0.0))
    return F.min_by("sequence_id", F.struct(share.alias("a"), (-F.length("sequence")).alias("n"), F.col("ordinal").alias("o")))


def global_path(a: str, b: str) -> tuple[float, list[tuple[int, int]]]:
    """Score and aligned runs (operation, length) of a global alignment; 0 both, 1 only a, 2 only b."""
    n, m = len(a), len(b)
    if not n or not m:
        return -(OPEN + EXTEND * (n + m)) if n or m else 0.0, ([(1, n)] if n else []) + ([(2, m)] if m else [])
    x, y = (np.frombuffer(s.encode(), np.uint8) for s in (a, b))
    far = -1e18
    slope = EXTEND * np.arange(m + 1)
    h = np.concatenate([[0.0], -OPEN - slope[1:]])
    down = np.full(m + 1, far)
    came, opened_down, opened_right = (np.zeros((n + 1, m + 1), np.uint8) for _ in range(3))
    came[0, 1:] = 2
    for i in range(1, n + 1):
        fresh = h - OPEN - EXTEND
        opened_down[i] = fresh >= down - EXTEND
        down = np.maximum(fresh, down - EXTEND)
        now = np.empty(m + 1)
        now[0] = down[0]
        now[1:] = h[:-1] + np.where(y == x[i - 1], MATCH, MISMATCH)
        came[i] = np.where(down > now, 1, 0)
        came[i, 0] = 1
        now = np.maximum(now, down)
        ahead = np.maximum.accumulate(now + slope)
        right = np.full(m + 1, far)
        right[1:] = ahead[:-1] - OPEN - slope[1:]
        opened_right[i, 1:] = now[:-1] - OPEN - EXTEND >= right[1:] - 1e-9
        came[i] = np.where(right > now, 2, came[i])
        h = np.maximum(now, right)
    out: list[list[int]] = []
    i, j = n, m

    def add(op, k=1):
        if out and out[-1][0] == op:
            out[-1][1] += k
        else:
            out.append([op, k])

    while i or j:
        if i and j and came[i, j] == 0:
            add(0)
            i, j = i - 1, j - 1
        elif j == 0 or (i and came[i, j] == 1):
            while i:
                stop = opened_down[i, j] or j == 0 and i == 1
                add(1)
                i -= 1
                if stop and j:
                    break
        else:
            while j:
                stop = opened_right[i, j] if i else False
                add(2)
                j -= 1
                if stop:
                    break
    return float(h[-1]), [(op, k) for op, k in reversed(out)]


def _last_row(a: str, b: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best scores of all of ``a`` against each beginning of ``b``: of any alignment, of those that end
    in letters of ``a`` alone, and how many letters of ``a`` come before that last run."""
    x, y = (np.frombuffer(s.encode(), np.uint8) for s in (a, b))
    m = len(y)
    slope = EXTEND * np.arange(m + 1)
    h = np.concatenate([[0.0], -OPEN - slope[1:]])
    down, before = np.full(m + 1, -1e18), np.zeros(m + 1, np.int64)
    for i in range(1, len(x) + 1):
        fresh, longer = h - OPEN - EXTEND, down - EXTEND
        new = fresh >= longer
        before = np.where(new, i - 1, before)
        down = np.where(new, fresh, longer)
        now = down.copy()
        now[1:] = np.maximum(now[1:], h[:-1] + np.where(y == x[i - 1], MATCH, MISMATCH))
        ahead = np.maximum.accumulate(now + slope)
        now[1:] = np.maximum(now[1:], ahead[:-1] - OPEN - slope[1:])
        h = now
    return h, down, before


def best_path(a: str, b: str) -> tuple[float, list[tuple[int, int]]]:
    """``global_path`` in memory of one row: long sequences are halved where the best alignment crosses
    the middle of ``a``, in a place or within a run of letters of ``a`` alone (Myers and Miller, 1988)."""
    n = len(a)
    if n < 2 or n * len(b) <= CELLS:
        return global_path(a, b)
    mid = n // 2
    h, down, before = _last_row(a[:mid], b)
    h2, down2, after = (r[::-1] for r in _last_row(a[mid:][::-1], b[::-1]))
    meet, run = h + h2, down + down2 + OPEN
    i, j = int(meet.argmax()), int(run.argmax())
    if meet[i] >= run[j]:
        score, parts = meet[i], [best_path(a[:mid], b[:i])[1], best_path(a[mid:], b[i:])[1]]
    else:
        first, last = int(before[j]), n - int(after[j])
        score, parts = run[j], [best_path(a[:first], b[:j])[1], [(1, last - first)], best_path(a[last:], b[j:])[1]]
    out: list[list[int]] = []
    for op, k in (x for part in parts for x in part):
        if out and out[-1][0] == op:
            out[-1][1] += k
        else:
            out.append([op, k])
    return float(score), [tuple(x) for x in out]


def anchors(a: str, b: str) -> list[tuple[int, int]]:
    """Places of words that occur once in each, in the longest run that grows in both."""
    def once(s):
        seen: dict[str, int] = {}
        for i in range(len(s) - ANCHOR + 1):
            w = s[i : i + ANCHOR]
            seen[w] = -1 if w in seen else i
        return seen

    ys = once(b)
    pairs = [(i, ys[w]) for w, i in sorted(once(a).items(), key=lambda x: x[1]) if i >= 0 and ys.get(w, -1) >= 0]
    from bisect import bisect_left

    tails, back, best = [], [-1] * len(pairs), []
    for k, (_, y) in enumerate(pairs):
        at = bisect_left(tails, y)
        back[k] = best[at - 1] if at else -1
        if at == len(tails):
            tails.append(y)
            best.append(k)
        else:
            tails[at], best[at] = y, k
    chain, k = [], best[-1] if best else -1
    while k >= 0:
        chain.append(pairs[k])
        k = back[k]
    return chain[::-1]


def align_pair(reference: str, seq: str) -> tuple[float, list[tuple[int, int]]]:
    """Alignment of two sequences; long ones are cut at anchors and joined between them."""
    if len(reference) * len(seq) <= FULL * FULL:
        return best_path(reference, seq)
    chain = anchors(reference, seq)
    if not chain:
        return best_path(reference, seq)
    total, path, x, y = 0.0, [], 0, 0
    for i, j in chain:
        if i < x or j < y:
            continue
        score, part = best_path(reference[x:i], seq[y:j])
        total += score + 1
        path += [*part, (0, 1)]
        x, y = i + 1, j + 1
    score, part = best_path(reference[x:], seq[y:])
    return total + score, [*path, *part]


def align_all(sequences: DataFrame, reference_id: str) -> DataFrame:
    """(ordinal, sequence_id, aligned_sequence, orientation) of (ordinal, sequence_id, sequence).

    Each sequence is aligned in the orientation that scores higher; the reference, one sequence sent
    to every task, never turns. What sequences have inserted before a reference position is aligned by
    merging profiles, each distinct text once.
    """
    reference = sequences.where(F.col("sequence_id") == reference_id).select(F.upper("sequence").alias("s")).first().s

    def run(batches):
        for batch in batches:
            ordinals, ids, turned, kept, inserted = [], [], [], [], []
            for row in batch.to_pylist():
                seq, orientation = row["sequence"], "FORWARD"
                score, path = align_pair(reference, seq)
                if row["sequence_id"] != reference_id:
                    other = reverse_text(seq)
                    score2, path2 = align_pair(reference, other)
                    if score2 > score:
                        seq, orientation, path = other, "REVERSE_COMPLEMENT", path2
                on_reference, extra, at, place = [], [], 0, 0
                for op, k in path:
                    if op == 0:
                        on_reference.append(seq[at : at + k])
                        at, place = at + k, place + k
                    elif op == 1:
                        on_reference.append("-" * k)
                        place += k
                    else:
                        text = seq[at : at + k]
                        extra.append((place, extra.pop()[1] + text if extra and extra[-1][0] == place else text))
                        at += k
                ordinals.append(row["ordinal"])
                ids.append(row["sequence_id"])
                turned.append(orientation)
                kept.append("".join(on_reference))
                inserted.append(extra)
            yield pa.record_batch(
                [pa.array(ordinals, pa.int64()), pa.array(ids, pa.string()), pa.array(turned, pa.string()), pa.array(kept, pa.string()),
                 pa.array([[{"place": p, "text": t} for p, t in x] for x in inserted], pa.list_(pa.struct([("place", pa.int32()), ("text", pa.string())])))],
                names=["ordinal", "sequence_id", "orientation", "on_reference", "inserted"],
            )

    slim = sequences.select(F.col("ordinal").cast("long").alias("ordinal"), "sequence_id", F.upper("sequence").alias("sequence"))
    rows = materialize(slim.mapInArrow(run, "ordinal long, sequence_id string, orientation string, on_reference string, inserted array<struct<place:int,text:string>>"), "aligned")
    inserted = materialize(rows.select("ordinal", F.inline("inserted")), "inserted")
    counted = inserted.groupBy("place", "text").agg(F.count(F.lit(1)).alias("n"))
    columns = materialize(align_insertions(counted).join(counted, ["place", "text"]).select(F.struct("place", "text").alias("at"), "aligned", "n"), "columns")
    widths = {r.place: r.width for r in columns.groupBy("at.place").agg(F.max(F.length("aligned")).alias("width")).collect()}  # at most the reference's places
    found = join_groups(inserted.select("ordinal", F.struct("place", "text").alias("at")), columns, "at", "n", inserted.count())
    own = found.groupBy("ordinal").agg(F.collect_list(F.struct("at.place", F.col("aligned").alias("text"))).alias("inserted"))

    @F.pandas_udf("string")
    def merged(on_reference, inserted):
        import pandas as pd

        out = []
        for text, extra in zip(on_reference, inserted, strict=True):
            own = {e["place"]: e["text"] for e in extra} if extra is not None else {}
            parts, at = [], 0
            for place in sorted(widths):
                parts += [text[at:place], own.get(place, "-" * widths[place])]
                at = place
            out.append("".join([*parts, text[at:]]))
        return pd.Series(out, dtype="object")

    whole = rows.drop("inserted").join(own, "ordinal", "left")
    return whole.select("ordinal", "sequence_id", merged("on_reference", "inserted").alias("aligned_sequence"), "orientation")


def problems(aligned: DataFrame, sequences: DataFrame, reference_id: str) -> DataFrame:
    """(problem, sequence_id) where an alignment isn't one of these sequences."""
    rows = aligned.join(sequences.select("sequence_id", F.upper("sequence").alias("s")), "sequence_id", "full_outer")
    plain = F.replace("aligned_sequence", F.lit("-"), F.lit(""))
    width = aligned.agg(F.max(F.length("aligned_sequence")).alias("w"))
    code = (
        F.when(F.col("aligned_sequence").isNull(), "NOT_ALIGNED").when(F.col("s").isNull(), "UNKNOWN_SEQUENCE")
        .when(F.length("aligned_sequence") != F.col("w"), "UNEQUAL_LENGTH").when(~F.col("aligned_sequence").rlike(f"^[{iupac.CODES}-]*$"), "INVALID_SYMBOL")
        .when((F.col("sequence_id") == reference_id) & (F.col("orientation") != "FORWARD"), "REFERENCE_TURNED")
        .when(plain != F.when(F.col("orientation") == "FORWARD", F.col("s")).otherwise(iupac.reverse_complement(F.col("s"))), "OTHER_SEQUENCE")
    )
    return rows.crossJoin(F.broadcast(width)).select(code.alias("problem"), "sequence_id").where("problem is not null")
