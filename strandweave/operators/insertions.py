"""Insertions at one place of a reference, aligned among themselves by merging profiles.

A profile counts the symbols of each column. Texts are merged one by one, longest first, into their
group's profile, by dynamic programming over expected scores of pairs, and then each is taken out and
merged again while that helps. A place with more texts than a group holds is done in levels: groups
of texts, then groups of the groups' profiles, until one profile is left; each level is a grouping in
Spark, so no place's texts meet in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions import iupac
from strandweave.plans.storage import join_groups, materialize

MATCH, MISMATCH, GAP = 1.0, -1.0, 1.0
#: Texts or profiles that are merged in one group, and rounds of taking each out and merging it again.
GROUP, ROUNDS = 256, 3
#: Symbols are numbered as the codes, the gap last.
SYMBOLS = iupac.CODES + "-"
_NUMBER = np.full(256, len(SYMBOLS) - 2, np.int64)
for _i, _c in enumerate(SYMBOLS):
    _NUMBER[ord(_c)] = _i


def profile_of(text: str, weight: int = 1) -> np.ndarray:
    """Columns by symbols: how many sequences have the symbol there."""
    out = np.zeros((len(text), len(SYMBOLS)), np.int64)
    out[np.arange(len(text)), _NUMBER[np.frombuffer(text.encode("latin-1"), np.uint8)]] = weight
    return out


def merge(a: np.ndarray, b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The best score of pairs between two profiles, and the column of each one's columns in the merged one."""
    n, m = len(a), len(b)
    x, y = a[:, :-1].astype(float), b[:, :-1].astype(float)
    la, lb = x.sum(axis=1), y.sum(axis=1)
    size_a, size_b = (float(p[0].sum()) if len(p) else 0.0 for p in (a, b))
    same = x @ y.T
    gaps = la[:, None] * b[:, -1][None, :] + a[:, -1][:, None] * lb[None, :]
    pair = MATCH * same + MISMATCH * (la[:, None] * lb[None, :] - same) - GAP * gaps
    alone_a, alone_b = GAP * la * size_b, GAP * lb * size_a
    along = np.concatenate([[0.0], np.cumsum(alone_b)])
    came = np.zeros((n + 1, m + 1), np.uint8)
    came[0, 1:] = 2
    row = -along
    for i in range(n):
        now = row - alone_a[i]
        came[i + 1] = 1
        diagonal = row[:-1] + pair[i]
        better = diagonal >= now[1:]
        now[1:] = np.where(better, diagonal, now[1:])
        came[i + 1, 1:] = np.where(better, 0, 1)
        ahead = np.maximum.accumulate(now + along) - along
        came[i + 1] = np.where(ahead > now + 1e-9, 2, came[i + 1])
        row = np.where(ahead > now + 1e-9, ahead, now)
    ops, i, j = [], n, m
    while i or j:
        op = came[i, j]
        ops.append(op)
        i, j = i - (op != 2), j - (op != 1)
    ops = np.array(ops[::-1], np.int64)
    return float(row[-1]), np.flatnonzero(ops != 2), np.flatnonzero(ops != 1)


def spread(profile: np.ndarray, columns: np.ndarray, width: int) -> np.ndarray:
    """The profile in the merged one's columns, gaps in all others."""
    out = np.zeros((width, profile.shape[1]), np.int64)
    out[:, -1] = profile[0].sum() if len(profile) else 0
    out[columns] = profile
    return out


def merge_all(profiles: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """The columns of each profile in the merged one of all, and that. Profiles have a column at least."""
    columns = [np.arange(len(profiles[0]))]
    whole = profiles[0]

    def put(held, own):
        """``own`` merged into ``held``, the columns of the others moved along."""
        _, old, new = merge(held, own)
        width = int(max(old.max(initial=-1), new.max(initial=-1))) + 1
        return old, new, spread(held, old, width) + spread(own, new, width)

    for own in profiles[1:]:
        old, new, whole = put(whole, own)
        columns = [old[c] for c in columns] + [new]
    for _ in range(ROUNDS if len(profiles) > 2 else 0):
        changed = False
        for k, own in enumerate(profiles):
            rest = whole - spread(own, columns[k], len(whole))
            used = np.flatnonzero(rest[:, :-1].any(axis=1))
            if not len(used):
                continue
            score, old, new = merge(rest[used], own)
            if score > _between(rest, spread(own, columns[k], len(whole))) + 1e-9:
                place = np.full(len(whole), -1)
                place[used] = old
                width = int(max(old.max(), new.max())) + 1
                columns = [new if i == k else place[c] for i, c in enumerate(columns)]
                whole = spread(rest[used], old, width) + spread(own, new, width)
                changed = True
        if not changed:
            break
    return columns, whole


def _between(a: np.ndarray, b: np.ndarray) -> float:
    """Score of the pairs of two profiles whose columns stand one on the other."""
    x, y = a[:, :-1].astype(float), b[:, :-1].astype(float)
    la, lb, same = x.sum(axis=1), y.sum(axis=1), (x * y).sum(axis=1)
    return float((MATCH * same + MISMATCH * (la * lb - same) - GAP * (la * b[:, -1] + a[:, -1] * lb)).sum())


def pair_score(rows: list[str]) -> float:
    """Sum over all pairs of aligned rows and columns."""
    total = 0.0
    for i, a in enumerate(rows):
        for b in rows[:i]:
            total += sum(0.0 if x == y == "-" else -GAP if "-" in (x, y) else MATCH if x == y else MISMATCH for x, y in zip(a, b, strict=True))
    return total


def _place(text: str, columns: np.ndarray, width: int) -> str:
    out = np.full(width, ord("-"), np.uint8)
    out[columns] = np.frombuffer(text.encode("latin-1"), np.uint8)
    return out.tobytes().decode("latin-1")


_UNIT = "place int, unit long, size long, key string, n long, aligned string, profile binary"


def _texts_merged(rows: pd.DataFrame) -> pd.DataFrame:
    """One group of a place's texts: each aligned, and with the first one the group's profile."""
    rows = rows.assign(_n=-rows["key"].str.len()).sort_values(["_n", "n", "key"], ascending=[True, False, True])
    columns, whole = merge_all([profile_of(t, n) for t, n in zip(rows["key"], rows["n"], strict=True)])
    out = rows[["place", "unit", "size", "key", "n"]].copy()
    out["aligned"] = [_place(t, c, len(whole)) for t, c in zip(rows["key"], columns, strict=True)]
    out["profile"] = [whole.astype("<i8").tobytes() if i == 0 else None for i in range(len(rows))]
    return out


def _profiles_merged(rows: pd.DataFrame) -> pd.DataFrame:
    """One group of a place's profiles: the columns of each, and with the first one the group's profile."""
    rows = rows.sort_values("unit")
    columns, whole = merge_all([np.frombuffer(p, "<i8").reshape(-1, len(SYMBOLS)) for p in rows["profile"]])
    out = rows[["place", "unit", "next"]].copy()
    out["columns"] = [c.astype("<i4").tolist() for c in columns]
    out["width"] = len(whole)
    out["profile"] = [whole.astype("<i8").tobytes() if i == 0 else None for i in range(len(rows))]
    return out


def align_insertions(texts: DataFrame, group: int = GROUP) -> DataFrame:
    """(place, text, aligned) of (place, text, n): the texts of a place, all of one length then.

    Texts have a letter at least and are distinct in their place; ``n`` is how many sequences have each.
    """
    sizes = texts.groupBy("place").agg(F.count(F.lit(1)).alias("_texts"))
    rows = join_groups(texts.select("place", F.col("text").alias("key"), F.col("n").cast("long").alias("n")), sizes, "place", "_texts", texts.count())
    rows = rows.select("place", F.pmod(F.xxhash64("key"), F.ceil(F.col("_texts") / group)).alias("unit"), F.ceil(F.col("_texts") / group).alias("size"), "key", "n")
    done = materialize(rows.groupBy("place", "unit").applyInPandas(_texts_merged, _UNIT), "insertions")
    aligned = done.select("place", "unit", "key", "aligned")
    units = done.where("profile is not null and size > 1").select("place", "unit", "size", "profile")
    while not units.isEmpty():
        units = units.withColumn("next", F.floor(F.col("unit") / group).cast("long"))
        merged = materialize(
            units.groupBy("place", "next").applyInPandas(_profiles_merged, "place int, unit long, next long, columns array<int>, width int, profile binary"), "profiles"
        )

        @F.pandas_udf("string")
        def wider(text: pd.Series, columns: pd.Series, width: pd.Series) -> pd.Series:
            return pd.Series([t if c is None else _place(t, np.asarray(c), int(w)) for t, c, w in zip(text, columns, width, strict=True)], dtype="object")

        moved = aligned.join(merged.select("place", "unit", "next", "columns", "width"), ["place", "unit"], "left")
        aligned = materialize(moved.select("place", F.coalesce("next", "unit").alias("unit"), "key", wider("aligned", "columns", "width").alias("aligned")), "insertions")
        left = merged.where("profile is not null").select("place", F.col("next").alias("unit"), "profile")
        more = left.groupBy("place").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        units = materialize(left.join(more, "place").select("place", "unit", "size", "profile"), "units")
    return aligned.select("place", F.col("key").alias("text"), "aligned")
