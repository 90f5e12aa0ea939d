"""Periodic runs of words by the runs theorem (Bannai et al., 2017), and texts without the repeats.

A run is a stretch of words with a least period that no neighbour extends. By the runs theorem each
run holds, at each start of a period after its first word, a word that is the longest Lyndon word there
under the order of words or its reverse. Those are read from the inverse suffix array: the next smaller
value ends the longest Lyndon word under one order, the next greater value under the other. Each is
extended to both sides by longest common extensions, which are minima over the LCP array.

A text is a row; texts are worked on together in arrays of some hundred thousand words, and what a text
takes is in proportion to its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.llm.words import byte_groups, split_words

WHITE = r"[\x20\x09-\x0D]+"
BLOCK = 16
RUNS = "array<struct<start:long,length:long,period:long>>"


def inverse_suffix_array(words: np.ndarray, doc: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Each suffix's rank; suffixes end with their text, ranks of a text come before those of the next.

    Prefix doubling, each round sorting only suffixes that still share their rank. ``doc`` numbers the
    texts, ``end`` is where each place's text ends.
    """
    n = len(words)
    at = np.argsort(doc * (int(words.max()) + 1) + words)
    new = np.ones(n, bool)
    new[1:] = (words[at[1:]] != words[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
    first = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[at] = np.repeat(first, np.diff(np.append(first, n)))
    shared = np.repeat(np.diff(np.append(first, n)) > 1, np.diff(np.append(first, n)))
    at, step = at[shared], 1
    while len(at):
        ahead = at + step
        inside = ahead < end[at]
        key = rank[at] * (n + 1) + np.where(inside, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.argsort(key)
        at, key = at[order], key[order]
        old = rank[at]
        edge = np.ones(len(at), bool)
        edge[1:] = key[1:] != key[:-1]
        group = np.ones(len(at), bool)
        group[1:] = old[1:] != old[:-1]
        place = np.arange(len(at))
        place -= np.maximum.accumulate(np.where(group, place, 0))
        starts = np.flatnonzero(edge)
        sizes = np.diff(np.append(starts, len(at)))
        rank[at] = old + np.repeat(place[starts], sizes)
        at = at[np.repeat(sizes > 1, sizes)]
        step *= 2
    return rank


def next_smaller(values: np.ndarray) -> np.ndarray:
    """For each place the first later one with a smaller value, or the length: up and down a tree of minima."""
    n = len(values)
    levels = [values]
    while len(levels[-1]) > 1:
        low = levels[-1]
        if len(low) % 2:
            low = np.append(low, np.iinfo(values.dtype).max)
        levels.append(np.minimum(low[::2], low[1::2]))
    tree = np.concatenate([np.append(x, np.iinfo(values.dtype).max) for x in levels])
    begin = np.concatenate([[0], np.cumsum([len(x) + 1 for x in levels])[:-1]])
    size = np.array([len(x) for x in levels])
    out = np.full(n, n, np.int64)
    who, spot, level = np.arange(n), np.arange(1, n + 1), np.zeros(n, np.int64)
    found_who, found_spot, found_level = [], [], []
    while len(who):
        node = spot >> level
        fine = node < size[level]
        who, spot, level, node = who[fine], spot[fine], level[fine], node[fine]
        hit = tree[begin[level] + node] < values[who]
        for kept, x in zip((found_who, found_spot, found_level), (who, spot, level), strict=True):
            kept.append(x[hit])
        who, spot, level = who[~hit], spot[~hit], level[~hit]
        spot = spot + (1 << level)
        level = np.where((spot >> level) & 1, level, np.minimum(level + 1, len(levels) - 1))
    who, spot, level = map(np.concatenate, (found_who, found_spot, found_level)) if found_who else (np.empty(0, np.int64),) * 3
    while True:
        done = level == 0
        out[who[done]] = spot[done]
        who, spot, level = who[~done], spot[~done], level[~done] - 1
        if not len(who):
            return out
        spot = np.where(tree[begin[level] + (spot >> level)] < values[who], spot, spot + (1 << level))


class RangeMin:
    """Minima of ranges: a sparse table over blocks, and minima from each place to its block's ends."""

    def __init__(self, values: np.ndarray):
        self.values = np.append(values, np.full(-len(values) % BLOCK, np.iinfo(values.dtype).max, values.dtype))
        rows = self.values.reshape(-1, BLOCK)
        self.ahead = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        self.before = np.minimum.accumulate(rows, axis=1).ravel()
        self.table = [rows.min(axis=1)]
        while (half := 1 << (len(self.table) - 1)) * 2 <= len(rows):
            low = self.table[-1]
            self.table.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of each [first, last]."""
        a, b = first // BLOCK, last // BLOCK
        out = np.minimum(self.ahead[first], self.before[last])
        same = np.flatnonzero(a == b)
        for i in range(0, len(same), 1 << 16):
            own = same[i : i + (1 << 16)]
            spots = np.minimum(first[own][:, None] + np.arange(BLOCK), last[own][:, None])
            out[own] = self.values[spots].min(axis=1)
        wide = np.flatnonzero(b - a > 1)
        if len(wide):
            lo, hi = a[wide] + 1, b[wide]
            level = np.frexp((hi - lo).astype(float))[1] - 1
            for k in np.unique(level):
                own = wide[level == k]
                x, y = a[own] + 1, b[own] - (1 << int(k))
                out[own] = np.minimum(out[own], np.minimum(self.table[k][x], self.table[k][y]))
        return out


def lcp_array(words: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Common words of each suffix and the one before it in order (Kasai et al., 2001)."""
    n = len(words)
    by = np.empty(n, np.int64)
    by[rank] = np.arange(n)
    w, r, by = words.tolist(), rank.tolist(), by.tolist()
    out, h = [0] * n, 0
    for i in range(n):
        k = r[i]
        if k:
            j = by[k - 1]
            most = n - max(i, j)
            while h < most and w[i + h] == w[j + h]:
                h += 1
            out[k] = h
            h = h - 1 if h else 0
        else:
            h = 0
    return np.array(out, np.int64)


def text_runs(words: np.ndarray, rank: np.ndarray, start: np.ndarray, period: np.ndarray, ratio: int, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of one text's runs from its Lyndon roots, by start and then period."""
    low = RangeMin(lcp_array(words, rank))

    def extension(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = rank[i], rank[j]
        return low(np.minimum(a, b) + 1, np.maximum(a, b))

    right = extension(start, start + period)
    # the leftmost root of a run starts less than a period after it; runs have ratio periods at least
    fine = right >= (ratio - 2) * period + 1
    start, period, right = start[fine], period[fine], right[fine]
    key = start * (len(words) + 1) + period
    leftmost = ~np.isin(key - period * (len(words) + 1), key)
    start, period, right = start[leftmost], period[leftmost], right[leftmost]
    lo, hi = np.zeros(len(start), np.int64), start.copy()  # the left extension is the most k for which words from k before on agree
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        fits = np.ones(len(start), bool)
        some = np.flatnonzero(mid > 0)
        fits[some] = extension(start[some] - mid[some], start[some] - mid[some] + period[some]) >= mid[some]
        lo, hi = np.where(fits, mid, lo), np.where(fits, hi, mid - 1)
    length = lo + period + right
    long = length >= np.maximum(least, ratio * period)
    return sorted(set(zip((start - lo)[long].tolist(), length[long].tolist(), period[long].tolist(), strict=True)), key=lambda r: (r[0], r[2]))


def find_runs(words: np.ndarray, offsets: np.ndarray, ratio: int, least: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of each text that has any, by its number. Text k is ``words[offsets[k]:offsets[k + 1]]``."""
    n = len(words)
    if not n:
        return {}
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    end = np.repeat(offsets[1:], sizes)
    rank = inverse_suffix_array(words, doc, end)
    starts, periods = [], []
    for value in (rank, -rank):
        place = np.arange(n)
        period = np.minimum(next_smaller(value), end) - place
        # the first words of the ratio periods from the leftmost root on are the same, but for the last period
        alive = np.flatnonzero(place + (ratio - 1) * period < end)
        for k in range(1, ratio):
            alive = alive[words[alive] == words[alive + k * period[alive]]]
        starts.append(alive)
        periods.append(period[alive])
    start, period = np.concatenate(starts), np.concatenate(periods)
    found: dict[int, list[tuple[int, int, int]]] = {}
    for k in np.unique(doc[start]).tolist():
        own, a, b = doc[start] == k, int(offsets[k]), int(offsets[k + 1])
        if runs := text_runs(words[a:b], rank[a:b] - a, start[own] - a, period[own], ratio, least):
            found[k] = runs
    return found


def _collapse(texts: pa.Array, ratio: int, least: int) -> tuple[list[int], list[list], pa.Array]:
    """Of each text: its number of words, its runs, and its words without repeats, one space between."""
    flat, offsets = split_words(texts)
    words = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    found = find_runs(words, offsets, ratio, least)
    keep = np.ones(len(words), bool)
    for k, runs in found.items():
        for start, length, period in runs:
            keep[offsets[k] + start + period : offsets[k] + start + length] = False
    ahead = np.concatenate([[0], np.cumsum(keep)])[offsets]
    kept = pa.LargeListArray.from_arrays(pa.array(ahead, pa.int64()), flat.filter(pa.array(keep)))
    return np.diff(offsets).tolist(), [found.get(k, []) for k in range(len(texts))], pc.binary_join(kept, pa.scalar(" ", pa.large_string()))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = 4, least: int = 6) -> DataFrame:
    """(id_col, n_words, runs, collapsed) for each row of ``docs``.

    Words are what ASCII white space parts, case and signs as they are. ``runs`` are (start, length,
    period) in words, by start and then period: all stretches with that least period whose length is at
    least ``least`` and ``ratio`` (3 or more) periods, and which no neighbouring word extends. ``collapsed`` has the
    words that are in no run after the run's first period, one space between. Null and empty texts have
    no words, no runs and an empty ``collapsed``; null ids stay null; rows that repeat give a row each; an
    empty table gives no rows; other columns, whatever their names, are ignored.
    """
    if ratio < 3:
        raise ValueError("a run's leftmost root is found from three periods on")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            for first, number in byte_groups(texts):
                n, runs, collapsed = _collapse(texts.slice(first, number), ratio, least)
                shaped = [[{"start": s, "length": m, "period": p} for s, m, p in r] for r in runs]
                of = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
                yield pa.record_batch(
                    [batch.column(0).slice(first, number), pa.array(n, pa.int64()), pa.array(shaped, of), collapsed.cast(pa.string())],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    return rows.mapInArrow(run, f"id {kind}, n_words long, runs {RUNS}, collapsed string").withColumnRenamed("id", id_col)


def looped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text_col) where the text of one row in ten, by its id's CRC-32 h, goes round and round.

    Where 10 divides h and the text has n > 0 words, words from a = floor(h / 10) mod n on become those of
    the first p = 1 + floor((n - a) / (3 + floor(h / 10) mod 8)) of them, again and again. Null ids change nothing.
    """
    h = F.crc32(F.col(id_col).cast("string"))
    words = F.filter(F.split(F.col(text_col), WHITE), lambda w: w != "")
    changed = docs.select(id_col, text_col, F.when(h % 10 == 0, words).alias("_words"), F.floor(h / 10).alias("_g"))
    looping: Column = F.expr(
        "array_join(transform(sequence(0, size(_words) - 1), i -> element_at(_words, cast(1 + if(i < _g % size(_words), i, "
        "_g % size(_words) + (i - _g % size(_words)) % (1 + floor((size(_words) - _g % size(_words)) / (3 + _g % 8)))) as int))), ' ')"
    )
    return changed.select(id_col, F.when(F.size("_words") > 0, looping).otherwise(F.col(text_col)).alias(text_col))


def run_report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of each row of ``periodic_runs``: the number of runs, the longest, and digests of runs and words kept."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    return found.withColumn("_best", best).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"),
        (-F.col("_best.period")).alias("period"), F.floor(1000 * F.col("_best.length") / -F.col("_best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
