"""Contrast of target windows with other datasets: best local similarity, worst case, candidates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.functions import iupac
from strandweave.operators import regions
from strandweave.plans.config import PrimerDesignConfig
from strandweave.plans.storage import materialize, number_rows, small

MATCH, OPEN, EXTEND = 1.0, -1.0, -0.5
#: Windows aligned in one go; their scores are rows of one matrix.
TOGETHER = 64
#: Windows of a block, letters of a block of sequences, lengths of words that are looked for, bits of a word's place.
WINDOWS, LETTERS, WORDS, PRESENT = 512, 100_000, (4, 8), 20


def local_scores(queries: np.ndarray, subject: np.ndarray) -> np.ndarray:
    """Best local alignment score of each query (rows of codes, padded with 0) with a subject.

    Match 1, mismatch 0, gap -1 to open and -0.5 to extend. Every diagonal step is worth 0 or more
    and opening costs more than extending, so the best gap along the subject that ends at a place is
    a prefix maximum, which a whole row takes at once.
    """
    n, width = len(subject), queries.shape[0]
    h, up = np.zeros((width, n + 1)), np.full((width, n + 1), -np.inf)
    best = np.zeros(width)
    slope = EXTEND * np.arange(n + 1)
    for i in range(queries.shape[1]):
        q = queries[:, i : i + 1]
        live = q != 0
        up = np.maximum(h + OPEN, up + EXTEND)
        now = np.zeros_like(h)
        now[:, 1:] = h[:, :-1] + MATCH * (q == subject)
        now = np.maximum(np.maximum(now, up), 0.0)
        ahead = np.maximum.accumulate(now - slope, axis=1)
        now[:, 1:] = np.maximum(now[:, 1:], ahead[:, :-1] + OPEN + slope[1:] - EXTEND)
        h = np.where(live, now, h)
        up = np.where(live, up, -np.inf)
        best = np.maximum(best, h.max(axis=1, initial=0.0))
    return best


def similarities(queries: list[str], subject: str) -> list[float]:
    """Scores over query length, clamped to 0..1; symbols are compared as they are."""
    if not subject:
        return [0.0] * len(queries)
    codes = np.frombuffer(subject.encode(), np.uint8)
    out = [1.0 if q and q in subject else -1.0 for q in queries]
    rest = [i for i, s in enumerate(out) if s < 0]
    for at in range(0, len(rest), TOGETHER):
        some = rest[at : at + TOGETHER]
        rows = np.zeros((len(some), max(len(queries[i]) for i in some)), np.uint8)
        for r, i in enumerate(some):
            rows[r, : len(queries[i])] = np.frombuffer(queries[i].encode(), np.uint8)
        for i, s in zip(some, local_scores(rows, codes), strict=True):
            out[i] = min(1.0, max(0.0, float(s) / len(queries[i]))) if queries[i] else 0.0
    return out


def _grams(text: str, k: int) -> np.ndarray:
    """Places in a table of presence of the k-letter words; words may share one."""
    codes = np.frombuffer(text.encode("latin-1", "replace"), np.uint8).astype(np.uint64)
    n = len(codes) - k + 1
    if n < 1:
        return np.empty(0, np.int64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * np.uint64(0x9E3779B97F4A7C15) + codes[i : i + n]
        return ((out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - PRESENT)).astype(np.int64)


def upper_bounds(queries: list[str], subjects: list[str]) -> np.ndarray:
    """The most that each subject's (row's) similarity with each query can be.

    Each letter of a query without its like, and each gap, costs a score of 1 at least and touches k of the
    query's words at most. So a query with m words that the subject lacks scores m / k less than its length
    at most.
    """
    out = np.ones((len(subjects), len(queries)))
    size = np.array([max(1, len(q)) for q in queries])
    for k in WORDS:
        grams = [_grams(q, k) for q in queries]
        flat, ends = np.concatenate([*grams, np.empty(0, np.int64)]), np.concatenate([[0], np.cumsum([len(g) for g in grams])])
        table = np.zeros(1 << PRESENT, bool)
        for row, subject in enumerate(subjects):
            own = _grams(subject, k)
            table[own] = True
            lacks = np.concatenate([[0], np.cumsum(~table[flat])])
            table[own] = False
            missing = lacks[ends[1:]] - lacks[ends[:-1]]
            out[row] = np.minimum(out[row], (size - -(-missing // k)) / size)
    return np.maximum(out, 0.0)


def block_best(queries: list[str], subjects: list[tuple[str, str]]) -> list[tuple[float, str, bool]]:
    """(similarity, id, reversed) of the best of (id, sequence) subjects for each query, in either direction.

    Ties go to the least id, forward first. Each query is aligned with the subject that can be best, and
    after that only with subjects that can still be better.
    """
    n = len(queries)
    table = str.maketrans(iupac.CODES, iupac.PAIRED)
    both = queries + [q.translate(table)[::-1] for q in queries]
    subjects = sorted(subjects)
    bounds = upper_bounds(both, [s for _, s in subjects])
    score, who, flip = np.full(n, -1.0), np.full(n, len(subjects)), np.zeros(n, bool)

    def align(row: int, some: np.ndarray) -> None:
        for q, value in zip(some.tolist(), similarities([both[i] for i in some], subjects[row][1]), strict=True):
            i, turned = q % n, q >= n
            if (-value, row, turned) < (-score[i], who[i], flip[i]):
                score[i], who[i], flip[i] = value, row, turned
        bounds[row, some] = -1.0

    first = bounds.argmax(axis=0)
    ahead = np.arange(n) + np.where(bounds.max(axis=0)[n:] > bounds.max(axis=0)[:n], n, 0)
    for row in np.unique(first[ahead]).tolist():
        align(row, ahead[first[ahead] == row])
    for row in np.argsort(-bounds.mean(axis=1), kind="stable").tolist():
        best, holder, turned = np.tile(score, 2), np.tile(who, 2), np.tile(flip, 2)
        earlier = (row < holder) | ((row == holder) & (np.arange(2 * n) < n) & turned)
        live = np.flatnonzero((bounds[row] >= 0) & ((bounds[row] > best + 1e-12) | (bounds[row] > best - 1e-12) & earlier))
        if len(live):
            align(row, live)
    return [(float(s), subjects[w][0], bool(f)) for s, w, f in zip(score, who, flip, strict=True)]


def best_matches(windows: DataFrame, sequences: DataFrame) -> DataFrame:
    """(reference_start, reference_end, dataset, similarity, sequence_id, orientation) of the best match.

    ``windows``: (reference_start, reference_end, query); (dataset, sequence_id, sequence). Blocks of windows
    meet blocks of each dataset's sequences, and each meeting gives its best only. Ties go to the least
    sequence id, forward first. Empty sequences are skipped.
    """
    wanted = number_rows(windows.select("reference_start", "reference_end", F.upper("query").alias("query")), "_n", "reference_start", "reference_end")
    turns = wanted.groupBy(F.floor((F.col("_n") - 1) / WINDOWS).alias("turn")).agg(F.collect_list(F.struct("reference_start", "reference_end", "query")).alias("windows"))
    rows = sequences.select("dataset", "sequence_id", F.upper("sequence").alias("sequence")).where(F.length("sequence") > 0)
    sizes = rows.groupBy("dataset").agg(F.ceil(F.sum(F.length("sequence")) / LETTERS).alias("_parts"))  # a row a dataset
    parted = rows.join(small(sizes), "dataset").withColumn("part", F.pmod(F.xxhash64("sequence_id"), F.col("_parts")))
    blocks = materialize(parted.groupBy("dataset", "part").agg(F.collect_list(F.struct("sequence_id", "sequence")).alias("sequences")), "similarity-blocks")
    meetings = blocks.select("dataset", "part").crossJoin(turns).join(blocks, ["dataset", "part"])  # each is a unit of work
    spark = windows.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    meetings = meetings.repartition(tasks, "dataset", "part", "turn").select("dataset", "windows", "sequences")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                dataset, own, held = (batch.column(i)[row].as_py() for i in range(3))
                found = block_best([w["query"] for w in own], [(s["sequence_id"], s["sequence"]) for s in held])
                yield pa.record_batch(
                    [
                        pa.array([w["reference_start"] for w in own], pa.int32()), pa.array([w["reference_end"] for w in own], pa.int32()), pa.array([dataset] * len(own), pa.string()),
                        pa.array([s for s, _, _ in found]), pa.array([n for _, n, _ in found], pa.string()), pa.array(["REVERSE_COMPLEMENT" if f else "FORWARD" for _, _, f in found]),
                    ],
                    names=["reference_start", "reference_end", "dataset", "similarity", "sequence_id", "orientation"],
                )

    shape = "reference_start int, reference_end int, dataset string, similarity double, sequence_id string, orientation string"
    key = F.struct((-F.col("similarity")).alias("s"), "sequence_id", "orientation")
    best = meetings.mapInArrow(run, shape).groupBy("reference_start", "reference_end", "dataset").agg(F.min_by(F.struct("similarity", "sequence_id", "orientation"), key).alias("m"))
    return best.select("reference_start", "reference_end", "dataset", "m.*")


def evidence(windows: DataFrame, datasets: DataFrame, matches: DataFrame) -> DataFrame:
    """Every window and dataset (name, panel_ordinal, criticality); no match is similarity 0 without id.

    A dataset's sequence_count, where given, goes along: with 0 it was never evaluated.
    """
    keys = ["reference_start", "reference_end", "dataset"]
    grid = windows.crossJoin(F.broadcast(datasets))
    return grid.join(matches, keys, "left").withColumn("similarity", F.coalesce("similarity", F.lit(0.0)))


def summarize(evidence_: DataFrame) -> DataFrame:
    """Worst dataset of each window, highest similarity by criticality, and the target's margin."""
    of = lambda kind: F.max(F.when(F.col("criticality") == kind, F.col("similarity")))
    worst = F.max_by(F.struct("dataset", "similarity", "criticality"), F.struct("similarity", (-F.col("panel_ordinal")).alias("o")))
    measures = [F.first(c).alias(c) for c in evidence_.columns if c in ("mean_conservation", "minimum_conservation", "mean_coverage", "mean_gap_frequency", "mean_entropy_bits", "usable_length", "position_count")]
    out = evidence_.groupBy("reference_start", "reference_end").agg(worst.alias("w"), of("CRITICAL").alias("worst_critical_similarity"), of("IMPORTANT").alias("worst_important_similarity"), *measures)
    return out.withColumns({"worst_dataset": F.col("w.dataset"), "worst_criticality": F.col("w.criticality"), "worst_similarity": F.col("w.similarity")}).withColumn("conservation_margin", F.col("mean_conservation") - F.col("worst_similarity")).drop("w")


def named_worst(rows: DataFrame) -> DataFrame:
    """Summaries or candidates with their columns named as they are published."""
    return rows.withColumnsRenamed({"worst_dataset": "worst_dataset_name", "worst_criticality": "worst_dataset_criticality", "conservation_margin": "contrast_margin"})


def _first(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(-1.0))  # a null comes before every similarity


def representative_key() -> list[Column]:
    return [_first("worst_critical_similarity"), _first("worst_important_similarity"), _first("worst_similarity"), -F.round("mean_conservation", regions.DIGITS), F.round("mean_entropy_bits", regions.DIGITS), F.col("reference_start"), F.col("reference_end")]


def candidates(summaries: DataFrame, positions: DataFrame, reference_length: int, c: PrimerDesignConfig) -> DataFrame:
    """Regions about eligible windows: one per interval, led by its best window, with all that share it.

    The window is what must be eligible; the region's own metrics may be worse.
    """
    wide = regions.expanded_windows(summaries.where(regions.eligible(c)), reference_length, c)
    led = F.struct("peak_start", "peak_end", "worst_dataset", "worst_criticality", "worst_similarity", "worst_critical_similarity", "worst_important_similarity", "conservation_margin")
    key = F.struct(*(k.alias(f"k{i}") for i, k in enumerate(representative_key())))
    grouped = wide.groupBy(F.col("_first").alias("reference_start"), F.col("_last").alias("reference_end")).agg(
        F.min_by(led, key).alias("r"), F.sort_array(F.collect_list(F.struct(F.col("peak_start").alias("start"), F.col("peak_end").alias("end")))).alias("contributing_windows")
    )
    spans = grouped.select("reference_start", "reference_end", "r.*", "contributing_windows")
    return regions.interval_metrics(spans.select("reference_start", "reference_end"), positions, c).join(spans, ["reference_start", "reference_end"]).withColumn("usable_fraction", F.col("usable_length") / F.col("position_count"))


def select_candidates(candidates_: DataFrame, c: PrimerDesignConfig) -> DataFrame:
    return regions.suppress(candidates_, representative_key(), c.max_candidate_regions, c.max_region_overlap_fraction, "contrast-region-%03d")


def heat_map(evidence_: DataFrame, datasets: list[str]) -> DataFrame:
    """One row per window, a column per dataset of the panel: its similarity's state.

    A dataset without sequences is unevaluated (where sequence_count is given), one without a row missing.
    """
    count = F.col("sequence_count") if "sequence_count" in evidence_.columns else F.lit(None)
    state = F.when(count == 0, "unevaluated").when(F.col("similarity").isNull(), "missing").when(F.col("sequence_id").isNull(), "no-match").otherwise("observed")
    wide = evidence_.withColumn("state", state).groupBy("reference_start", "reference_end").pivot("dataset", datasets).agg(F.first("state"))
    return wide.na.fill("missing", [f"`{d}`" for d in datasets])
