"""Greedy identity clustering, longest first, done in parallel.

A sequence leads a cluster if no leader before it (longer, then earlier) is similar enough; others
join their best leader. Sequences are compared with leaders only, never with each other: in rounds,
the first undecided sequences (a bounded number of letters) are decided in order in one task, and the
leaders found there are compared with all later sequences where those lie. So the work is sequences
times leaders, whatever the size of a family.

Every pair with a leader is compared in full. Letters inserted in the longer sequence don't lower the
identity, so no shared words can be asked for: sequences of identity 1 may share none. A comparison is
cheap instead: a block of sequences is one integer with a bit a letter, and a leader's letter is four
operations on it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.plans.storage import materialize, number_rows, running_sum, spread

#: Letters and sequences that a round decides in one task, and letters that are compared at once.
ROUND_LETTERS, ROUND_ROWS, BLOCK_LETTERS = 250_000, 1_000, 500_000
#: Sequences of at most so many letters are compared in machine words, where there are so many of them.
SHORT, MANY = 504, 500


def word_length(identity: float) -> int:
    """Words get shorter as the identity asked for falls."""
    for floor, word in ((0.95, 10), (0.90, 8), (0.88, 7), (0.85, 6)):
        if identity >= floor:
            return word
    return 5


def identity(shorter: str, longer: str) -> float:
    """Most letters that can be aligned alike, without order changes, over the shorter length."""
    if not shorter:
        return 0.0
    if shorter in longer:
        return 1.0
    # a bit for each letter of the shorter one, set while the row's length doesn't grow there (Hyyro, 2004)
    places: dict[str, int] = {}
    for i, ch in enumerate(shorter):
        places[ch] = places.get(ch, 0) | 1 << i
    full = (1 << len(shorter)) - 1
    row = full
    for ch in longer:
        hit = row & places.get(ch, 0)
        row = (row + hit | row - hit) & full
    return (len(shorter) - row.bit_count()) / len(shorter)


class SideBySide:
    """Sequences in one integer, a bit a letter and a spare bit after each, to be compared at once."""

    def __init__(self, sequences: list[str]):
        self.sizes = np.array([len(s) for s in sequences], np.int64)
        self.short = len(sequences) >= MANY and 0 < self.sizes.max() <= min(SHORT, 4 * self.sizes.mean())
        if self.short:
            return self._words(sequences)
        text = "\0".join(sequences).encode("latin-1", "replace")[::-1]
        self.begins = np.concatenate([[0], np.cumsum(self.sizes + 1)[:-1]])
        self.bits = int(self.sizes.sum() + len(sequences))
        self.at = {c: int(text.translate(bytes(49 if b == c else 48 for b in range(256))), 2) for c in set(text) - {0}}
        self.full = 0
        for mask in self.at.values():
            self.full |= mask

    def _words(self, sequences: list[str]) -> None:
        """Masks as words of 63 letters, (words, sequences); a carry goes through the last bit."""
        words = -(-int(self.sizes.max()) // 63)
        texts = np.array([s.encode("latin-1", "replace") for s in sequences], f"S{words * 63}").view(np.uint8).reshape(len(sequences), words, 63)

        def masks(held: np.ndarray) -> np.ndarray:
            bits = np.packbits(np.pad(held, ((0, 0), (0, 0), (0, 1))), axis=2, bitorder="little")
            return np.ascontiguousarray(bits.view("<u8")[:, :, 0].T)

        self.full = masks(texts != 0)
        self.at = {int(c): masks(texts == c) for c in np.unique(texts) if c}

    def _identities(self, longer: str) -> np.ndarray:
        row, total, hit = self.full.copy(), np.empty_like(self.full), np.empty_like(self.full)
        carry, steps = np.empty_like(row[0]), list(zip(total, total[1:], strict=False))
        for ch in longer.encode("latin-1", "replace"):
            if ch in self.at:
                np.bitwise_and(row, self.at[ch], out=hit)
                np.add(row, hit, out=total)
                np.subtract(row, hit, out=row)
                for low, high in steps:
                    np.right_shift(low, 63, out=carry)
                    np.add(high, carry, out=high)
                np.bitwise_or(row, total, out=row)
                np.bitwise_and(row, self.full, out=row)
        same = self.sizes - np.bitwise_count(row).sum(axis=0, dtype=np.int64)
        return np.where(self.sizes > 0, same / np.maximum(self.sizes, 1), 0.0)

    def identities(self, longer: str) -> np.ndarray:
        """What ``identity`` gives for each sequence and ``longer``."""
        if self.short:
            return self._identities(longer)
        row, full, at = self.full, self.full, self.at
        for ch in longer.encode("latin-1", "replace"):
            if ch in at:
                hit = row & at[ch]
                row = (row + hit | row - hit) & full
        held = np.unpackbits(np.frombuffer(row.to_bytes(self.bits // 8 + 1, "little"), np.uint8), bitorder="little")
        same = self.sizes - np.add.reduceat(held[: self.bits], self.begins, dtype=np.int64)
        return np.where(self.sizes > 0, same / np.maximum(self.sizes, 1), 0.0)


def _leaders(rows: DataFrame, least: float) -> DataFrame:
    """(rank, sequence) of the leaders among the first of ``rows``, as many as ROUND_LETTERS allow, decided in order in one task."""

    def run(batches):
        rows = sorted(r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        letters = np.cumsum([len(s) for _, s in rows])
        rows = rows[: max(1, int(np.searchsorted(letters, ROUND_LETTERS, side="right")))]
        led, packed, waiting = [], None, np.arange(len(rows))
        held = waiting
        while len(waiting):
            if packed is None or len(waiting) * 2 < len(held):
                held, packed = waiting, SideBySide([rows[k][1] for k in waiting])
            first = waiting[0]
            led.append(rows[first])
            fine = np.isin(held, waiting) & (packed.identities(rows[first][1]) < least)
            waiting = held[fine & (held != first)]
        if led:
            yield pa.record_batch([pa.array([r for r, _ in led], pa.int64()), pa.array([s for _, s in led], pa.string())], names=["rank", "sequence"])

    return rows.repartition(1).mapInArrow(run, "rank long, sequence string")


def _joined(rows: DataFrame, leaders: list[tuple[int, str]], least: float) -> DataFrame:
    """(rank, leader, identity): the best of ``leaders`` (in order) of each later sequence similar to any."""

    def block(ranks: list[int], sequences: list[str]):
        packed, at = SideBySide(sequences), np.array(ranks)
        best, home = np.zeros(len(at)), np.zeros(len(at), np.int64)
        for rank, sequence in leaders:
            if rank < at.max():
                found = np.where(at > rank, packed.identities(sequence), 0.0)
                better = (found >= least) & (found > best)
                best[better], home[better] = found[better], rank
        some = home > 0
        return pa.record_batch([pa.array(at[some]), pa.array(home[some]), pa.array(best[some])], names=["rank", "leader", "identity"])

    def run(batches):
        ranks, sequences, letters = [], [], 0
        for batch in batches:
            for rank, sequence in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ranks.append(rank)
                sequences.append(sequence)
                letters += len(sequence)
                if letters >= BLOCK_LETTERS:
                    yield block(ranks, sequences)
                    ranks, sequences, letters = [], [], 0
        if ranks:
            yield block(ranks, sequences)

    return rows.mapInArrow(run, "rank long, leader long, identity double")


def clusters(sequences: DataFrame, least: float = 0.95) -> DataFrame:
    """(cluster_id, representative_id, sequence_id, ordinal, is_representative, identity).

    ``sequences``: (ordinal, sequence_id, sequence), ids unique. Of equally similar leaders the first in
    the order is joined. Clusters are numbered by their first member, from cluster-00000. An empty
    sequence is similar to none and leads; an empty table gives no rows.
    """
    spark = sequences.sparkSession
    ranked = number_rows(sequences.select("ordinal", "sequence_id", F.upper(F.coalesce("sequence", F.lit(""))).alias("sequence"), (-F.length(F.coalesce("sequence", F.lit("")))).alias("_n")), "rank", "_n", "ordinal")
    ranked = materialize(spread(ranked.drop("_n")), "ranked")  # few letters are one file, whose comparisons would be one task's
    rows = ranked.select("rank", "sequence")
    empty = spark.createDataFrame([], "rank long, leader long, identity double")
    joined, leaders, decided = [], [], rows.select("rank").limit(0)
    while True:
        waiting = rows.select("rank").join(decided, "rank", "left_anti").orderBy("rank").limit(ROUND_ROWS)
        found = materialize(_leaders(rows.join(F.broadcast(waiting), "rank", "left_semi"), least), "leaders")
        new = sorted((r.rank, r.sequence) for r in found.collect())  # at most a round's letters
        if not new:
            break
        leaders.append(found.select("rank"))
        joined.append(materialize(_joined(rows.where(F.col("rank") > new[0][0]), new, least), "joined"))
        decided = materialize(decided.unionByName(leaders[-1]).unionByName(joined[-1].select("rank")).distinct(), "decided")
    homes = empty
    for part in joined:
        homes = homes.unionByName(part)
    best = homes.groupBy("rank").agg(F.min_by(F.struct("leader", "identity"), F.struct((-F.col("identity")).alias("i"), "leader")).alias("b"))
    led = empty.select("rank")
    for part in leaders:
        led = led.unionByName(part)
    homes = best.select("rank", "b.leader", "b.identity").unionByName(led.select("rank", F.col("rank").alias("leader"), F.lit(None).cast("double").alias("identity")))
    ids = ranked.select("rank", "ordinal", "sequence_id")
    homes = materialize(homes.join(ids, "rank"), "homes")
    first = homes.groupBy("leader").agg(F.min("ordinal").alias("first"))
    named = number_rows(first, "n", "first").select("leader", F.format_string("cluster-%05d", F.col("n") - 1).alias("cluster_id"))
    heads = named.join(ids.select(F.col("rank").alias("leader"), F.col("sequence_id").alias("representative_id")), "leader")
    return homes.join(heads, "leader").select(
        "cluster_id", "representative_id", "sequence_id", "ordinal", (F.col("leader") == F.col("rank")).alias("is_representative"), "identity"
    )


def discovery(clusters_: DataFrame) -> DataFrame:
    """Representatives: the sequences that go on."""
    return clusters_.where("is_representative").select("ordinal", "sequence_id")


def input_gaps(sequences: DataFrame, evaluation: DataFrame, minimum: int) -> DataFrame:
    """(problem, sequence_id): repeated ids, ids on one side only, sequences shorter than a word."""
    ids, wanted = sequences.select("sequence_id"), evaluation.select("sequence_id")
    repeated = ids.groupBy("sequence_id").count().where("count > 1").select(F.lit("DUPLICATE_ID").alias("problem"), "sequence_id")
    one = ids.join(wanted, "sequence_id", "left_anti").select(F.lit("NOT_EVALUATED").alias("problem"), "sequence_id")
    other = wanted.join(ids, "sequence_id", "left_anti").select(F.lit("NO_RECORD").alias("problem"), "sequence_id")
    short = sequences.where(F.length("sequence") < minimum).select(F.lit("TOO_SHORT").alias("problem"), "sequence_id")
    return repeated.unionByName(one).unionByName(other).unionByName(short)


def result_gaps(clusters_: DataFrame, evaluation: DataFrame) -> DataFrame:
    """(problem, sequence_id): sequences in no cluster or in several, unknown ones, and clusters without
    exactly one representative (by their id)."""
    ids = clusters_.select("sequence_id")
    wanted = evaluation.select("sequence_id")
    often = ids.groupBy("sequence_id").count().where("count > 1").select(F.lit("IN_SEVERAL_CLUSTERS").alias("problem"), "sequence_id")
    none = wanted.join(ids, "sequence_id", "left_anti").select(F.lit("IN_NO_CLUSTER").alias("problem"), "sequence_id")
    other = ids.join(wanted, "sequence_id", "left_anti").select(F.lit("UNKNOWN_SEQUENCE").alias("problem"), "sequence_id")
    led = clusters_.groupBy(F.col("cluster_id").cast("string").alias("sequence_id")).agg(F.count_if("is_representative").alias("n")).where("n <> 1").select(F.lit("REPRESENTATIVES").alias("problem"), "sequence_id")
    return often.unionByName(none).unionByName(other).unionByName(led)


def parse_clstr(lines: DataFrame) -> DataFrame:
    """(cluster, number, sequence_id, is_representative, identity, strand) of ``.clstr`` lines.

    ``lines``: (number, value) of one report; the headers before a line, counted in blocks of lines,
    tell its cluster. A line that is neither header nor member fails the query; ``result_gaps`` tells
    whether each sequence is there once and each cluster has one representative.
    """
    header = r"^>Cluster \d+$"
    member = r"^\d+\t\d+nt, >(.+?)\.\.\. (\*|at (?:([+-])/)?([0-9.]+)%)$"
    is_header = F.col("value").rlike(header)
    rows = running_sum(lines.where(F.trim("value") != ""), "number", F.when(is_header, 1).otherwise(0), "_headers")
    rows = rows.where(~is_header)
    part = lambda i: F.regexp_extract("value", member, i)
    fine = F.col("value").rlike(member) & (F.col("_headers") > 0)
    checked = F.when(fine, part(1)).otherwise(F.raise_error(F.concat(F.lit("bad cluster line "), F.col("number").cast("string"))).cast("string"))
    return rows.select((F.col("_headers") - 1).alias("cluster"), F.col("number"), checked.alias("sequence_id"), (part(2) == "*").alias("is_representative"), (F.nullif(part(4), F.lit("")).cast("double") / 100).alias("identity"), F.nullif(part(3), F.lit("")).alias("strand"))
