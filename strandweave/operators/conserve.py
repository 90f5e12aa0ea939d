"""Conservation: metrics of alignment columns, consensus, anchored windows, annotations."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions import iupac, text
from strandweave.functions.intervals import window_starts
from strandweave.operators.ranges import interval_aggregates
from strandweave.plans.config import ConservationConfig
from strandweave.plans.storage import running_sum

BASES = ("A", "C", "G", "T")
#: Votes are counted in twelfths, so that a symbol of one to four bases splits its vote exactly.
SCALE = 12


def cells(aligned: DataFrame) -> DataFrame:
    """(ordinal, sequence_id, alignment_position, symbol) of (ordinal, sequence_id, aligned_sequence)."""
    symbols = F.filter(F.split("aligned_sequence", ""), lambda s: s != "")
    return aligned.select("ordinal", "sequence_id", F.posexplode(symbols).alias("_at", "symbol")).select(
        "ordinal", "sequence_id", (F.col("_at") + 1).alias("alignment_position"), "symbol"
    )


def coordinate_map(reference: DataFrame) -> DataFrame:
    """(alignment_position, reference_position, reference_base) of the reference's cells; null in gaps."""
    rows = running_sum(reference.select("alignment_position", "symbol"), "alignment_position", F.when(F.col("symbol") != "-", 1).otherwise(0), "_count")
    base = F.col("symbol") != "-"
    return rows.select("alignment_position", F.when(base, F.col("_count")).cast("int").alias("reference_position"), F.when(base, F.col("symbol")).alias("reference_base"))


def column_votes(cells_: DataFrame) -> DataFrame:
    """Depth, votes in twelfths and union of bases of each column: sums, combined before rows move."""
    m = iupac.mask(F.col("symbol"))
    rows = cells_.select("alignment_position", m.alias("m"))
    share = F.expr(f"{SCALE} div bit_count(nullif(m, 0))")
    votes = [F.sum(F.when(F.col("m").bitwiseAND(F.lit(1 << i)) != 0, share).otherwise(0)).cast("long").alias(f"votes_{b}") for i, b in enumerate(BASES)]
    return rows.groupBy("alignment_position").agg(F.count_if(F.col("m") > 0).alias("depth"), F.count(F.lit(1)).alias("n"), *votes, F.bit_or("m").alias("support"))


def aligned_votes(aligned: DataFrame) -> DataFrame:
    """``column_votes`` of (aligned_sequence): each task adds up a matrix of its rows' votes, and the
    tasks' matrices are added; a row for each column and task moves, not one for each cell."""
    masks = np.zeros(256, np.int64)
    for i, code in enumerate(iupac.CODES, 1):
        masks[ord(code)] = i
    shares = np.array([[SCALE // m.bit_count() if m >> b & 1 else 0 for m in range(16)] for b in range(len(BASES))])
    names = ["alignment_position", "depth", "n", *(f"votes_{b}" for b in BASES), "support"]

    def run(batches):
        held = np.zeros((len(names) - 1, 0), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                m = masks[np.frombuffer((text or "").encode("latin-1", "replace"), np.uint8)]
                if len(m) > held.shape[1]:
                    held = np.pad(held, ((0, 0), (0, len(m) - held.shape[1])))
                own = held[:, : len(m)]
                own[0] += m > 0
                own[1] += 1
                own[2:6] += shares[:, m]
                own[6] |= m
        if held.shape[1]:
            yield pa.record_batch([pa.array(np.arange(1, held.shape[1] + 1)), *map(pa.array, held)], names=names)

    rows = aligned.select("aligned_sequence").mapInArrow(run, ", ".join(f"{n} long" for n in names))
    sums = [F.sum(n).alias(n) for n in names[1:-1]]
    return rows.groupBy(F.col("alignment_position").cast("int").alias("alignment_position")).agg(*sums, F.bit_or("support").cast("int").alias("support"))


def position_metrics(cells_: DataFrame, coordinates: DataFrame, sequence_count: int) -> DataFrame:
    """One row per column of cells. A column of gaps only fails the query."""
    return vote_metrics(column_votes(cells_), coordinates, sequence_count)


def vote_metrics(votes: DataFrame, coordinates: DataFrame, sequence_count: int) -> DataFrame:
    """One row per column of votes. A column of gaps only fails the query."""
    depth = F.when(F.col("depth") > 0, F.col("depth")).otherwise(F.raise_error(F.lit("alignment column has no bases")).cast("long"))
    top = F.greatest(*(F.col(f"votes_{b}") for b in BASES))
    freq = {b: F.col(f"votes_{b}") / (SCALE * F.col("depth")) for b in BASES}
    entropy = -sum((F.when(F.col(f"votes_{b}") > 0, freq[b] * F.log2(freq[b])).otherwise(0.0) for b in BASES), F.lit(0.0))
    tied_reference = F.when(F.coalesce(F.expr("CASE reference_base " + " ".join(f"WHEN '{b}' THEN votes_{b}" for b in BASES) + " END"), F.lit(-1)) == top, F.col("reference_base"))
    first = F.coalesce(*(F.when(F.col(f"votes_{b}") == top, F.lit(b)) for b in BASES))
    rows = votes.withColumn("depth", depth).join(coordinates, "alignment_position", "left")
    return rows.select(
        "alignment_position", "reference_position", "reference_base", F.col("depth").cast("int").alias("depth"),
        (F.col("depth") / sequence_count).alias("coverage"), ((F.lit(sequence_count) - F.col("depth")) / sequence_count).alias("gap_frequency"),
        *(freq[b].alias(f"frequency_{b.lower()}") for b in BASES), (top / (SCALE * F.col("depth"))).alias("major_allele_frequency"),
        (F.abs(entropy)).alias("entropy_bits"), F.coalesce(tied_reference, first).alias("major_symbol"), iupac.symbol(F.col("support")).alias("iupac_symbol"),
    )


def consensus(positions: DataFrame) -> DataFrame:
    """One row: (major_consensus, iupac_consensus) over reference positions."""
    order = F.sort_array(F.collect_list(F.struct("reference_position", "major_symbol", "iupac_symbol")))
    return positions.where("reference_position is not null").agg(order.alias("s")).select(
        F.array_join(F.transform("s", lambda x: x["major_symbol"]), "").alias("major_consensus"),
        F.array_join(F.transform("s", lambda x: x["iupac_symbol"]), "").alias("iupac_consensus"),
    )


def windows(positions: DataFrame, reference_length: int, config: ConservationConfig, usable=None) -> DataFrame:
    """Sliding windows, the last anchored at the end; a short reference gives one partial window.

    A window is three look-ups, whatever its size and step. ``usable`` (a predicate) adds a count of
    usable positions.
    """
    w, step = config.window_size, config.step_size
    last = max(1, reference_length - w + 1)
    number = -(-(last - 1) // step) + 1  # starts at 1, 1 + step, ...; the last is a window in any case
    starts = positions.sparkSession.range(number).select(F.least(F.col("id") * step + 1, F.lit(last)).cast("int").alias("reference_start"))
    spans = starts.withColumn("reference_end", F.least(F.col("reference_start") + (w - 1), F.lit(reference_length)).cast("int"))
    own = F.col("reference_position")
    sums = {"position_count": own.isNotNull().cast("int"), "_major": F.col("major_allele_frequency"), "_coverage": F.col("coverage"), "_gap": F.col("gap_frequency"), "_entropy": F.col("entropy_bits")}
    if usable is not None:
        sums["usable_length"] = F.when(usable, 1).otherwise(0)
    length = min(w, reference_length)
    rows = interval_aggregates(spans, positions, "reference_position", sums, {"minimum_conservation": F.col("major_allele_frequency")}, [length.bit_length() - 1])
    mean = lambda c: F.col(c) / F.col("position_count")
    return rows.where("position_count > 0").select(
        "reference_start", "reference_end", F.col("position_count").cast("int").alias("position_count"), mean("_major").alias("mean_conservation"), "minimum_conservation",
        mean("_coverage").alias("mean_coverage"), mean("_gap").alias("mean_gap_frequency"), mean("_entropy").alias("mean_entropy_bits"),
        *([F.col("usable_length").cast("int").alias("usable_length")] if usable is not None else []),
    )


def anchored_windows(length: int, config: ConservationConfig, spark) -> DataFrame:
    """(reference_start, reference_end) of the windows over a reference."""
    starts = window_starts(F.lit(length), config.window_size, config.step_size)
    return spark.range(1).select(F.explode(starts).alias("reference_start")).select("reference_start", F.least(F.col("reference_start") + config.window_size - 1, F.lit(length)).alias("reference_end"))


def top_windows(windows_: DataFrame, k: int = 10) -> DataFrame:
    r = lambda c: F.round(c, 12)
    return windows_.orderBy(r("mean_conservation").desc(), r("minimum_conservation").desc(), r("mean_coverage").desc(), r("mean_entropy_bits"), "reference_start").limit(k)


def annotations(features: DataFrame, reference_length: int) -> tuple[DataFrame, DataFrame]:
    """Feature parts clipped to the reference, sorted by place; and one row with the number skipped.

    ``features``: (type, parts array<struct<start,end,strand,ref>>, qualifiers), starts 0-based. A
    ``source`` feature skips as many as it has parts, one at least.
    """
    source = F.col("type") == "source"
    rows = features.where(~source).select("type", "qualifiers", F.explode("parts").alias("p"))
    start, end = F.greatest(F.col("p.start") + 1, F.lit(1)), F.least(F.col("p.end"), F.lit(reference_length))
    fine = F.col("p.ref").isNull() & F.col("p.start").isNotNull() & F.col("p.end").isNotNull() & (F.col("p.start") < F.col("p.end")) & (start <= end)
    out = rows.where(fine).select("type", start.alias("start"), end.alias("end"), F.col("p.strand").alias("strand"), text.feature_label(F.col("qualifiers"), F.col("type")).alias("label"))
    skipped = features.where(source).select(F.greatest(F.lit(1), F.size("parts")).alias("n")).unionByName(rows.where(~F.coalesce(fine, F.lit(False))).select(F.lit(1).alias("n")))
    return out.orderBy("start", "end", "type", "label"), skipped.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("skipped"))


def input_problems(aligned: DataFrame, coordinates: DataFrame, reference_id: str) -> DataFrame:
    """(problem, at): rows of another width, a reference that isn't there once, repeated sequences, and
    coordinates that aren't those of the reference's row."""
    width = aligned.agg(F.max(F.length("aligned_sequence")).alias("w"))  # one row
    odd = aligned.crossJoin(F.broadcast(width)).where(F.length("aligned_sequence") != F.col("w")).select(F.lit("WIDTH").alias("problem"), F.col("sequence_id").alias("at"))
    often = aligned.groupBy("sequence_id").count().where("count > 1").select(F.lit("REPEATED_SEQUENCE").alias("problem"), F.col("sequence_id").alias("at"))
    own = aligned.where(F.col("sequence_id") == reference_id)
    none = own.agg(F.count(F.lit(1)).alias("n")).where("n <> 1").select(F.lit("REFERENCE").alias("problem"), F.lit(reference_id).alias("at"))
    told = coordinate_map(cells(own)).withColumnsRenamed({"reference_position": "_position", "reference_base": "_base"}).withColumn("_own", F.lit(True))
    both = coordinates.withColumn("_given", F.lit(True)).join(told, "alignment_position", "full_outer")
    same = F.col("reference_position").eqNullSafe(F.col("_position")) & F.col("reference_base").eqNullSafe(F.col("_base")) & F.col("_own").isNotNull() & F.col("_given").isNotNull()
    moved = both.where(~same).select(F.lit("COORDINATES").alias("problem"), F.col("alignment_position").cast("string").alias("at"))
    return odd.unionByName(often).unionByName(none).unionByName(moved)
