"""How well assays bind the sequences they are for, where those vary, and what degeneracy would help."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions import iupac
from strandweave.operators.match import ORIENTATIONS, ROLES, Oligo, local_sites, reverse_masks, to_masks
from strandweave.plans.config import InclusivityConfig
from strandweave.plans.storage import materialize, number_rows, small

#: Designs that are sent to tasks at once, and letters of a block of sequences.
DESIGNS, LETTERS = 500, 250_000
_HIT = (
    "struct<role: string, orientation: string, hit_rank: int, source_start: int, source_end: int, expected_start: int, expected_end: int, displacement: int, "
    "mismatch_positions: array<int>, mismatch_count: int, exact_match: boolean, three_prime_mismatch: boolean, probe_mismatch: boolean, compatible: boolean, "
    "oriented_start: int, oriented_end: int, site: string, selected: boolean>"
)
BINDING_DDL = (
    "assay_id string, ordinal long, sequence_id string, orientation string, geometry_found boolean, source_amplicon_start int, source_amplicon_end int, "
    f"amplicon_size int, original_compatible boolean, hits array<{_HIT}>"
)
_INT = pa.int32()
_HIT_ARROW = pa.struct(
    [("role", pa.string()), ("orientation", pa.string())] + [(n, _INT) for n in ("hit_rank", "source_start", "source_end", "expected_start", "expected_end", "displacement")]
    + [("mismatch_positions", pa.list_(_INT)), ("mismatch_count", _INT)] + [(n, pa.bool_()) for n in ("exact_match", "three_prime_mismatch", "probe_mismatch", "compatible")]
    + [("oriented_start", _INT), ("oriented_end", _INT), ("site", pa.string()), ("selected", pa.bool_())]
)
BINDING_ARROW = pa.schema(
    [("assay_id", pa.string()), ("ordinal", pa.int64()), ("sequence_id", pa.string()), ("orientation", pa.string()), ("geometry_found", pa.bool_())]
    + [(n, _INT) for n in ("source_amplicon_start", "source_amplicon_end", "amplicon_size")] + [("original_compatible", pa.bool_()), ("hits", pa.list_(_HIT_ARROW))]
)


def _bind(target: np.ndarray, oligos: dict[str, Oligo], product_size: int, config: InclusivityConfig) -> dict:
    """Best forward, probe and reverse sites of one assay in one sequence, and all retained sites."""
    n = len(target)
    views = {"FORWARD": target, "REVERSE_COMPLEMENT": reverse_masks(target)}
    by: dict[tuple[str, str], list[dict]] = {}
    hits = []
    for role in ROLES:
        for orientation in ORIENTATIONS:
            sites = local_sites(views[orientation], oligos[role], config)
            for s in sites:
                flip = orientation != "FORWARD"
                s |= {
                    "role": role, "orientation": orientation, "selected": False, "exact_match": not s["mismatch_positions"],
                    "source_start": n - s["oriented_end"] + 1 if flip else s["oriented_start"], "source_end": n - s["oriented_start"] + 1 if flip else s["oriented_end"],
                    "expected_start": oligos[role].reference_start, "expected_end": oligos[role].reference_end,
                    "three_prime_mismatch": s["tail"] > 0, "probe_mismatch": role == "PROBE" and s["mismatch_count"] > 0,
                }
            by[role, orientation] = sites
            hits += sites
    best, chosen = None, None
    for turn, orientation in enumerate(ORIENTATIONS):
        f, p, r = (by[role, orientation] for role in ROLES)
        if not (f and p and r):
            continue
        column = lambda sites, name: np.array([s[name] for s in sites])
        fs, fe, ps, pe, rs, re_ = (column(x, c) for x in (f, p, r) for c in ("oriented_start", "oriented_end"))
        size = re_[None, :] - fs[:, None] + 1
        fits = (size >= product_size - config.max_amplicon_size_delta) & (size <= product_size + config.max_amplicon_size_delta)
        ok = (fe[:, None, None] < ps[None, :, None]) & (pe[None, :, None] < rs[None, None, :]) & fits[:, None, :]
        a, b, c = np.nonzero(ok)
        if not len(a):
            continue
        mm = [column(x, "mismatch_count") for x in (f, p, r)]
        away = [column(x, "displacement") for x in (f, p, r)]
        tails = column(f, "tail")[a] + column(r, "tail")[c]
        keys = (re_[c], rs[c], pe[b], ps[b], fe[a], fs[a], away[0][a] + away[1][b] + away[2][c], np.abs(size[a, c] - product_size), tails, mm[0][a] + mm[1][b] + mm[2][c])
        i = np.lexsort(keys)[0]
        key = tuple(int(k[i]) for k in keys[:5:-1]) + (turn,)
        if best is None or key < best:
            best, chosen = key, (f[a[i]], p[b[i]], r[c[i]])
    if chosen:
        for s in chosen:
            s["selected"] = True
        f, p, r = chosen
        return {
            "orientation": f["orientation"], "geometry_found": True, "source_amplicon_start": min(f["source_start"], r["source_start"]),
            "source_amplicon_end": max(f["source_end"], r["source_end"]), "amplicon_size": r["oriented_end"] - f["oriented_start"] + 1,
            "original_compatible": all(s["compatible"] for s in chosen), "hits": hits,
        }
    for role in ROLES:  # no geometry: each role's best site by itself
        sites = [s for o in ORIENTATIONS for s in by[role, o]]
        if sites:
            min(sites, key=lambda s: (s["mismatch_count"], s["tail"], s["displacement"], s["orientation"] != "FORWARD", s["oriented_start"]))["selected"] = True
    return {"orientation": None, "geometry_found": False, "source_amplicon_start": None, "source_amplicon_end": None, "amplicon_size": None, "original_compatible": False, "hits": hits}


def _bound_to(sequences: list[tuple], designs: list, config: InclusivityConfig):
    """Record batches of the bindings of (ordinal, sequence_id, sequence) rows to designs."""
    out = []
    for ordinal, sequence_id, sequence in sequences:
        target = to_masks(sequence or "")
        for r in designs:
            oligos = {role: Oligo(r["assay_id"], role, o["sequence"].upper(), o["reference_start"], o["reference_end"]) for role in ROLES for o in (r[role.lower()],)}
            out.append({"assay_id": r["assay_id"], "ordinal": ordinal, "sequence_id": sequence_id} | _bind(target, oligos, r["product_size"], config))
            if len(out) >= 200:
                yield pa.RecordBatch.from_pylist(out, schema=BINDING_ARROW)
                out = []
    yield pa.RecordBatch.from_pylist(out, schema=BINDING_ARROW)


def bindings(sequences: DataFrame, assays: DataFrame, config: InclusivityConfig) -> DataFrame:
    """One row per assay and sequence of the evaluation set (ordinal, sequence_id, sequence).

    ``assays``: (assay_id, product_size, forward, probe, reverse), the last three structs of
    (sequence, reference_start, reference_end). Up to DESIGNS of them are sent to the sequences, which stay
    put; of more, blocks meet blocks of sequences, so no task holds them all.
    """
    slim = sequences.select(F.col("ordinal").cast("long").alias("ordinal"), "sequence_id", iupac.normalize_or_raise(F.col("sequence"), F.concat(F.lit("record "), F.col("sequence_id"))).alias("sequence"))
    designs = assays.select("assay_id", "product_size", "forward", "probe", "reverse")
    few = [r.asDict(recursive=True) for r in designs.limit(DESIGNS + 1).collect()]
    if len(few) <= DESIGNS:

        def run(batches):
            for batch in batches:
                yield from _bound_to([tuple(r.values()) for r in batch.to_pylist()], few, config)

        return slim.mapInArrow(run, BINDING_DDL)
    turns = number_rows(designs, "_n", "assay_id").groupBy(F.floor((F.col("_n") - 1) / DESIGNS).alias("turn")).agg(F.collect_list(F.struct(*designs.columns)).alias("designs"))
    letters = slim.agg(F.sum(F.length("sequence"))).first()[0] or 1
    parts = F.pmod(F.xxhash64("ordinal", "sequence_id"), F.lit(-(-letters // LETTERS)))
    blocks = materialize(slim.groupBy(parts.alias("part")).agg(F.collect_list(F.struct("ordinal", "sequence_id", "sequence")).alias("sequences")), "binding-blocks")
    spark = sequences.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    meetings = blocks.select("part").crossJoin(turns).join(blocks, "part").repartition(tasks, "part", "turn").select("sequences", "designs")  # each is a unit of work

    def meet(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield from _bound_to([tuple(r.values()) for r in batch.column(0)[row].as_py()], batch.column(1)[row].as_py(), config)

    return meetings.mapInArrow(meet, BINDING_DDL)


def oligo_matches(bound: DataFrame) -> DataFrame:
    """All retained sites, selected ones marked."""
    return bound.select("assay_id", "ordinal", "sequence_id", F.explode("hits").alias("h")).select("assay_id", "ordinal", "sequence_id", "h.*")


def selected_sites(bound: DataFrame) -> DataFrame:
    """The sites of bindings with a geometry, one per role."""
    return oligo_matches(bound.where("geometry_found")).where("selected").select("assay_id", "ordinal", "sequence_id", "role", "site")


def long_oligos(assays: DataFrame) -> DataFrame:
    """(assay_id, role, oligo) of assays with nested oligos."""
    each = F.array(*(F.struct(F.lit(r).alias("role"), F.upper(F.col(f"{r.lower()}.sequence")).alias("oligo")) for r in ROLES))
    return assays.select("assay_id", F.inline(each))


def variations(bound: DataFrame, assays: DataFrame, sequence_count: int, config: InclusivityConfig, with_ids: bool = False) -> DataFrame:
    """Oligo positions where some selected site's bases differ from the oligo's.

    Equal sites are counted once before they meet their oligo. ``with_ids`` adds the sequences that
    differ, in order, which is as long as their number.
    """
    sites = selected_sites(bound)
    grouped = sites.groupBy("assay_id", "role", "site").agg(F.count(F.lit(1)).alias("n"))
    rows = grouped.join(small(long_oligos(assays)), ["assay_id", "role"]).select("*", F.explode(F.sequence(F.lit(1), F.length("oligo"))).alias("oligo_position"))
    seen, own = iupac.mask_at(F.col("site"), F.col("oligo_position")), iupac.mask_at(F.col("oligo"), F.col("oligo_position"))
    rows = rows.withColumns({"seen": seen, "own": own, "original_symbol": F.substr("oligo", F.col("oligo_position"), F.lit(1)), "size": F.length("oligo")})
    keys = ["assay_id", "role", "oligo_position", "original_symbol", "own", "size"]
    out = rows.groupBy(*keys).agg(F.sum(F.when(F.col("seen") != F.col("own"), F.col("n")).otherwise(0)).alias("affected_sequence_count"), F.bit_or("seen").alias("seen")).where("affected_sequence_count > 0")
    out = out.select(
        "assay_id", "role", "oligo_position", "original_symbol", iupac.bases(F.col("own")).alias("original_support"),
        iupac.symbol(F.col("seen")).alias("observed_symbol"), iupac.bases(F.col("seen")).alias("observed_support"), "affected_sequence_count",
        (F.col("affected_sequence_count") / F.lit(sequence_count)).alias("affected_fraction"),
        ((F.col("role") != "PROBE") & (F.col("oligo_position") > F.col("size") - config.primer_3_prime_bases)).alias("primer_3_prime_position"),
    )
    if with_ids:
        each = sites.join(rows.where("seen <> own").select("assay_id", "role", "site", "oligo_position"), ["assay_id", "role", "site"])
        ids = each.groupBy("assay_id", "role", "oligo_position").agg(F.sort_array(F.collect_list(F.struct("ordinal", "sequence_id"))).alias("s"))
        out = out.join(ids.select("assay_id", "role", "oligo_position", F.col("s.sequence_id").alias("affected_sequence_ids")), ["assay_id", "role", "oligo_position"])
    return out


PROPOSAL_DDL = (
    "assay_id string, role string, original_sequence string, proposed_sequence string, status string, reason string, original_degeneracy long, proposed_degeneracy long, "
    "changed_positions array<int>, binding_site_count long, original_exact_count long, original_exact_fraction double, proposed_exact_count long, proposed_exact_fraction double"
)


def propose(original: str, sites: dict[str, int], role: str, config: InclusivityConfig) -> dict:
    """Best expansion of one oligo under its degeneracy cap; sites by how often each occurs.

    A changed position covers all that was seen there. So a site is met by a set of changes just when
    it differs from the oligo at those positions only, and sites fall into few kinds by where.
    """
    own = to_masks(original)
    k = len(own)
    total = sum(sites.values())
    bits = own.astype(np.int64)
    size = lambda masks: int(np.prod([int(m).bit_count() for m in masks], dtype=object)) if len(masks) else 1
    base = size(bits)
    rows = np.array([to_masks(s) for s in sites], dtype=np.int64).reshape(-1, k)
    weight = list(sites.values())
    wrong = (rows & ~bits) != 0
    kinds: dict[frozenset, int] = {}
    for w, n in zip(wrong, weight, strict=True):
        key = frozenset((np.flatnonzero(w) + 1).tolist())
        kinds[key] = kinds.get(key, 0) + n
    exact = lambda changed: sum(n for need, n in kinds.items() if need <= changed)
    before = exact(frozenset())
    said = {
        "original_sequence": original, "proposed_sequence": original, "original_degeneracy": base, "proposed_degeneracy": base, "changed_positions": [], "binding_site_count": total,
        "original_exact_count": before, "original_exact_fraction": before / total if total else None, "proposed_exact_count": before, "proposed_exact_fraction": before / total if total else None,
    }
    if not total:
        return said | {"status": "UNCHANGED", "reason": "NO_GEOMETRIC_SITES"}
    if not (rows != bits).any():
        return said | {"status": "UNCHANGED", "reason": "NO_VARIATION"}
    union = np.bitwise_or.reduce(rows, axis=0) | bits
    changes = [i + 1 for i in range(k) if union[i] != bits[i]]
    if exact(frozenset(changes)) <= before:
        return said | {"status": "UNCHANGED", "reason": "NO_IMPROVEMENT"}
    if role != "PROBE" and not config.allow_primer_3_prime_degeneracy:
        changes = [p for p in changes if p < k - config.primer_3_prime_bases + 1]
    if exact(frozenset(changes)) <= before:
        return said | {"status": "REJECTED", "reason": "REJECTED_3_PRIME"}
    cap = config.max_probe_degeneracy if role == "PROBE" else config.max_primer_degeneracy
    # sets of changes within the cap grow one position at a time: a set over it has no fit superset
    level = [((), base)] if base <= cap else []
    best = None
    while level:
        following = []
        for changed, degeneracy in level:
            got = exact(frozenset(changed))
            if got > before:
                text = "".join(iupac.CODES[(union[i] if i + 1 in changed else bits[i]) - 1] for i in range(k))
                key = (-got, degeneracy, len(changed), text)
                if best is None or key < best[0]:
                    best = (key, text, changed, got)
            for p in changes:
                if not changed or p > changed[-1]:
                    more = degeneracy // int(bits[p - 1]).bit_count() * int(union[p - 1]).bit_count()
                    if more <= cap:
                        following.append(((*changed, p), more))
        level = following
    if best is None:
        return said | {"status": "REJECTED", "reason": "REJECTED_LIMIT"}
    (_, degeneracy, _, _), text, changed, got = best
    return said | {"status": "ACCEPTED", "reason": "ACCEPTED_IMPROVEMENT", "proposed_sequence": text, "proposed_degeneracy": degeneracy, "changed_positions": list(changed), "proposed_exact_count": got, "proposed_exact_fraction": got / total}


def proposals(bound: DataFrame, assays: DataFrame, config: InclusivityConfig) -> DataFrame:
    """One proposal for each assay and role, always. A group is the distinct sites of one oligo."""
    grouped = selected_sites(bound).groupBy("assay_id", "role", "site").agg(F.count(F.lit(1)).alias("n"))
    rows = long_oligos(assays).join(grouped, ["assay_id", "role"], "left")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sites = {s: int(n) for s, n in zip(pdf.site, pdf.n, strict=True) if isinstance(s, str)}
        first = pdf.iloc[0]
        return pd.DataFrame([{"assay_id": first.assay_id, "role": first.role} | propose(first.oligo, sites, first.role, config)])[[c.split()[0] for c in PROPOSAL_DDL.split(", ")]]

    return rows.groupBy("assay_id", "role").applyInPandas(run, PROPOSAL_DDL)


def proposed_compatibility(bound: DataFrame, proposals_: DataFrame, config: InclusivityConfig) -> DataFrame:
    """(assay_id, sequence_id, role, ...) of the proposed oligos at the sites already selected."""
    effective = F.when(F.col("status") == "ACCEPTED", F.col("proposed_sequence")).otherwise(F.col("original_sequence")).alias("effective_sequence")
    rows = selected_sites(bound).join(small(proposals_.select("assay_id", "role", effective)), ["assay_id", "role"])
    rows = rows.withColumn("mismatch_positions", iupac.mismatch_positions(F.col("effective_sequence"), F.col("site")))
    n = F.length("effective_sequence")
    fine = iupac.compatible(F.col("mismatch_positions"), n, F.col("role"), config.max_primer_mismatches, config.max_probe_mismatches, config.reject_primer_3_prime_mismatch, config.primer_3_prime_bases)
    tail = (F.col("role") != "PROBE") & F.exists("mismatch_positions", lambda p: p > n - config.primer_3_prime_bases)
    return rows.select("assay_id", "ordinal", "sequence_id", "role", "effective_sequence", "mismatch_positions", F.size("mismatch_positions").alias("mismatch_count"), (F.size("mismatch_positions") == 0).alias("exact_match"), tail.alias("three_prime_mismatch"), fine.alias("compatible"))


def assay_results(bound: DataFrame, proposed: DataFrame) -> DataFrame:
    """Bindings, without their sites, with each role's selected site and what the proposed oligos do there.

    (role)_hit_rank and original_(role)_compatible are of the selected sites, also where no geometry
    was found; proposed_(role)_compatible are null there, as nothing is proposed at such sites.
    """
    of = lambda role: F.try_element_at(F.filter("hits", lambda h: h["selected"] & (h["role"] == role)), F.lit(1))
    told = bound.select("*", *(of(r).alias(f"_{r}") for r in ROLES))
    ranks = [F.col(f"_{r}.hit_rank").alias(f"{r.lower()}_hit_rank") for r in ROLES]
    fits = [F.col(f"_{r}.compatible").alias(f"original_{r.lower()}_compatible") for r in ROLES]
    told = told.select(*(c for c in bound.columns if c != "hits"), *ranks, *fits)
    each = [F.bool_and(F.when(F.col("role") == r, F.col("compatible"))).alias(f"proposed_{r.lower()}_compatible") for r in ROLES]
    fine = proposed.groupBy("assay_id", "sequence_id", "ordinal").agg(*each, (F.count_if("compatible") == len(ROLES)).alias("_fine"))
    out = told.join(fine, ["assay_id", "sequence_id", "ordinal"], "left")
    return out.withColumn("proposed_compatible", F.col("geometry_found") & F.coalesce("_fine", F.lit(False))).drop("_fine")


def counts(results: DataFrame) -> DataFrame:
    return results.groupBy("assay_id").agg(
        F.count(F.lit(1)).alias("evaluation_sequence_count"), F.count_if("geometry_found").alias("geometry_count"),
        F.count_if("original_compatible").alias("original_compatible_count"), F.count_if("proposed_compatible").alias("proposed_compatible_count"),
    )
