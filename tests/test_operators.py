import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.functions import intervals, iupac, text
from strandweave.operators import align, cluster, conserve, contrast, inclusivity, match, qc, ranking, regions, specificity
from strandweave.operators import design as assay_design
from strandweave.plans.config import ConservationConfig, InclusivityConfig, PrimerDesignConfig, QCConfig, RankingConfig, RankingWeights, SpecificityConfig

BASES = {c: {b for i, b in enumerate("ACGT") if m >> i & 1} for m, c in enumerate(iupac.CODES, 1)}


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_codes(spark):
    r = one(spark, iupac.reverse_complement(F.lit("ARCT")).alias("rc"), iupac.degeneracy(F.lit("ARN")).alias("d"), iupac.mismatch_positions(F.lit("ARN"), F.lit("RAT")).alias("m"), iupac.symbol(F.lit(5)).alias("s"), iupac.invalid_position(F.lit("acUt")).alias("p"))
    assert (r.rc, r.d, r.m, r.s, r.p) == ("AGYT", 8, [1], "R", 3)
    for a in iupac.CODES:
        for b in iupac.CODES:
            assert ((iupac.CODES.index(b) + 1) & ~(iupac.CODES.index(a) + 1) == 0) == (BASES[b] <= BASES[a])
    with pytest.raises(Exception, match="position 2 in record x"):
        one(spark, iupac.normalize_or_raise(F.lit("AUCC"), "record x"))
    with pytest.raises(Exception, match="differ in length"):
        one(spark, iupac.mismatch_positions(F.lit("A"), F.lit("AA")))


def test_text_functions(spark):
    r = one(spark, text.slug(F.lit(" H5N1 (bird) ")).alias("a"), text.slug(F.lit("--")).alias("b"), text.strip_version(F.lit("NC_1.22")).alias("c"), text.redact(F.lit("x " + "ACGT" * 10 + " y")).alias("d"))
    assert tuple(r) == ("h5n1-bird", "dataset", "NC_1", "x [SEQUENCE_REDACTED] y")


def test_intervals(spark):
    rows = [(1, 100, 1200), (600, 699, 1200), (1150, 1200, 1200), (1, 50, 200)]
    a, b = intervals.expanded(F.col("s"), F.col("e"), F.col("n"), 300)
    got = [tuple(r) for r in spark.createDataFrame(rows, "s int, e int, n int").select(a, b).collect()]
    assert got == [(1, 300), (500, 799), (901, 1200), (1, 200)]
    r = one(spark, intervals.window_starts(F.lit(12), 5, 4).alias("a"), intervals.window_starts(F.lit(3), 5, 4).alias("b"), intervals.window_starts(F.lit(13), 5, 4).alias("c"))
    assert (r.a, r.b, r.c) == ([1, 5, 8], [1], [1, 5, 9])


def test_quality_control(spark):
    rows = [(0, "a", "ACGTACGTAC"), (1, "b", "ACGTACGTAC"), (2, "c", "ACGX"), (3, "d", "AC"), (4, "e", "NNNNNNNNAC"), (5, "f", "ACGTACGTACGTACGT"), (6, "g", "ACGX")]
    out = qc.evaluate(spark.createDataFrame(rows, "ordinal long, sequence_id string, sequence string"), QCConfig(5, 0.5, 10, 0.2))
    got = {r.sequence_id: (r.reason_codes or [r.status])[0] for r in out.collect()}
    assert got == {"a": "ACCEPTED", "b": "DUPLICATE_SEQUENCE", "c": "INVALID_NUCLEOTIDE", "d": "TOO_SHORT", "e": "EXCESSIVE_AMBIGUITY", "f": "INCONSISTENT_LENGTH", "g": "INVALID_NUCLEOTIDE"}


def aligned(spark, *rows):
    df = spark.createDataFrame([(i, f"s{i}", s) for i, s in enumerate(rows)], "ordinal long, sequence_id string, aligned_sequence string")
    cells = conserve.cells(df)
    return cells, conserve.coordinate_map(cells.where("ordinal = 0"))


def test_column_metrics(spark):
    cells, coords = aligned(spark, "AC-RT", "ACGAT", "TC-A-", "TCGAT")
    got = {r.alignment_position: r for r in conserve.position_metrics(cells, coords, 4).collect()}
    assert (got[1].major_symbol, got[1].entropy_bits, got[1].iupac_symbol) == ("A", 1.0, "W")  # tied: the reference's base
    assert (got[2].major_allele_frequency, got[2].entropy_bits, math.copysign(1, got[2].entropy_bits)) == (1.0, 0.0, 1.0)
    assert got[3].reference_position is None and got[3].coverage == 0.5 and got[3].gap_frequency == 0.5
    assert got[4].frequency_a == 0.875 and got[4].frequency_g == 0.125 and got[4].iupac_symbol == "R" and got[4].reference_position == 3
    assert got[5].depth == 3 and got[5].reference_position == 4
    c = conserve.consensus(conserve.position_metrics(cells, coords, 4)).first()
    assert (c.major_consensus, c.iupac_consensus) == ("ACAT", "WCRT")
    with pytest.raises(Exception, match="no bases"):
        cells, coords = aligned(spark, "A-", "C-")
        conserve.position_metrics(cells, coords, 2).collect()


def test_windows(spark):
    rows = [(i, float(v)) for i, v in enumerate([0.5, 0.25, 1, 1, 1, 0.5, 0.5, 1, 1, 1, 1, 0.75], 1)]
    pos = spark.createDataFrame(rows, "reference_position int, major_allele_frequency double").withColumns({"coverage": F.lit(0.9), "gap_frequency": F.lit(0.1), "entropy_bits": F.lit(0.6)})
    got = sorted((r.reference_start, r.reference_end, round(r.mean_conservation, 9), r.minimum_conservation) for r in conserve.windows(pos, 12, ConservationConfig(True, 5, 4)).collect())
    assert [(a, b) for a, b, _, _ in got] == [(1, 5), (5, 9), (8, 12)] and got[0][2:] == (0.75, 0.25)
    short = conserve.windows(pos, 12, ConservationConfig(True, 20, 4)).collect()
    assert [(r.reference_start, r.reference_end, r.position_count) for r in short] == [(1, 12, 12)]


def test_annotations(spark):
    part = "array<struct<start:int,end:int,strand:int,ref:string>>"
    rows = [("source", [(0, 9, 1, None)] * 2, {}), ("CDS", [(2, 5, 1, None), (8, 30, -1, None), (3, 3, 1, None), (0, 4, 1, "X")], {"gene": ["g"], "product": ["p"]}), ("misc", [(0, 2, 1, None)], {"gene": [""]})]
    kept, skipped = conserve.annotations(spark.createDataFrame(rows, f"type string, parts {part}, qualifiers map<string,array<string>>"), 10)
    assert [(r.type, r.start, r.end, r.label) for r in kept.collect()] == [("misc", 1, 2, "misc"), ("CDS", 3, 5, "g"), ("CDS", 9, 10, "g")]
    assert skipped.first().skipped == 4


def test_greedy_suppression(spark):
    rng = random.Random(2)
    rows = [(s, s + 29, round(rng.random(), 3)) for s in range(1, 400, 7)]
    df = spark.createDataFrame(rows, "reference_start int, reference_end int, score double")
    got = sorted((r.rank, r.reference_start) for r in regions.suppress(df, [-F.col("score"), F.col("reference_start")], 5, 0.3).collect())
    want = []
    for s, e, _ in sorted(rows, key=lambda r: (-r[2], r[0])):
        if all(max(0, min(e, e2) - max(s, s2) + 1) / 30 <= 0.3 for s2, e2 in want) and len(want) < 5:
            want.append((s, e))
    assert got == [(i, s) for i, (s, _) in enumerate(want, 1)]


def test_regions_without_metrics_fail(spark):
    names = "alignment_position int, reference_position int, major_allele_frequency double, coverage double, gap_frequency double"
    positions = spark.createDataFrame([(p, p, 0.5 if p in (12, 13, 20) else 1.0, 1.0, 0.0) for p in range(1, 50)], names)
    c = PrimerDesignConfig()
    spans = lambda *r: spark.createDataFrame([(f"r{i}", a, b) for i, (a, b) in enumerate(r)], "region_id string, reference_start int, reference_end int")
    assert sorted(map(tuple, regions.exclusions(spans((10, 30), (40, 45)), positions, c).collect())) == [("r0", 12, 13), ("r0", 20, 20)]
    for bad in ((40, 60), (200, 260)):
        with pytest.raises(Exception, match="no metrics for some positions of region r1"):
            regions.exclusions(spans((10, 30), bad), positions, c).collect()
    assert regions.exclusions(spans((10, 30)), positions.limit(0), c).count() == 0


def test_cluster_results_are_checked(spark):
    rows = [("c0", "a", True), ("c0", "b", False), ("c1", "b", False), ("c2", "x", True)]
    found = spark.createDataFrame(rows, "cluster_id string, sequence_id string, is_representative boolean")
    got = sorted(map(tuple, cluster.result_gaps(found, spark.createDataFrame([("a",), ("b",), ("d",)], "sequence_id string")).collect()))
    assert got == [("IN_NO_CLUSTER", "d"), ("IN_SEVERAL_CLUSTERS", "b"), ("REPRESENTATIVES", "c1"), ("UNKNOWN_SEQUENCE", "x")]


def brute_hits(seq, oligo, role, config):
    turn = str.maketrans(iupac.CODES, iupac.PAIRED)
    rc = lambda s: s.translate(turn)[::-1]
    out = []
    for orientation, view in (("FORWARD", seq), ("REVERSE_COMPLEMENT", rc(seq))):
        for i in range(len(view) - len(oligo) + 1):
            site = view[i : i + len(oligo)]
            site = rc(site) if role == "REVERSE" else site
            bad = [p for p, (o, t) in enumerate(zip(oligo, site, strict=True), 1) if not BASES[t] <= BASES[o]]
            cap = config.max_probe_mismatches if role == "PROBE" else config.max_primer_mismatches
            if len(bad) <= cap and not (role != "PROBE" and config.reject_primer_3_prime_mismatch and any(p > len(oligo) - config.primer_3_prime_bases for p in bad)):
                start = i + 1 if orientation == "FORWARD" else len(seq) - i - len(oligo) + 1
                out.append((orientation, start, start + len(oligo) - 1, i + 1, tuple(bad)))
    return sorted(out)


@pytest.mark.parametrize("reject", [True, False])
@pytest.mark.parametrize("part", [4_000_000, 37])
def test_scan_equals_brute_force(spark, monkeypatch, reject, part):
    rng = random.Random(11)
    monkeypatch.setattr(match, "PART", part)
    seqs = ["".join(rng.choice("ACGTACGTACGTRYN") for _ in range(n)) for n in (150, 90, 7, 0)]
    oligos = [match.Oligo("a", "FORWARD", seqs[0][20:28]), match.Oligo("a", "PROBE", seqs[0][40:49]), match.Oligo("a", "REVERSE", seqs[1][30:38]), match.Oligo("b", "PROBE", "AC"), match.Oligo("b", "FORWARD", "NNNNNACG")]
    config = SpecificityConfig(True, reject_primer_3_prime_mismatch=reject, primer_3_prime_bases=3)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(seqs)], "ordinal long, sequence string")
    got = match.scan_compatible(df, oligos, config, ["ordinal"]).collect()
    for i, s in enumerate(seqs):
        for o in oligos:
            mine = sorted((r.orientation, r.source_start, r.source_end, r.oriented_start, tuple(r.mismatch_positions)) for r in got if r.ordinal == i and r.assay_id == o.assay_id and r.role == o.role and r.source_end - r.source_start + 1 == len(o.sequence))
            assert mine == brute_hits(s, o.sequence, o.role, config)


def test_amplicons_do_not_depend_on_the_cap(spark):
    rng = random.Random(3)
    rows = []
    for role in match.ROLES:
        for _ in range(40):
            s = rng.randrange(1, 3000)
            rows.append(("d", "a", 0, "s", "FORWARD", role, s, s + 19, s, s + 19, 0, [], 0, match.ROLES.index(role) + 1))
    names = ["dataset", "assay_id", "ordinal", "sequence_id", "orientation", "role", "oriented_start", "oriented_end", "source_start", "source_end", "mismatch_count", "mismatch_positions", "assay_ordinal", "role_ordinal"]
    hits = spark.createDataFrame(rows, "dataset string, assay_id string, ordinal int, sequence_id string, orientation string, role string, oriented_start int, oriented_end int, source_start int, source_end int, mismatch_count int, mismatch_positions array<int>, assay_ordinal int, role_ordinal int").dropDuplicates(["role", "oriented_start"])
    held = [r.asDict() for r in hits.collect()]
    config = SpecificityConfig(True, max_hits_per_oligo_per_dataset=3, max_amplicon_size=400)
    out = specificity.amplicons(hits, config)
    got = sorted((r.forward_source_start, r.reverse_source_start, [(s.start, s.end) for s in r.probe_source_sites]) for r in out.collect())
    want = []
    for f in (h for h in held if h["role"] == "FORWARD"):
        for r in (h for h in held if h["role"] == "REVERSE"):
            if f["oriented_end"] < r["oriented_start"] and r["oriented_end"] - f["oriented_start"] + 1 <= 400:
                want.append((f["source_start"], r["source_start"], sorted((p["source_start"], p["source_end"]) for p in held if p["role"] == "PROBE" and f["oriented_end"] < p["oriented_start"] and p["oriented_end"] < r["oriented_start"])))
    assert got == sorted(want) and names
    kept = specificity.retained(hits, config)
    assert kept.count() == 9
    ranked = specificity.with_ranks(out, kept)
    assert ranked.count() == out.count() and ranked.where("forward_hit_rank is null").count() > 0


def naive_local(q, s):
    neg = -1e9
    h = [[[0, neg, neg] for _ in range(len(s) + 1)] for _ in range(len(q) + 1)]
    best = 0.0
    for i in range(1, len(q) + 1):
        for j in range(1, len(s) + 1):
            up, left, diag = h[i - 1][j], h[i][j - 1], h[i - 1][j - 1]
            x = max(up[0] - 1, up[1] - 0.5, up[2] - 1)
            y = max(left[0] - 1, left[2] - 0.5, left[1] - 1)
            h[i][j] = [max(0, max(diag) + (q[i - 1] == s[j - 1])), x, y]
            best = max(best, *h[i][j])
    return best


def test_local_similarity_equals_naive():
    rng = random.Random(4)
    for _ in range(60):
        q, s = ("".join(rng.choice("ACG") for _ in range(rng.randrange(1, 14))) for _ in range(2))
        codes = np.frombuffer(q.encode(), np.uint8)[None, :]
        assert contrast.local_scores(codes, np.frombuffer(s.encode(), np.uint8))[0] == naive_local(q, s)
    assert contrast.similarities(["ACGT", "AAAA", ""], "TTACGTTT") == [1.0, 0.25, 0.0]


def path_score(a, b, path):
    i = j = 0
    total = 0.0
    for op, k in path:
        if op == 0:
            total += sum(align.MATCH if x == y else align.MISMATCH for x, y in zip(a[i : i + k], b[j : j + k], strict=True))
            i, j = i + k, j + k
        else:
            total -= align.OPEN + align.EXTEND * k
            i, j = (i + k, j) if op == 1 else (i, j + k)
    assert (i, j) == (len(a), len(b))
    return total


def naive_global(a, b):
    from functools import cache

    @cache
    def best(i, j, state):
        if i == j == 0:
            return 0.0 if state == 0 else -1e9
        out = -1e9
        if state == 0 and i and j:
            out = max(best(i - 1, j - 1, s) for s in range(3)) + (align.MATCH if a[i - 1] == b[j - 1] else align.MISMATCH)
        if state == 1 and i:
            out = max(best(i - 1, j, s) - (align.EXTEND if s == 1 else align.OPEN + align.EXTEND) for s in range(3))
        if state == 2 and j:
            out = max(best(i, j - 1, s) - (align.EXTEND if s == 2 else align.OPEN + align.EXTEND) for s in range(3))
        return out

    return max(best(len(a), len(b), s) for s in range(3))


def test_global_alignment_is_optimal():
    rng = random.Random(9)
    for _ in range(120):
        a = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 12)))
        b = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 12)))
        score, path = align.global_path(a, b)
        assert score == pytest.approx(path_score(a, b, path)) and score == pytest.approx(naive_global(a, b))


def test_alignment_in_little_memory_is_optimal_too(monkeypatch):
    rng = random.Random(4)
    monkeypatch.setattr(align, "CELLS", 6)
    for _ in range(150):
        a = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 24)))
        b = a[: rng.randrange(12)] + a[rng.randrange(12, 20) :] if rng.random() < 0.5 else "".join(rng.choice("ACGT") for _ in range(rng.randrange(0, 16)))
        score, path = align.best_path(a, b)
        assert score == pytest.approx(path_score(a, b, path)) and score == pytest.approx(naive_global(a, b)), (a, b)


def test_star_alignment_turns_and_merges(spark):
    rng = random.Random(1)
    ref = "".join(rng.choice("ACGT") for _ in range(80))
    seqs = [ref, ref[:30] + "GG" + ref[30:], align.reverse_text(ref[:50] + ref[53:])]
    df = spark.createDataFrame([(i, f"s{i}", s) for i, s in enumerate(seqs)], "ordinal long, sequence_id string, sequence string")
    out = align.align_all(df, "s0")
    got = {r.sequence_id: r for r in out.collect()}
    assert {len(r.aligned_sequence) for r in got.values()} == {82} and got["s2"].orientation == "REVERSE_COMPLEMENT"
    assert align.problems(out, df, "s0").count() == 0
    assert align.choose_reference(df) == ("s1", "automatic")


def test_identity_is_the_longest_common_subsequence():
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last, row = row, [0]
            for j, y in enumerate(b, 1):
                row.append(last[j - 1] + 1 if x == y else max(last[j], row[-1]))
        return row[-1] / len(a)

    rng = random.Random(3)
    for _ in range(300):
        a, b = sorted(("".join(rng.choice("ACGN") for _ in range(rng.randrange(1, 40))) for _ in range(2)), key=len)
        assert cluster.identity(a, b) == plain(a, b)
    assert cluster.identity("", "A") == 0.0


def test_clusters_equal_one_pass_in_order(spark):
    rng = random.Random(8)
    seqs = []
    for _ in range(6):
        base = "".join(rng.choice("ACGT") for _ in range(60))
        for _ in range(5):
            cut = rng.randrange(0, 4)
            seqs.append("".join(rng.choice("ACGT") if rng.random() < 0.04 else c for c in base)[cut:])
    rng.shuffle(seqs)
    df = spark.createDataFrame([(i, f"s{i}", s) for i, s in enumerate(seqs)], "ordinal long, sequence_id string, sequence string")
    got = {r.sequence_id: r.representative_id for r in cluster.clusters(df, 0.9).collect()}
    order = sorted(range(len(seqs)), key=lambda i: (-len(seqs[i]), i))
    leaders, want = [], {}
    for i in order:
        near = [(cluster.identity(seqs[i], seqs[k]), -order.index(k), k) for k in leaders]
        near = [x for x in near if x[0] >= 0.9]
        want[f"s{i}"] = f"s{i}" if not near else None
        leaders += [] if near else [i]
    assert {k for k, v in want.items() if v} == {k for k, v in got.items() if k == v}
    assert set(got) == set(want)


def brute_proposal(original, sites, role, c):
    from itertools import combinations

    fits = lambda cand, site: all(BASES[t] <= BASES[o] for o, t in zip(cand, site, strict=True))
    exact = lambda cand: sum(n for s, n in sites.items() if fits(cand, s))
    cover = {frozenset(v): k for k, v in BASES.items()}
    changes = [(i, cover[frozenset(BASES[o].union(*(BASES[s[i]] for s in sites)))]) for i, o in enumerate(original)]
    changes = [(i, x) for i, x in changes if x != original[i] and (role == "PROBE" or i + 1 <= len(original) - c.primer_3_prime_bases)]
    cap = c.max_probe_degeneracy if role == "PROBE" else c.max_primer_degeneracy
    best = None
    for n in range(len(changes) + 1):
        for some in combinations(changes, n):
            cand = list(original)
            for i, x in some:
                cand[i] = x
            cand = "".join(cand)
            size = math.prod(len(BASES[x]) for x in cand)
            if size <= cap and exact(cand) > exact(original):
                key = (-exact(cand), size, n, cand)
                best = min(best or key, key)
    return best


def test_proposals_equal_brute_force():
    rng = random.Random(6)
    config = InclusivityConfig(True, primer_3_prime_bases=2)
    seen = set()
    for _ in range(150):
        original = "".join(rng.choice("ACGT") for _ in range(8))
        sites = {}
        for _ in range(rng.randrange(0, 8)):
            s = "".join(rng.choice("ACGTR") if rng.random() < 0.2 else c for c in original)
            sites[s] = sites.get(s, 0) + rng.randrange(1, 5)
        for role in ("FORWARD", "PROBE"):
            got = inclusivity.propose(original, sites, role, config)
            best = brute_proposal(original, sites, role, config) if sites else None
            seen.add(got["reason"])
            assert (got["status"] == "ACCEPTED") == (best is not None)
            if best:
                assert (-got["proposed_exact_count"], got["proposed_degeneracy"], len(got["changed_positions"]), got["proposed_sequence"]) == best
    assert {"NO_GEOMETRIC_SITES", "NO_VARIATION", "ACCEPTED_IMPROVEMENT", "REJECTED_3_PRIME"} <= seen


def evidence(spark, **changes):
    row = {
        "assay_id": "a", "pair_penalty": 1.0, "primer3_index": 0, "inclusivity_status": "COMPLETE", "evaluation_sequence_count": 10, "original_compatible_count": 9, "specificity_status": "COMPLETE",
        "compatible_hit_count": 2, "plausible_count": 0, "detectable_count": 0, "accepted_roles": ["PROBE"], "rejected_roles": [], "accepted_degeneracies": [(1, 2)],
        "mean_conservation": 0.95, "minimum_conservation": 0.8, "mean_coverage": 1.0, "mean_gap_frequency": 0.0, "mean_entropy_bits": 0.2,
    } | changes
    kinds = {"assay_id": "string", "pair_penalty": "double", "inclusivity_status": "string", "specificity_status": "string", "accepted_roles": "array<string>", "rejected_roles": "array<string>", "accepted_degeneracies": "array<struct<original:int,proposed:int>>"}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {kinds.get(k, 'double' if isinstance(v, float) else 'int')}" for k, v in row.items()))


def test_classes_scores_and_missing_evidence(spark):
    r = ranking.rank(evidence(spark), RankingConfig()).first()
    assert r.classification == "REVIEW" and [x.code for x in r.reasons] == ["INCLUSIVITY_BELOW_PASS", "IUPAC_PROPOSAL_ACCEPTED", "ISOLATED_OFF_TARGET_HITS"]
    parts = (0.9, 0.96, (0.95 + 0.8 + 1 + 1 + 0.9) / 5, 0.5, 2.5 / 3)
    assert r.final_score == pytest.approx(100 * sum(w * p for w, p in zip((0.35, 0.25, 0.2, 0.1, 0.1), parts, strict=True)))
    assert ranking.rank(evidence(spark, original_compatible_count=8), RankingConfig()).first().classification == "HIGH_RISK"
    ok = ranking.rank(evidence(spark, original_compatible_count=10, compatible_hit_count=0), RankingConfig()).first()
    assert ok.classification == "IN SILICO PASS" and ranking.recommended(ranking.rank(evidence(spark, original_compatible_count=10), RankingConfig())).first().assay_id == "a"
    lost = ranking.rank(evidence(spark, pair_penalty=None), RankingConfig(weights=RankingWeights(0.5, 0.25, 0.15, 0.0, 0.1))).first()
    assert lost.final_score is None and lost.missing_components == ["primer3_quality"] and "EVIDENCE_INCOMPLETE" in [x.code for x in lost.reasons]
    guarded = ranking.rank(evidence(spark, original_compatible_count=10), RankingConfig(), ["NO_ASSAYS"]).first()
    assert guarded.final_score is None and guarded.missing_components == ["execution"] and guarded.classification == "REVIEW"
    hot = ranking.rank(evidence(spark, detectable_count=1, plausible_count=2), RankingConfig()).first()
    assert hot.specificity_score == 0.0 and hot.reasons[0].evidence == {"detectable_off_target_count": "1", "plausible_off_target_count": "2"}


def test_boulder_and_temperature(spark):
    rows = spark.createDataFrame([("id", "10,20", None)], "SEQUENCE_ID string, PRIMER_LEFT_0 string, X string")
    enc = assay_design.boulder_encode(rows, ["SEQUENCE_ID", "PRIMER_LEFT_0", "X"])
    assert enc.first().value == "SEQUENCE_ID=id\nPRIMER_LEFT_0=10,20\n=\n"
    tags = assay_design.boulder_decode(enc)
    assert tuple(tags.select(*assay_design.oligo_location(F.col("tags"), "LEFT", F.lit(0))).first()) == (11, 30)
    tm = one(spark, assay_design.melting_temperature(F.lit("ACGTTGCATGGATCCATGCA")).alias("a"), assay_design.melting_temperature(F.lit("GCGCGCGCGCGCGCGCGCGC")).alias("b"), assay_design.melting_temperature(F.lit("ACGN")).alias("c"))
    assert 45 < tm.a < 70 < tm.b and tm.c is None
    assert PrimerDesignConfig().product_size_max == 200


def test_clstr_lines(spark):
    lines = [">Cluster 0", "0\t100nt, >a... *", "1\t98nt, >b... at +/97.96%", ">Cluster 1", "0\t90nt, >c... *"]
    got = [(r.cluster, r.sequence_id, r.is_representative, r.identity, r.strand) for r in cluster.parse_clstr(spark.createDataFrame(list(enumerate(lines)), "number int, value string")).orderBy("number").collect()]
    assert got == [(0, "a", True, None, None), (0, "b", False, pytest.approx(0.9796), "+"), (1, "c", True, None, None)]


def test_heat_map_tells_datasets_never_evaluated(spark):
    windows = spark.createDataFrame([(1, 60), (31, 90)], "reference_start int, reference_end int")
    panel = spark.createDataFrame([("a b.c", 0, "CRITICAL", 3), ("none", 1, "CRITICAL", 2), ("empty", 2, "IMPORTANT", 0)], "dataset string, panel_ordinal int, criticality string, sequence_count long")
    found = spark.createDataFrame([(1, 60, "a b.c", 0.5, "s1"), (31, 90, "a b.c", 0.75, "s2")], "reference_start int, reference_end int, dataset string, similarity double, sequence_id string")
    rows = contrast.evidence(windows, panel, found)
    got = contrast.heat_map(rows, ["a b.c", "none", "empty", "gone"]).collect()
    assert [tuple(r)[2:] for r in got] == [("observed", "no-match", "unevaluated", "missing")] * 2
    assert {r.similarity for r in rows.where("dataset = 'empty'").collect()} == {0.0}
