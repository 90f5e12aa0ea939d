"""Further queries: proposals, published tables, integrity checks and reports, each with its SQL.

Registered with those of ``queries``, whose derived tables they use.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.functions import iupac, text
from strandweave.operators import cluster, conserve, contrast, inclusivity, ranking, regions, specificity
from strandweave.operators import design as assay_design
from strandweave.plans import queries as own
from strandweave.plans import report
from strandweave.plans.config import RankingConfig
from strandweave.plans.queries import _RC, ALN, AMP, DESIGN, INCL, INCSQL, OFF, OFFSQL, POS, RANKSQL, REG, SIMSQL, VARSQL, WIN, query, table
from strandweave.plans.storage import materialize, shared_folder
from strandweave.sources import genbank, panel, sinks

CODES = iupac.CODES
_S = lambda x: f"coalesce(({x})::VARCHAR, '')"
_LINE = lambda *parts: " || chr(9) || ".join(_S(p) for p in parts)


# proposals --------------------------------------------------------------------------------------

PROPSQL = f"""{INCSQL}, selx AS (SELECT k.assay_id, k.role, k.k, k.ordinal, k.sequence_id, CASE role WHEN 'REVERSE' THEN {_RC.format('t')} ELSE t END AS site
  FROM kept k JOIN bound b ON k.assay_id = b.assay_id AND k.ordinal = b.ordinal AND k.orientation = b.orientation AND k.p = CASE role WHEN 'FORWARD' THEN fp WHEN 'PROBE' THEN pp ELSE rp END),
olig AS (SELECT assay_id, role, k, CASE role WHEN 'REVERSE' THEN {_RC.format('pat')} ELSE pat END AS o FROM spot),
place AS (SELECT unnest(generate_series(1, 22)) AS i),
cellx AS (SELECT s.assay_id, s.role, s.k, s.ordinal, i, instr('{CODES}', substr(o, i, 1)) AS om, instr('{CODES}', substr(site, i, 1)) AS tm FROM selx s JOIN olig USING (assay_id, role) JOIN place ON i <= s.k),
need AS (SELECT assay_id, role, ordinal, sum(CASE WHEN (tm & ~om) <> 0 THEN 1::BIGINT << (i - 1) ELSE 0 END)::BIGINT AS w, bool_or(tm <> om) AS varies FROM cellx GROUP BY ALL),
uni AS (SELECT o.assay_id, o.role, o.k, i, instr('{CODES}', substr(o, i, 1)) AS om, coalesce(bit_or(tm), 0) | instr('{CODES}', substr(o, i, 1)) AS um
  FROM olig o JOIN place ON i <= o.k LEFT JOIN cellx c USING (assay_id, role, i) GROUP BY o.assay_id, o.role, o.k, i, o.o),
chg AS (SELECT assay_id, role, i, bit_count(um) AS f, role = 'PROBE' OR i <= k - {INCL.primer_3_prime_bases} AS ok, CASE role WHEN 'PROBE' THEN {INCL.max_probe_degeneracy} ELSE {INCL.max_primer_degeneracy} END AS cap FROM uni WHERE um <> om),
masks AS (SELECT assay_id, role, coalesce(sum(1::BIGINT << (i - 1)), 0)::BIGINT AS every, coalesce(sum(CASE WHEN ok THEN 1::BIGINT << (i - 1) END), 0)::BIGINT AS allowed FROM chg GROUP BY ALL),
grow(assay_id, role, mask, last, deg) AS (SELECT assay_id, role, 0::BIGINT, 0::BIGINT, 1::BIGINT FROM olig
  UNION ALL SELECT g.assay_id, g.role, g.mask | (1::BIGINT << (c.i - 1)), c.i, g.deg * c.f FROM grow g JOIN chg c ON c.assay_id = g.assay_id AND c.role = g.role AND c.ok AND c.i > g.last AND g.deg * c.f <= c.cap),
base0 AS (SELECT o.assay_id, o.role, o.o, count(n.w) AS total, count(*) FILTER (n.w = 0) AS before, coalesce(bool_or(n.varies), false) AS varies,
    count(*) FILTER ((n.w & ~coalesce(m.every, 0)) = 0) AS with_all, count(*) FILTER ((n.w & ~coalesce(m.allowed, 0)) = 0) AS with_allowed
  FROM olig o LEFT JOIN need n USING (assay_id, role) LEFT JOIN masks m USING (assay_id, role) GROUP BY o.assay_id, o.role, o.o),
got AS (SELECT g.assay_id, g.role, g.mask, g.deg, count(*) AS hit FROM grow g JOIN need n ON n.assay_id = g.assay_id AND n.role = g.role AND (n.w & ~g.mask) = 0 GROUP BY ALL),
fit AS (SELECT got.*, (SELECT string_agg(substr('{CODES}', (CASE WHEN (got.mask >> (u.i - 1)) & 1 = 1 THEN u.um ELSE u.om END)::INT, 1), '' ORDER BY u.i) FROM uni u WHERE u.assay_id = got.assay_id AND u.role = got.role) AS txt
  FROM got JOIN base0 USING (assay_id, role) WHERE hit > before),
best AS (SELECT * FROM fit QUALIFY row_number() OVER (PARTITION BY assay_id, role ORDER BY hit DESC, deg, bit_count(mask), txt) = 1),
prop AS (SELECT b.assay_id, b.role, b.o, b.total, b.before, x.mask, x.deg, x.hit, x.txt, CASE WHEN total = 0 THEN 'NO_GEOMETRIC_SITES' WHEN NOT varies THEN 'NO_VARIATION' WHEN with_all <= before THEN 'NO_IMPROVEMENT'
    WHEN with_allowed <= before THEN 'REJECTED_3_PRIME' WHEN x.hit IS NULL THEN 'REJECTED_LIMIT' ELSE 'ACCEPTED_IMPROVEMENT' END AS reason FROM base0 b LEFT JOIN best x USING (assay_id, role)),
offer AS (SELECT *, reason = 'ACCEPTED_IMPROVEMENT' AS yes, CASE WHEN reason LIKE 'NO%' THEN 'UNCHANGED' WHEN reason LIKE 'REJ%' THEN 'REJECTED' ELSE 'ACCEPTED' END AS status FROM prop),
told AS (SELECT s.assay_id, s.sequence_id, s.ordinal, s.role, s.k, e.txt AS effective, list_filter(generate_series(1, s.k), lambda j: (instr('{CODES}', substr(s.site, j, 1)) & ~instr('{CODES}', substr(e.txt, j, 1))) <> 0) AS bad
  FROM selx s JOIN (SELECT assay_id, role, CASE WHEN yes THEN txt ELSE o END AS txt FROM offer) e USING (assay_id, role)),
toldc AS (SELECT *, CASE role WHEN 'PROBE' THEN len(bad) <= {INCL.max_probe_mismatches} ELSE len(bad) <= {INCL.max_primer_mismatches} AND len(list_filter(bad, lambda j: j > k - {INCL.primer_3_prime_bases})) = 0 END AS fine FROM told)"""
PROPSQL = "RECURSIVE " + PROPSQL


@query(f"""WITH {PROPSQL} SELECT assay_id, role, o AS original_sequence, CASE WHEN yes THEN txt ELSE o END AS proposed_sequence, status, reason, 1::BIGINT AS original_degeneracy, CASE WHEN yes THEN deg ELSE 1 END::BIGINT AS proposed_degeneracy,
  CASE WHEN yes THEN array_to_string(list_filter(generate_series(1, 22), lambda j: (mask >> (j - 1)) & 1 = 1), ',') ELSE '' END AS changed_positions, total AS binding_site_count, before AS original_exact_count,
  round(before / nullif(total, 0), 6) AS original_exact_fraction, CASE WHEN yes THEN hit ELSE before END AS proposed_exact_count, round(CASE WHEN yes THEN hit ELSE before END / nullif(total, 0), 6) AS proposed_exact_fraction FROM offer""")
def q25_degeneracy_proposals(spark, sf):
    rows = inclusivity.proposals(own._bound(spark, sf), own._assays(spark, sf), INCL)
    return own._rounded(rows.withColumn("changed_positions", F.array_join(F.col("changed_positions").cast("array<string>"), ",")), "original_exact_fraction", "proposed_exact_fraction")


def _proposed(spark, sf):
    bound = materialize(own._bound(spark, sf), "bound")
    return bound, inclusivity.proposed_compatibility(bound, inclusivity.proposals(bound, own._assays(spark, sf), INCL), INCL)


@query(f"""WITH {PROPSQL} SELECT assay_id, sequence_id, role, effective AS effective_sequence, array_to_string(bad, ',') AS places, len(bad) AS mismatch_count, len(bad) = 0 AS exact_match,
  role <> 'PROBE' AND len(list_filter(bad, lambda j: j > k - {INCL.primer_3_prime_bases})) > 0 AS three_prime_mismatch, fine AS compatible FROM toldc""")
def q26_proposed_compat(spark, sf):
    rows = _proposed(spark, sf)[1]
    return rows.select("assay_id", "sequence_id", "role", "effective_sequence", F.array_join(F.col("mismatch_positions").cast("array<string>"), ",").alias("places"), F.col("mismatch_count").cast("long").alias("mismatch_count"), "exact_match", "three_prime_mismatch", "compatible")


RESSQL = f"""{PROPSQL}, size AS (SELECT ordinal, length(s) AS len FROM ev),
pick AS (SELECT k.assay_id, k.ordinal, k.role, k.hit_rank, k.mm, k.tail FROM kept k JOIN bound b ON k.assay_id = b.assay_id AND k.ordinal = b.ordinal AND k.orientation = b.orientation AND k.p = CASE role WHEN 'FORWARD' THEN fp WHEN 'PROBE' THEN pp ELSE rp END
  UNION ALL SELECT assay_id, ordinal, role, hit_rank, mm, tail FROM (SELECT * FROM kept k WHERE NOT EXISTS (FROM bound b WHERE b.assay_id = k.assay_id AND b.ordinal = k.ordinal)
    QUALIFY row_number() OVER (PARTITION BY assay_id, ordinal, role ORDER BY mm, tail, away, orientation, p) = 1)),
wide AS (SELECT assay_id, ordinal, max(hit_rank) FILTER (role = 'FORWARD') AS r1, max(hit_rank) FILTER (role = 'PROBE') AS r2, max(hit_rank) FILTER (role = 'REVERSE') AS r3, bool_and(mm <= 2 AND tail = 0) FILTER (role = 'FORWARD') AS c1,
    bool_and(mm <= 1) FILTER (role = 'PROBE') AS c2, bool_and(mm <= 2 AND tail = 0) FILTER (role = 'REVERSE') AS c3 FROM pick GROUP BY ALL),
later AS (SELECT assay_id, ordinal, bool_and(fine) FILTER (role = 'FORWARD') AS d1, bool_and(fine) FILTER (role = 'PROBE') AS d2, bool_and(fine) FILTER (role = 'REVERSE') AS d3 FROM toldc GROUP BY ALL),
result AS (SELECT a.assay_id, e.ordinal, e.sequence_id, b.orientation, b.ordinal IS NOT NULL AS geometry, CASE b.orientation WHEN 'FORWARD' THEN b.fp WHEN 'REVERSE_COMPLEMENT' THEN z.len - b.rp - 18 END AS a1,
    CASE b.orientation WHEN 'FORWARD' THEN b.rp + 19 WHEN 'REVERSE_COMPLEMENT' THEN z.len - b.fp + 1 END AS a2, b.amplicon_size, r1, r2, r3, c1, c2, c3, coalesce(b.fine, false) AS was, d1, d2, d3, coalesce(d1 AND d2 AND d3, false) AS will
  FROM (SELECT DISTINCT assay_id FROM spot) a CROSS JOIN ev e JOIN size z USING (ordinal) LEFT JOIN bound b ON b.assay_id = a.assay_id AND b.ordinal = e.ordinal LEFT JOIN wide w ON w.assay_id = a.assay_id AND w.ordinal = e.ordinal LEFT JOIN later l ON l.assay_id = a.assay_id AND l.ordinal = e.ordinal)"""


def _results(spark, sf) -> DataFrame:
    return inclusivity.assay_results(*_proposed(spark, sf))


@query(f"""WITH {RESSQL} SELECT {_LINE('assay_id', 'sequence_id', 'orientation', 'geometry', 'a1', 'a2', 'amplicon_size', 'r1', 'r2', 'r3', 'c1', 'c2', 'c3', 'was', 'd1', 'd2', 'd3', 'will')} AS value FROM result""")
def q46_inclusivity_table(spark, sf):
    return sinks.lines(_results(spark, sf), sinks.ASSAY_INCLUSIVITY)


@query(f"""WITH {RESSQL} SELECT assay_id, count(*) AS evaluation_sequence_count, count(*) FILTER (geometry) AS geometry_count, count(*) FILTER (was) AS original_compatible_count, count(*) FILTER (will) AS proposed_compatible_count FROM result GROUP BY assay_id""")
def q47_inclusivity_counts(spark, sf):
    return inclusivity.counts(_results(spark, sf))


_BASES = lambda m: "array_to_string(list_filter([" + ", ".join(f"CASE WHEN (({m})::BIGINT & {1 << i}) <> 0 THEN '{b}' END" for i, b in enumerate("ACGT")) + "], lambda x: x IS NOT NULL), ',')"


@query(f"""WITH {PROPSQL}, vary AS (SELECT c.assay_id, c.role, c.k, c.i, any_value(om) AS om, bit_or(tm) AS um, count(*) FILTER (tm <> om) AS n, string_agg(e.sequence_id, ',' ORDER BY c.ordinal) FILTER (tm <> om) AS ids FROM cellx c JOIN ev e USING (ordinal) GROUP BY c.assay_id, c.role, c.k, c.i HAVING count(*) FILTER (tm <> om) > 0)
SELECT {_LINE('assay_id', 'role', 'i', f"substr('{CODES}', om::INT, 1)", _BASES('om'), f"substr('{CODES}', um::INT, 1)", _BASES('um'), 'ids', 'n', 'n / (SELECT count(*) FROM supplier)', "role <> 'PROBE' AND i > k - 5")} AS value FROM vary""")
def q48_variation_table(spark, sf):
    bound = materialize(own._bound(spark, sf), "bound")
    return sinks.lines(inclusivity.variations(bound, own._assays(spark, sf), table(spark, sf, "supplier").count(), INCL, with_ids=True), sinks.VARIATIONS)


@query(f"""WITH {PROPSQL} SELECT {_LINE('assay_id', 'role', 'o', 'CASE WHEN yes THEN txt ELSE o END', 'status', 'reason', '1', 'CASE WHEN yes THEN deg ELSE 1 END', "CASE WHEN yes THEN array_to_string(list_filter(generate_series(1, 22), lambda j: (mask >> (j - 1)) & 1 = 1), ',') ELSE '' END", 'total', 'before', 'before / nullif(total, 0)', 'CASE WHEN yes THEN hit ELSE before END', 'CASE WHEN yes THEN hit ELSE before END / nullif(total, 0)')} AS value FROM offer""")
def q49_proposal_table(spark, sf):
    return sinks.lines(inclusivity.proposals(own._bound(spark, sf), own._assays(spark, sf), INCL), sinks.PROPOSALS)


# off-targets ------------------------------------------------------------------------------------


def _hits(spark, sf) -> DataFrame:
    return materialize(own._hits(spark, sf), "hits")


KEPTSQL = f"""{AMP}, kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY dataset, assay_id, role ORDER BY assay_ordinal, ordinal, ro, orientation, ss, se, n, places) AS hit_rank FROM hit) WHERE hit_rank <= 20),
pr AS (SELECT amp.assay_id, amp.ordinal, amp.orientation, amp.fs, amp.rs, p.os, p.ss, p.se, k.hit_rank FROM amp JOIN hit p ON p.role = 'PROBE' AND p.assay_id = amp.assay_id AND p.ordinal = amp.ordinal AND p.orientation = amp.orientation AND p.os > fe AND p.oe < rs
  LEFT JOIN kept k ON k.role = 'PROBE' AND k.assay_id = p.assay_id AND k.ordinal = p.ordinal AND k.orientation = p.orientation AND k.ss = p.ss),
prs AS (SELECT assay_id, ordinal, orientation, fs, rs, string_agg(ss || '-' || se, ',' ORDER BY ss) AS sites, string_agg(hit_rank::VARCHAR, ',' ORDER BY ss) AS ranks FROM pr GROUP BY ALL),
ends AS (SELECT h.assay_id, h.role, h.ordinal, h.orientation, h.os, h.ss, h.se, k.hit_rank FROM hit h LEFT JOIN kept k ON k.role = h.role AND k.assay_id = h.assay_id AND k.ordinal = h.ordinal AND k.orientation = h.orientation AND k.ss = h.ss),
full_amp AS (SELECT a.*, f.ss AS f1, f.se AS f2, r.ss AS r1, r.se AS r2, f.hit_rank AS frank, r.hit_rank AS rrank, prs.sites, prs.ranks FROM amp a JOIN ends f ON f.role = 'FORWARD' AND f.assay_id = a.assay_id AND f.ordinal = a.ordinal AND f.orientation = a.orientation AND f.os = a.fs
  JOIN ends r ON r.role = 'REVERSE' AND r.assay_id = a.assay_id AND r.ordinal = a.ordinal AND r.orientation = a.orientation AND r.os = a.rs
  LEFT JOIN prs ON prs.assay_id = a.assay_id AND prs.ordinal = a.ordinal AND prs.orientation = a.orientation AND prs.fs = a.fs AND prs.rs = a.rs)"""


@query(f"""WITH {KEPTSQL} SELECT {_LINE('dataset', 'assay_id', 'sequence_id', 'orientation', 'source_start', 'source_end', 'amplicon_size', 'f1', 'f2', 'r1', 'r2', 'sites', 'frank', 'rrank', 'ranks', "'true'", 'sites IS NOT NULL')} AS value FROM full_amp""")
def q50_amplicon_table(spark, sf):
    hits = _hits(spark, sf)
    rows = specificity.with_ranks(specificity.amplicons(hits, OFF), specificity.retained(hits, OFF))
    return sinks.lines(rows.withColumnRenamed("dataset", "dataset_name"), sinks.AMPLICONS)


@query(f"""WITH {KEPTSQL} SELECT {_LINE('dataset', 'assay_id', 'sequence_id', 'role', 'orientation', 'hit_rank', 'ss', 'se', "array_to_string(places, ',')", 'n', 'n = 0', "role <> 'PROBE' AND len(list_filter(places, lambda j: j > k - 5)) > 0", "'true'")} AS value
  FROM (SELECT kept.*, oligo.k FROM kept JOIN oligo USING (assay_id, role))""")
def q51_hit_table(spark, sf):
    return sinks.lines(specificity.retained(_hits(spark, sf), OFF).withColumnRenamed("dataset", "dataset_name"), sinks.OFF_TARGET_HITS)


@query(f"""WITH {AMP}, det AS (SELECT DISTINCT amp.dataset, amp.assay_id, amp.ordinal, amp.orientation, amp.fs, amp.rs FROM amp JOIN hit p ON p.role = 'PROBE' AND p.assay_id = amp.assay_id AND p.ordinal = amp.ordinal AND p.orientation = amp.orientation AND p.os > fe AND p.oe < rs)
SELECT (SELECT count(*) FROM hit) AS compatible_hit_count, (SELECT count(*) FROM amp) AS plausible_amplicon_count, (SELECT count(*) FROM det) AS detectable_amplicon_count, (SELECT count(*) FROM (SELECT DISTINCT dataset, assay_id FROM det)) AS detectable_dataset_assay_count""")
def q52_specificity_summary(spark, sf):
    hits = _hits(spark, sf)
    return specificity.summary(hits, specificity.amplicons(hits, OFF))


@query(f"""WITH {AMP}, det AS (SELECT DISTINCT amp.dataset, amp.assay_id, amp.ordinal, amp.orientation, amp.fs, amp.rs FROM amp JOIN hit p ON p.role = 'PROBE' AND p.assay_id = amp.assay_id AND p.ordinal = amp.ordinal AND p.orientation = amp.orientation AND p.os > fe AND p.oe < rs)
SELECT a.assay_id, d.dataset, (SELECT count(*) FROM hit h WHERE h.dataset = d.dataset AND h.assay_id = a.assay_id) AS hit_count, (SELECT count(*) FROM amp h WHERE h.dataset = d.dataset AND h.assay_id = a.assay_id) AS plausible_count,
  (SELECT count(*) FROM det h WHERE h.dataset = d.dataset AND h.assay_id = a.assay_id) AS detectable_count FROM (SELECT DISTINCT assay_id FROM oligo) a CROSS JOIN (SELECT DISTINCT dataset FROM seq) d""")
def q53_counts_by_dataset(spark, sf):
    hits = _hits(spark, sf)
    return specificity.by_dataset(hits, specificity.amplicons(hits, OFF), own.sequences(spark, sf).select("dataset").distinct(), own._designed(spark, sf).select("assay_id").distinct())


# design -----------------------------------------------------------------------------------------

LOOSE = replace(
    DESIGN, product_size_min=50, product_size_max=60, primer=replace(DESIGN.primer, min_size=16, opt_size=18, max_size=20, min_tm=35.0, opt_tm=48.0, max_tm=60.0, min_gc_percent=20.0, max_gc_percent=80.0),
    probe=replace(DESIGN.probe, min_size=14, opt_size=16, max_size=18, min_tm=30.0, opt_tm=45.0, max_tm=60.0, min_gc_percent=10.0, max_gc_percent=90.0),
)
_NEAR = {k: assay_design._pairs(t) for k, t in (("h", assay_design.ENTHALPY), ("s", assay_design.ENTROPY))}
_SUM = lambda t: f"list_sum(list_transform(generate_series(1, size - 1), lambda i: list_extract([{', '.join(map(str, _NEAR[t].values()))}]::DOUBLE[], list_position([{', '.join(repr(k) for k in _NEAR[t])}], substr(q, i, 2)))))"
_END = lambda i: f"(CASE WHEN substr(q, 1, 1) IN ('A', 'T') THEN {assay_design.ENDS['A'][i]} ELSE {assay_design.ENDS['C'][i]} END + CASE WHEN substr(q, size, 1) IN ('A', 'T') THEN {assay_design.ENDS['A'][i]} ELSE {assay_design.ENDS['C'][i]} END)"
_FROM = lambda c: f"{c.min_size} AS least, {c.opt_size} AS opt, {c.max_size} AS most, {c.min_tm} AS tm0, {c.opt_tm} AS tm1, {c.max_tm} AS tm2, {c.min_gc_percent} AS gc0, {c.max_gc_percent} AS gc2"
OLIGOSQL = f"""RECURSIVE {own.SQL['q15_region_greedy'].partition('WITH RECURSIVE ')[2].rpartition('SELECT list_position')[0]}, area AS (SELECT 'region-' || lpad(list_position(starts, a)::VARCHAR, 3, '0') AS region_id, a, b FROM reg, final WHERE list_contains(starts, a)),
no_go AS (SELECT reference_position AS p FROM pos WHERE NOT ({own._BIND})), tpl AS (SELECT string_agg(major_symbol, '' ORDER BY reference_position) AS t FROM pos),
kind AS (SELECT 'FORWARD' AS role, {_FROM(LOOSE.primer)} UNION ALL SELECT 'REVERSE', {_FROM(LOOSE.primer)} UNION ALL SELECT 'PROBE', {_FROM(LOOSE.probe)}),
spots AS (SELECT region_id, kind.*, b, unnest(generate_series(a, b)) AS st FROM area, kind), sized AS (SELECT *, unnest(generate_series(least, most)) AS size FROM spots),
cut AS (SELECT *, st + size - 1 AS en, CASE role WHEN 'REVERSE' THEN reverse(translate(substr(t, st, size), 'ACGT', 'TGCA')) ELSE substr(t, st, size) END AS q FROM sized, tpl
  WHERE st + size - 1 <= b AND NOT EXISTS (SELECT 1 FROM no_go WHERE p BETWEEN st AND st + size - 1)),
warm AS (SELECT *, 1000.0::DOUBLE * ({_END(0)} + {_SUM('h')}) / ({_END(1)} + {_SUM('s')} + 0.368::DOUBLE * (size - 1) * ln({assay_design.SALT_MOLAR}) + {assay_design.GAS}::DOUBLE * ln({assay_design.OLIGO_MOLAR / 4!r}::DOUBLE)) - 273.15 AS tm, 100.0 * length(regexp_replace(q, '[^GC]', '', 'g')) / size AS gc FROM cut),
oligo3 AS (SELECT region_id, role, q, st, en, abs(tm - tm1) + abs(size - opt) AS pen FROM warm WHERE tm BETWEEN tm0 AND tm2 AND gc BETWEEN gc0 AND gc2),
made AS (SELECT f.region_id, f.q AS forward, p.q AS probe, r.q AS reverse, r.en - f.st + 1 AS product_size, f.pen + r.pen AS pair_penalty, row_number() OVER (PARTITION BY f.region_id ORDER BY round(f.pen + r.pen + p.pen, 9), f.st, f.en, r.st, r.en, p.st, p.en) AS n
  FROM oligo3 f JOIN oligo3 r ON f.role = 'FORWARD' AND r.role = 'REVERSE' AND f.region_id = r.region_id AND f.en < r.st AND r.en - f.st + 1 BETWEEN 50 AND 60 JOIN oligo3 p ON p.role = 'PROBE' AND p.region_id = f.region_id AND f.en < p.st AND p.en < r.st)"""


@query(f"""WITH {OLIGOSQL} SELECT region_id || '-assay-' || lpad(n::VARCHAR, 3, '0') AS assay_id, region_id, (n - 1)::INT AS primer3_index, forward, probe, reverse, product_size::INT AS product_size, round(pair_penalty, 6) AS pair_penalty FROM made WHERE n <= {LOOSE.assays_per_region}""")
def q45_design_assays(spark, sf):
    pos = own.positions(spark, sf)
    chosen = regions.select_regions(own.windows(spark, sf), pos, own.ALN_LENGTH, DESIGN).select("region_id", "reference_start", "reference_end", "peak_start", "peak_end")
    found = assay_design.assays(chosen, conserve.consensus(pos).select(F.col("major_consensus").alias("sequence")), regions.exclusions(chosen, pos, DESIGN), LOOSE)
    return found.select("assay_id", "region_id", "primer3_index", F.col("forward.sequence").alias("forward"), F.col("probe.sequence").alias("probe"), F.col("reverse.sequence").alias("reverse"), "product_size", F.round("pair_penalty", 6).alias("pair_penalty"))


# control plane ----------------------------------------------------------------------------------

_STAGES = "('input'),('panel'),('qc'),('clustering'),('alignment'),('conservation'),('contrastive_conservation'),('primer_design'),('inclusivity'),('specificity'),('ranking')"


@query(own.SQL["q35_stage_descendants"].rpartition(" SELECT ")[0] + f""", s(stage) AS (VALUES {_STAGES}), x AS (SELECT a.stage AS root, b.stage, a.stage = b.stage AS me, EXISTS (FROM r WHERE r.stage = a.stage AND r.descendant = b.stage) AS below FROM s a CROSS JOIN s b)
SELECT 'from' AS policy, root, stage, CASE WHEN me OR below THEN 'FORCED' ELSE 'REUSE' END AS action FROM x UNION ALL SELECT 'force', root, stage, CASE WHEN me OR below THEN 'FORCED' ELSE 'REUSE' END FROM x
UNION ALL SELECT 'broken', root, stage, CASE WHEN me THEN 'RUN' WHEN below THEN 'FORCED' ELSE 'REUSE' END FROM x UNION ALL SELECT 'fresh', '', stage, 'RUN' FROM s""")
def q54_planned_actions(spark, sf):
    from strandweave.plans import dag

    told = [("fresh", "", dag.plan(dag.Policy(), lambda s: True))]
    for root in dag.STAGES:
        told += [
            ("from", root, dag.plan(dag.Policy(from_step=root), lambda s: True)), ("force", root, dag.plan(dag.Policy(resume=True, force_step=root), lambda s: True)),
            ("broken", root, dag.plan(dag.Policy(resume=True), lambda s, root=root: s != root)),
        ]
    return spark.createDataFrame([(p, r, s, a) for p, r, plan in told for s, a in plan.items()], "policy string, root string, stage string, action string")


@query("""SELECT c_custkey, CASE WHEN regexp_matches(k, '(^|_)(token|api_key|secret|password|authorization|email)$') THEN '[REDACTED]' ELSE left(regexp_replace(v, '[ACGTURYSWKMBDHVNacgturyswkmbdhvn-]{40,}', '[SEQUENCE_REDACTED]', 'g'), 1000) END AS value
FROM (SELECT c_custkey, replace(lower(['Api-Key', 'note', 'user_email', 'tokens'][(c_custkey % 4 + 1)::INT]), '-', '_') AS k, c_mktsegment || ' ' || repeat('ac-gt', (c_custkey % 12)::INT) || ' ' || c_name AS v FROM customer)""")
def q55_log_cleaning(spark, sf):
    from strandweave.plans.recorder import clean

    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(k, F.element_at(F.array(*map(F.lit, ("Api-Key", "note", "user_email", "tokens"))), (k % 4 + 1).cast("int")).alias("name"), F.concat("c_mktsegment", F.lit(" "), F.expr("repeat('ac-gt', int(c_custkey % 12))"), F.lit(" "), "c_name").alias("value"))

    def run(batches):
        import pyarrow as pa

        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([clean(v, n) for n, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)])], names=["c_custkey", "value"])

    return rows.mapInArrow(run, "c_custkey long, value string")


@query("""SELECT n_nationkey AS panel_ordinal, upper(n_name) AS name, '  ' || lower(n_name) || ' ' AS dataset, ['CRITICAL', 'IMPORTANT', 'BACKGROUND'][(n_nationkey % 3 + 1)::INT] AS criticality FROM nation WHERE n_nationkey % 2 = 0""")
def q56_panel_binding(spark, sf):
    nations = own._panel(spark, sf)
    roles = F.when(F.col("panel_ordinal") % 2 == 0, F.array(F.lit("DESIGN"), F.lit("CHALLENGE"))).otherwise(F.array(F.lit("DESIGN")))
    entries = nations.select(F.upper("dataset").alias("name"), "criticality", roles.alias("roles"), "panel_ordinal")
    bound = panel.bind_challenges(entries, nations.select(F.concat(F.lit("  "), F.lower("dataset"), F.lit(" ")).alias("dataset")))
    return bound.select(F.col("panel_ordinal").cast("long").alias("panel_ordinal"), "name", "dataset", "criticality")


# ranking ----------------------------------------------------------------------------------------

_BY_SEVERITY = "array_to_string(list_transform(list_sort(list_transform(rs, lambda x: CASE WHEN starts_with(x, 'HIGH') THEN '1' WHEN starts_with(x, 'REV') THEN '2' ELSE '3' END || x)), lambda x: substr(x, 2)), ';')"


@query(f"WITH {RANKSQL} SELECT assay_id, {_BY_SEVERITY} AS reasons FROM fin")
def q57_reason_order(spark, sf):
    return ranking.classify(own._rank_evidence(spark, sf), RankingConfig()).select("assay_id", own._reason_text(F.col("reasons")).alias("reasons"))


@query(f"""WITH {RANKSQL}, g AS (SELECT *, list_append(rs, 'REVIEW:execution:RUN_EVIDENCE_INCOMPLETE') AS rs2 FROM fin)
SELECT assay_id, CASE WHEN classification = 'HIGH_RISK' THEN 'HIGH_RISK' ELSE 'REVIEW' END AS classification, 'INCOMPLETE' AS score_status, {_BY_SEVERITY.replace('(rs,', '(rs2,')} AS reasons,
  array_to_string(list_sort(list_filter(['execution', CASE WHEN skip OR empty THEN 'inclusivity' END, CASE WHEN pen IS NULL THEN 'primer3_quality' END, CASE WHEN skip OR empty THEN 'robustness' END, CASE WHEN nospec THEN 'specificity' END], lambda x: x IS NOT NULL)), ',') AS missing FROM g""")
def q58_execution_guard(spark, sf):
    rows = ranking.rank(own._rank_evidence(spark, sf), RankingConfig(), ["NO_ASSAYS", "SPECIFICITY_NOT_COMPLETE"])
    return rows.select("assay_id", "classification", "score_status", own._reason_text(F.col("reasons")).alias("reasons"), F.array_join("missing_components", ",").alias("missing"))


@query(f"""WITH {RANKSQL} SELECT arg_min(assay_id, (final_score IS NULL, -coalesce(final_score, 0), -s1, coalesce(pen, 1e9), k % 5, assay_id)) AS assay_id FROM fin WHERE classification = 'IN SILICO PASS'""")
def q59_recommended(spark, sf):
    return ranking.recommended(ranking.rank(own._rank_evidence(spark, sf), RankingConfig()))


@query(f"""WITH {RANKSQL} SELECT assay_id, CASE WHEN k % 23 = 0 THEN 'MORE_COMPATIBLE_THAN_EVALUATED' WHEN k % 29 = 0 THEN 'MORE_DETECTABLE_THAN_PLAUSIBLE' WHEN k % 31 = 0 THEN 'REGION_SHARE' WHEN k % 37 = 0 THEN 'PENALTY' END AS problem FROM fin
WHERE NOT skip AND NOT empty AND NOT nospec AND (k % 23 = 0 OR k % 29 = 0 OR k % 31 = 0 OR k % 37 = 0)""")
def q60_evidence_contradictions(spark, sf):
    k = F.substring_index("assay_id", "-", -1).cast("long")
    rows = own._rank_evidence(spark, sf).where((F.col("inclusivity_status") == "COMPLETE") & (F.col("evaluation_sequence_count") > 0) & (F.col("specificity_status") == "COMPLETE"))
    rows = rows.withColumns({
        "original_compatible_count": F.when(k % 23 == 0, 21).otherwise(F.col("original_compatible_count")), "detectable_count": F.when(k % 29 == 0, 9).otherwise(F.col("detectable_count")),
        "mean_coverage": F.when(k % 31 == 0, 1.5).otherwise(F.col("mean_coverage")), "pair_penalty": F.when(k % 37 == 0, -1.0).otherwise(F.col("pair_penalty")),
    })
    return ranking.invalid_evidence(rows)


@query(f"""WITH {RANKSQL}, r AS (SELECT *, row_number() OVER (ORDER BY list_position(['IN SILICO PASS', 'REVIEW', 'HIGH_RISK'], classification), final_score IS NULL, final_score DESC NULLS LAST, s1 DESC NULLS LAST, pen NULLS LAST, k % 5, assay_id) AS rank FROM fin)
SELECT {_LINE('rank', 'assay_id', "'r'", 'classification', "CASE WHEN final_score IS NULL THEN 'INCOMPLETE' ELSE 'COMPLETE' END", 'pen', 'CASE WHEN m THEN okc END', f"replace(regexp_replace({_BY_SEVERITY}, '[A-Z_]+:[a-z]+:', '', 'g'), ':', '')")} AS value FROM r""")
def q61_ranking_table(spark, sf):
    rows = ranking.rank(own._rank_evidence(spark, sf).withColumn("region_id", F.lit("r")), RankingConfig())
    rows = rows.withColumn("reason_codes", F.array_join("reasons.code", ";"))
    return sinks.lines(rows, ("rank", "assay_id", "region_id", "classification", "score_status", "pair_penalty", "original_compatible_count", "reason_codes"))


@query(f"""WITH {RANKSQL}, obs AS (SELECT assay_id, k, m, okc FROM fin WHERE k % 3 <> 1)
SELECT coalesce(o.assay_id, f.assay_id) AS assay_id, CASE WHEN o.m THEN 20 ELSE -1 END::BIGINT AS observed_sequences, CASE WHEN o.m THEN o.okc - CASE WHEN o.k % 7 = 0 THEN 1 ELSE 0 END ELSE -1 END::BIGINT AS observed_compatible,
  coalesce(o.m AND o.k % 7 <> 0, false) OR (o.m IS NOT TRUE AND NOT f.m AND f.skip) AS reconciled FROM fin f LEFT JOIN (SELECT * FROM obs WHERE m) o ON o.assay_id = f.assay_id""")
def q62_observations(spark, sf):
    ev = own._rank_evidence(spark, sf)
    k = F.substring_index("assay_id", "-", -1).cast("long")
    seen = ev.where((F.col("inclusivity_status") == "COMPLETE") & (F.col("evaluation_sequence_count") > 0) & (k % 3 != 1))
    ok = F.col("original_compatible_count") - F.when(k % 7 == 0, 1).otherwise(0)
    rows = seen.select("assay_id", ok.alias("ok"), F.explode(F.sequence(F.lit(1), F.lit(20))).alias("i")).select("assay_id", (F.col("i") <= F.col("ok")).alias("original_compatible"))
    return report.observations(rows, ev).fillna(-1, ["observed_sequences", "observed_compatible"]).select("assay_id", "observed_sequences", "observed_compatible", "reconciled")


# conservation, contrast, regions ----------------------------------------------------------------


@query(f"""WITH {SIMSQL} SELECT {_LINE('reference_start', 'reference_end', "CASE WHEN o % 5 = 0 THEN '\"a \"\"' || dataset || '\"\"\"' ELSE dataset END", 'criticality', "o % 4", "CASE WHEN sim > 0 THEN 'x' END", "''", 'round(sim, 6)')} AS value FROM ds""")
def q63_contrast_dataset_table(spark, sf):
    rows = own._evidence(spark, sf).withColumns({"similarity": F.round("similarity", 6), "sequence_count": (F.col("panel_ordinal") % 4).cast("long"), "orientation": F.lit(None).cast("string"), "sequence_id": F.when(F.col("similarity") > 0, F.col("sequence_id"))})
    named = rows.withColumn("dataset_name", F.when(F.col("panel_ordinal") % 5 == 0, F.concat(F.lit('a "'), "dataset", F.lit('"'))).otherwise(F.col("dataset"))).withColumnsRenamed({"sequence_id": "best_sequence_id", "orientation": "best_orientation"})
    return sinks.lines(named, sinks.CONTRAST_DATASETS, quoted=True)


_CFIT = f"""{SIMSQL}, fit AS (SELECT *, least(greatest({own._MID}, 1), {own.ALN_LENGTH - own._LEN + 1})::INT AS a FROM summ JOIN win USING (reference_start, reference_end) WHERE round(mean_c, 12) >= {DESIGN.min_mean_conservation} AND min_c >= {DESIGN.min_minimum_conservation}
  AND round(cov, 12) >= {DESIGN.min_mean_coverage} AND round(gap, 12) <= {DESIGN.max_mean_gap_frequency} AND round(ent, 12) <= {DESIGN.max_mean_entropy_bits} AND usable / n >= {DESIGN.min_usable_fraction}),
lead AS (SELECT a, wc, wi, worst, reference_start AS peak FROM fit QUALIFY row_number() OVER (PARTITION BY a ORDER BY coalesce(wc, -1), coalesce(wi, -1), coalesce(worst, -1), -round(mean_c, 12), round(ent, 12), reference_start) = 1),
cand AS (SELECT l.*, avg(major) AS rc, avg(entropy) AS re FROM lead l JOIN pos ON reference_position BETWEEN a AND a + {own._LEN - 1} GROUP BY ALL)"""


@query(f"""WITH RECURSIVE {_CFIT}, ordered AS (SELECT *, row_number() OVER (ORDER BY coalesce(wc, -1), coalesce(wi, -1), coalesce(worst, -1), -round(rc, 12), round(re, 12), a) AS i FROM cand),
chosen(i, starts) AS (SELECT 0::BIGINT, []::INT[] UNION ALL SELECT o.i, CASE WHEN len(starts) < {DESIGN.max_candidate_regions} AND len(list_filter(starts, lambda s: greatest(0, {own._LEN} - abs(s - a)) / {own._LEN}.0 > {DESIGN.max_region_overlap_fraction})) = 0 THEN list_append(starts, a) ELSE starts END
  FROM chosen JOIN ordered o ON o.i = chosen.i + 1), final AS (SELECT starts FROM chosen ORDER BY i DESC LIMIT 1)
SELECT 'contrast-region-' || lpad(list_position(starts, a)::VARCHAR, 3, '0') AS region_id, a AS reference_start, peak AS peak_start, round(wc, 6) AS worst_critical_similarity FROM cand, final WHERE list_contains(starts, a)""")
def q64_contrast_selection(spark, sf):
    c = contrast.candidates(own._summaries(spark, sf), own.positions(spark, sf), own.ALN_LENGTH, DESIGN)
    return own._rounded(contrast.select_candidates(c, DESIGN).select("region_id", "reference_start", "peak_start", "worst_critical_similarity"), "worst_critical_similarity")


@query(f"WITH {POS} SELECT {_LINE('alignment_position', 'reference_position', 'reference_base', 'depth', 'round(coverage, 6)', 'round(vA / (12.0 * depth), 6)', 'round(vC / (12.0 * depth), 6)', 'round(vG / (12.0 * depth), 6)', 'round(vT / (12.0 * depth), 6)', 'round(gap, 6)', 'round(major, 6)', 'round(entropy, 6)', 'major_symbol', 'iupac_symbol')} AS value FROM pos".replace("12.0", "12.0::DOUBLE"))
def q65_position_table(spark, sf):
    named = own.positions(spark, sf).withColumnsRenamed({"major_symbol": "major_consensus", "iupac_symbol": "iupac_consensus"})
    shares = ("coverage", "frequency_a", "frequency_c", "frequency_g", "frequency_t", "gap_frequency", "major_allele_frequency", "entropy_bits")
    return sinks.lines(named.withColumns({n: F.round(n, 6) for n in shares}), sinks.POSITIONS)


@query(f"WITH {WIN} SELECT {_LINE('reference_start', 'reference_end', 'n', 'round(mean_c, 6)', 'round(min_c, 6)', 'round(cov, 6)', 'round(gap, 6)', 'round(ent, 6)')} AS value FROM win")
def q66_window_table(spark, sf):
    return sinks.lines(own.windows(spark, sf).withColumns({n: F.round(n, 6) for n in sinks.WINDOWS[3:]}), sinks.WINDOWS)


@query(f"""WITH RECURSIVE {own.SQL['q15_region_greedy'].partition('WITH RECURSIVE ')[2].rpartition('SELECT list_position')[0]}
SELECT {_LINE("'region-' || lpad(list_position(starts, a)::VARCHAR, 3, '0')", 'list_position(starts, a)', 'a', 'b', 'peak_start', 'peak_end', 'n', 'usable', 'round(usable / n, 6)', 'round(mean_c, 6)')} AS value FROM reg, final WHERE list_contains(starts, a)""")
def q67_region_table(spark, sf):
    rows = regions.select_regions(own.windows(spark, sf), own.positions(spark, sf), own.ALN_LENGTH, DESIGN)
    return sinks.lines(rows.withColumns({n: F.round(n, 6) for n in ("usable_fraction", "mean_conservation")}), sinks.REGIONS[:10])


@query(f"""WITH {POS}, k AS (SELECT reference_position AS p, reference_position - row_number() OVER (ORDER BY reference_position) AS r FROM pos WHERE entropy > 0.5) SELECT min(p)::BIGINT AS start, max(p)::BIGINT AS "end", count(*) AS n FROM k GROUP BY r""")
def q68_curve_segments(spark, sf):
    points = own.positions(spark, sf).select("reference_position", F.when(F.col("entropy_bits") > 0.5, F.col("entropy_bits")).alias("entropy_bits"))
    out = report.curve_segments(points, "reference_position", "entropy_bits")
    return out.select(F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "n")


@query(own.SQL["q16_exclusion_islands"].rpartition("SELECT region_id")[0] + """SELECT region_id, string_agg((a - 1) || ',' || (b - a + 1), ' ' ORDER BY a) AS tag FROM (SELECT region_id, min(p) AS a, max(p) AS b FROM bad GROUP BY region_id, island) GROUP BY region_id""")
def q69_exclusion_tags(spark, sf):
    return regions.excluded_tags(own.QUERIES["q16_exclusion_islands"](spark, sf))


@query(f"""WITH {ALN}, odd AS (SELECT 's' || s_suppkey AS "at" FROM supplier WHERE s_suppkey % 7 = 3), moved AS (SELECT unnest([5, 6]) AS "at")
SELECT 'WIDTH' AS problem, "at" FROM odd UNION ALL SELECT 'REPEATED_SEQUENCE', 's2' UNION ALL SELECT 'COORDINATES', "at"::VARCHAR FROM moved""")
def q70_alignment_input_problems(spark, sf):
    """The alignment with a letter taken from some rows, a row told twice and two coordinates changed."""
    rows = own.alignment(spark, sf).groupBy("ordinal", "sequence_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("alignment_position", "symbol"))), lambda x: x["symbol"]), "").alias("aligned_sequence"))
    rows = rows.withColumn("aligned_sequence", F.when(F.col("ordinal") % 7 == 3, F.left("aligned_sequence", F.lit(own.ALN_LENGTH - 1))).otherwise(F.col("aligned_sequence")))
    rows = materialize(rows.unionByName(rows.where("ordinal = 2")), "aligned")
    coordinates = conserve.coordinate_map(conserve.cells(rows.where("sequence_id = 's1'")))
    coordinates = coordinates.withColumn("reference_base", F.when(F.col("alignment_position").isin(5, 6), F.lit("?")).otherwise(F.col("reference_base")))
    return conserve.input_problems(rows, coordinates, "s1")


# sources, clusters, design tools ----------------------------------------------------------------


@query("""SELECT 'G' || s_suppkey || '.' || (s_suppkey % 3 + 1) AS sequence_id, 32::BIGINT AS n, upper(translate(md5('q' || s_suppkey), '0123456789abcdef', 'acgtacgtacgtacgt')) AS sequence, CASE WHEN s_suppkey % 2 = 0 THEN 'gene ' || s_suppkey ELSE 'a long product name ' || s_suppkey END AS label,
  CASE WHEN s_suppkey % 4 < 2 THEN 5 ELSE 1 END::BIGINT AS first_start, CASE WHEN s_suppkey % 4 < 2 THEN 10 + s_suppkey % 20 ELSE 3 END::BIGINT AS first_end, CASE WHEN s_suppkey % 4 < 2 THEN -1 ELSE 1 END::BIGINT AS strand, CASE WHEN s_suppkey % 4 < 2 THEN 1 ELSE 2 END::BIGINT AS n_parts FROM supplier""")
def q71_genbank_scan(spark, sf):
    """GenBank records written as text and read back: ids, letters, and the second feature's parts and label."""
    k = F.col("s_suppkey")
    letters = F.translate(F.md5(F.concat(F.lit("q"), k.cast("string")).cast("binary")), "0123456789abcdef", "acgtacgtacgtacgt")
    where = F.when(k % 4 < 2, F.concat(F.lit("complement(<5.."), (10 + k % 20).cast("string"), F.lit(")"))).otherwise("join(1..3,\n                     8..>12)")
    label = F.when(k % 2 == 0, F.concat(F.lit('/gene="gene '), k.cast("string"), F.lit('"'))).otherwise(F.concat(F.lit('/product="a long\n                     product name '), k.cast("string"), F.lit('"')))
    record = F.concat(
        F.lit("LOCUS       G"), k.cast("string"), F.lit(" 32 bp DNA\nACCESSION   G"), k.cast("string"), F.lit("\nVERSION     G"), k.cast("string"), F.lit("."), (k % 3 + 1).cast("string"),
        F.lit("\nFEATURES             Location/Qualifiers\n     source          1..32\n     CDS             "), where, F.lit("\n                     "), label,
        F.lit("\nORIGIN\n        1 "), F.regexp_replace(letters, "(.{10})", "$1 "), F.lit("\n//"),
    )
    path = shared_folder(spark, "genbank")
    table(spark, sf, "supplier").select(record.alias("value")).write.text(path)
    f = F.col("features")[1]
    rows = genbank.read(spark, path).select("sequence_id", F.length("sequence").cast("long").alias("n"), "sequence", text.feature_label(f["qualifiers"], f["type"]).alias("label"), f["parts"].alias("p"))
    part = F.col("p")[0]
    return rows.select("sequence_id", "n", "sequence", "label", (part["start"] + 1).cast("long").alias("first_start"), part["end"].cast("long").alias("first_end"), part["strand"].cast("long").alias("strand"), F.size("p").cast("long").alias("n_parts"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 4 < 2 THEN 'gene' ELSE 'CDS' END AS type, greatest(a + 1, 1)::BIGINT AS start, least(b, 100)::BIGINT AS "end" FROM (SELECT s_suppkey, s_suppkey % 130 - 20 AS a, s_suppkey % 130 + 5 AS b FROM supplier) WHERE greatest(a + 1, 1) <= least(b, 100) AND s_suppkey % 5 <> 0""")
def q72_annotations(spark, sf):
    k = F.col("s_suppkey")
    part = F.struct((k % 130 - 20).cast("int").alias("start"), (k % 130 + 5).cast("int").alias("end"), F.lit(1).alias("strand"), F.lit(None).cast("string").alias("ref"))
    rows = table(spark, sf, "supplier").select(F.when(k % 5 == 0, "source").when(k % 4 < 2, "gene").otherwise("CDS").alias("type"), F.array(part).alias("parts"), F.create_map(F.lit("gene"), F.array(k.cast("string"))).alias("qualifiers"))
    marks, _ = conserve.annotations(rows, 100)
    return marks.select(F.col("label").cast("long").alias("s_suppkey"), "type", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query("""WITH x AS (SELECT c_custkey AS k, c_nationkey AS c, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i FROM customer), d AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS cluster FROM (SELECT DISTINCT c FROM x))
SELECT cluster::BIGINT AS cluster, 'customer-' || k AS sequence_id, i = 1 AS is_representative, CASE WHEN i > 1 THEN round((80 + k % 20) / 100.0, 4)::DOUBLE END AS identity, CASE WHEN i > 1 AND k % 2 = 0 THEN '-' WHEN i > 1 AND k % 3 = 0 THEN '+' END AS strand FROM x JOIN d USING (c)""")
def q73_cluster_lines(spark, sf):
    from pyspark.sql import Window

    from strandweave.plans.storage import number_rows

    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(k, F.col("c_nationkey").alias("c")).withColumn("i", F.row_number().over(Window.partitionBy("c").orderBy("c_custkey")))
    sign = F.when(k % 2 == 0, "-/").when(k % 3 == 0, "+/").otherwise("")
    said = F.when(F.col("i") == 1, "*").otherwise(F.concat(F.lit("at "), sign, F.format_string("%.2f", (80 + k % 20).cast("double")), F.lit("%")))
    member = rows.select("c", "i", F.concat((F.col("i") - 1).cast("string"), F.lit("\t100nt, >customer-"), k.cast("string"), F.lit("... "), said).alias("value"))
    heads = rows.select("c").distinct().select("c", F.lit(0).alias("i"), F.lit(">Cluster 7").alias("value"))
    lines = number_rows(member.unionByName(heads), "number", "c", "i").select("number", "value")
    out = cluster.parse_clstr(lines)
    return out.select("cluster", "sequence_id", "is_representative", F.round("identity", 4).alias("identity"), "strand")


@query("""SELECT 'DUPLICATE_ID' AS problem, 'o' || o_custkey AS sequence_id FROM orders GROUP BY o_custkey HAVING count(*) > 1 UNION ALL SELECT 'NOT_EVALUATED', 'o' || o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)
UNION ALL SELECT 'NO_RECORD', 'o' || c_custkey FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'TOO_SHORT', 'o' || o_custkey FROM orders WHERE length(repeat('A', (o_orderkey % 12)::INT)) < 10""")
def q74_cluster_input_gaps(spark, sf):
    rows = table(spark, sf, "orders").select(F.concat(F.lit("o"), F.col("o_custkey").cast("string")).alias("sequence_id"), F.expr("repeat('A', int(o_orderkey % 12))").alias("sequence"))
    wanted = table(spark, sf, "customer").where("c_custkey % 3 <> 0").select(F.concat(F.lit("o"), F.col("c_custkey").cast("string")).alias("sequence_id"))
    return cluster.input_gaps(rows, wanted, cluster.word_length(0.95))


@query("""WITH x AS (SELECT o_orderkey AS k, o_orderkey % 300 AS a FROM orders) SELECT 'r' || k AS region_id, CASE WHEN k % 11 = 0 THEN 'TOOL_ERROR' WHEN k % 13 = 0 THEN 'RETURNED_COUNT' END AS problem FROM x WHERE k % 11 = 0 OR k % 13 = 0
UNION ALL SELECT 'r' || k, CASE WHEN k % 17 = 0 THEN 'OUTSIDE_REGION' WHEN k % 23 = 0 THEN 'ORDER' WHEN k % 19 = 0 THEN 'PRODUCT_SIZE' END FROM x WHERE k % 13 <> 0 AND (k % 17 = 0 OR k % 19 = 0 OR k % 23 = 0)
UNION ALL SELECT 'absent', 'MISSING_RECORD'""")
def q75_tool_results(spark, sf):
    """Boulder-IO answers of an oligo tool for a region an order, some of them wrong in known ways."""
    k = F.col("o_orderkey")
    a = k % 300
    at = lambda n: n.cast("string")
    oligo = lambda s: F.lit("ACGTACGTACGTACGTACGT")
    rows = table(spark, sf, "orders").select(
        F.concat(F.lit("r"), at(k)).alias("SEQUENCE_ID"), F.when(k % 11 == 0, F.lit("bad template")).alias("PRIMER_ERROR"), F.when(k % 13 == 0, F.lit("-1")).otherwise("1").alias("PRIMER_LEFT_NUM_RETURNED"),
        F.lit("1").alias("PRIMER_INTERNAL_NUM_RETURNED"), F.lit("1").alias("PRIMER_RIGHT_NUM_RETURNED"), F.when(k % 13 == 0, F.lit("0")).otherwise("1").alias("PRIMER_PAIR_NUM_RETURNED"),
        F.concat(at(a + F.when(k % 17 == 0, -5).otherwise(0)), F.lit(",20")).alias("PRIMER_LEFT_0"), oligo("l").alias("PRIMER_LEFT_0_SEQUENCE"),
        F.concat(at(a + F.when(k % 23 == 0, 10).otherwise(40)), F.lit(",20")).alias("PRIMER_INTERNAL_0"), oligo("i").alias("PRIMER_INTERNAL_0_SEQUENCE"),
        F.concat(at(a + 119), F.lit(",20")).alias("PRIMER_RIGHT_0"), oligo("r").alias("PRIMER_RIGHT_0_SEQUENCE"), F.when(k % 19 == 0, F.lit("77")).otherwise("120").alias("PRIMER_PAIR_0_PRODUCT_SIZE"), F.lit("0.5").alias("PRIMER_PAIR_0_PENALTY"),
    )
    tags = assay_design.boulder_decode(assay_design.boulder_encode(rows, rows.columns))
    spans = table(spark, sf, "orders").select(F.concat(F.lit("r"), at(k)).alias("region_id"), (a + 1).cast("int").alias("reference_start"), (a + 150).cast("int").alias("reference_end"), (a + 1).cast("int").alias("peak_start"), (a + 5).cast("int").alias("peak_end"))
    spans = spans.unionByName(spark.createDataFrame([("absent", 1, 2, 1, 2)], spans.schema))
    return assay_design.returned_problems(tags, spans)


@query("""WITH d AS (SELECT n, CASE WHEN n / 100.0 >= 0.95 THEN 10 WHEN n / 100.0 >= 0.9 THEN 8 WHEN n / 100.0 >= 0.88 THEN 7 WHEN n / 100.0 >= 0.85 THEN 6 ELSE 5 END AS w FROM (SELECT unnest(generate_series(80, 100)) AS n)) SELECT n::BIGINT AS identity_percent, w::BIGINT AS word FROM d""")
def q76_word_length(spark, sf):
    return spark.createDataFrame([(n, cluster.word_length(n / 100)) for n in range(80, 101)], "identity_percent long, word long")


@query(f"WITH {own.QCSQL} SELECT count(*) AS input_count, count(*) FILTER (code = 'ACCEPTED') AS accepted_count, count(*) FILTER (code <> 'ACCEPTED') AS rejected_count FROM qc")
def q77_stage_counts(spark, sf):
    from strandweave.operators import qc

    return qc.stage_counts(own._evaluated(spark, sf))


@query(f"""WITH {REG}, a AS (SELECT 'r' || a AS region_id, a, b, peak_start, peak_end FROM reg), x AS (SELECT *, unnest([0, 20]) AS cut FROM a) SELECT region_id || '-' || cut AS assay_id, a + cut <= peak_start AND peak_end <= b - cut AS contains_anchor FROM x""")
def q78_anchor_containment(spark, sf):
    found = regions.candidate_regions(own.windows(spark, sf), own.positions(spark, sf), own.ALN_LENGTH, DESIGN).select(F.concat(F.lit("r"), F.col("reference_start").cast("string")).alias("region_id"), "reference_start", "reference_end", "peak_start", "peak_end")
    cut = found.withColumn("cut", F.explode(F.array(F.lit(0), F.lit(20))))
    spot = lambda s, e: F.struct(s.alias("reference_start"), e.alias("reference_end"))
    assays = cut.select(F.concat("region_id", F.lit("-"), F.col("cut").cast("string")).alias("assay_id"), "region_id", spot(F.col("reference_start") + F.col("cut"), F.col("reference_start") + F.col("cut") + 18).alias("forward"), spot(F.col("reference_end") - F.col("cut") - 18, F.col("reference_end") - F.col("cut")).alias("reverse"))
    return assay_design.contains_anchor(assays, found)
