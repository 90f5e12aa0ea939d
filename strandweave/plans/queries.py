"""Queries over the TPC-H-like tables, one or more per operator, and SQL that gives the same rows.

Sequences come from documents (letters that are nucleotide codes), an alignment from suppliers
(a keyed reference with keyed changes and gaps); both derivations are the same in Spark and DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.functions import iupac, text
from strandweave.functions.intervals import expanded
from strandweave.operators import cluster, conserve, contrast, inclusivity, qc, ranking, regions, seed_index, specificity
from strandweave.operators import design as assay_design
from strandweave.plans.config import ConservationConfig, InclusivityConfig, PrimerDesignConfig, QCConfig, RankingConfig, SpecificityConfig
from strandweave.plans.storage import materialize, spread

QC = QCConfig(min_length=40, max_ambiguous_fraction=0.5, expected_length=1500, length_tolerance_fraction=0.95)
ALN_LENGTH = 240
WINDOWS = ConservationConfig(window_size=40, step_size=9)
DESIGN = PrimerDesignConfig(
    candidate_region_length=60, min_mean_conservation=0.80, min_minimum_conservation=0.5, min_mean_coverage=0.85, max_mean_gap_frequency=0.15,
    max_mean_entropy_bits=1.2, min_usable_fraction=0.5, max_candidate_regions=4, max_region_overlap_fraction=0.3,
)
OFF = SpecificityConfig(max_hits_per_oligo_per_dataset=20)
INCL = InclusivityConfig(search_flank=30, max_hits_per_oligo=6)
LETTERS = "[^A-Za-z]"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def sequences(spark: SparkSession, sf: str) -> DataFrame:
    """(ordinal, sequence_id, sequence, dataset) of the nucleotide letters of each document."""
    letters = F.regexp_replace(F.upper(F.regexp_replace("text", LETTERS, "")), f"[^{iupac.CODES}]", "")
    return spread(table(spark, sf, "documents")).select(F.col("doc_id").alias("ordinal"), F.concat(F.lit("seq-"), F.col("doc_id").cast("string")).alias("sequence_id"), letters.alias("sequence"), F.col("lang").alias("dataset"))


SEQ = """seq AS (SELECT doc_id AS ordinal, 'seq-' || doc_id AS sequence_id, lang AS dataset,
  regexp_replace(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '[^ACMGRSVTWYHKDBN]', '', 'g') AS sequence FROM documents)"""


def _keyed(*parts) -> F.Column:
    return F.ascii(F.md5(F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts)).cast("binary")))


def alignment(spark: SparkSession, sf: str) -> DataFrame:
    """(ordinal, sequence_id, alignment_position, symbol): a row per supplier and column."""
    pos, key = F.col("pos").cast("string"), F.col("s_suppkey").cast("string")
    cells = spread(table(spark, sf, "supplier").select("s_suppkey")).select("s_suppkey", F.explode(F.sequence(F.lit(1), F.lit(ALN_LENGTH))).alias("pos"))
    base = F.substr(F.lit("ACGT"), 1 + _keyed("r", pos) % 4, F.lit(1))
    other = F.substr(F.lit(iupac.CODES), 1 + _keyed("m", key, "_", pos, "x") % 15, F.lit(1))
    changed = _keyed("c", key, "_", pos) % 16 == 0
    gap = (F.col("pos") % 7 == 0) & (_keyed("g", key, "_", pos) % 16 == 1)
    symbol = F.when(gap, "-").when(changed, other).otherwise(base)
    return cells.select(F.col("s_suppkey").alias("ordinal"), F.concat(F.lit("s"), key).alias("sequence_id"), F.col("pos").alias("alignment_position"), symbol.alias("symbol"))


ALN = f"""aln AS (SELECT s_suppkey AS ordinal, 's' || s_suppkey AS sequence_id, pos AS alignment_position, CASE
    WHEN pos % 7 = 0 AND ascii(md5('g' || s_suppkey || '_' || pos)) % 16 = 1 THEN '-'
    WHEN ascii(md5('c' || s_suppkey || '_' || pos)) % 16 = 0 THEN substr('ACMGRSVTWYHKDBN', (1 + ascii(md5('m' || s_suppkey || '_' || pos || 'x')) % 15)::INT, 1)
    ELSE substr('ACGT', (1 + ascii(md5('r' || pos)) % 4)::INT, 1) END AS symbol
  FROM supplier, (SELECT unnest(generate_series(1, {ALN_LENGTH})) AS pos)),
ref AS (SELECT pos AS alignment_position, pos::INT AS reference_position, substr('ACGT', (1 + ascii(md5('r' || pos)) % 4)::INT, 1) AS reference_base
  FROM (SELECT unnest(generate_series(1, {ALN_LENGTH})) AS pos))"""
_V = ", ".join(f"sum(CASE WHEN (m & {1 << i}) <> 0 THEN 12 // bit_count(m) ELSE 0 END) AS v{b}" for i, b in enumerate("ACGT"))
_E = " + ".join(f"CASE WHEN v{b} > 0 THEN v{b} / (12.0 * depth) * log2(v{b} / (12.0 * depth)) ELSE 0 END" for b in "ACGT")
POS = f"""{ALN}, votes AS (SELECT alignment_position, count(*) FILTER (symbol <> '-') AS depth, count(*) AS n, {_V}, bit_or(m) AS support
  FROM (SELECT *, instr('ACMGRSVTWYHKDBN', symbol) AS m FROM (SELECT alignment_position, CASE WHEN symbol = '-' THEN '' ELSE symbol END AS symbol0, symbol FROM aln)) GROUP BY ALL),
pos AS (SELECT *, greatest(vA, vC, vG, vT) / (12.0 * depth) AS major, depth / n AS coverage, (n - depth) / n AS gap, abs(-({_E})) AS entropy,
  CASE WHEN CASE reference_base WHEN 'A' THEN vA WHEN 'C' THEN vC WHEN 'G' THEN vG ELSE vT END = greatest(vA, vC, vG, vT) THEN reference_base
       WHEN vA = greatest(vA, vC, vG, vT) THEN 'A' WHEN vC = greatest(vA, vC, vG, vT) THEN 'C' WHEN vG = greatest(vA, vC, vG, vT) THEN 'G' ELSE 'T' END AS major_symbol,
  substr('ACMGRSVTWYHKDBN', support::INT, 1) AS iupac_symbol FROM votes JOIN ref USING (alignment_position))"""
_USABLE = f"major >= {DESIGN.min_minimum_conservation} AND coverage >= {DESIGN.min_mean_coverage} AND gap <= {DESIGN.max_mean_gap_frequency} AND entropy <= {DESIGN.max_mean_entropy_bits}"
_LAST = ALN_LENGTH - WINDOWS.window_size + 1
WIN = f"""{POS}, starts AS (SELECT DISTINCT s FROM (SELECT unnest(list_append(generate_series(1, {_LAST}, {WINDOWS.step_size}), {_LAST})) AS s)),
win AS (SELECT s::INT AS reference_start, (s + {WINDOWS.window_size - 1})::INT AS reference_end, count(*) AS n, avg(major) AS mean_c, min(major) AS min_c, avg(coverage) AS cov, avg(gap) AS gap, avg(entropy) AS ent,
  count(*) FILTER ({_USABLE}) AS usable FROM starts JOIN pos ON reference_position BETWEEN s AND s + {WINDOWS.window_size - 1} GROUP BY s)"""
_MID = f"(reference_start + reference_end) // 2 - {(DESIGN.candidate_region_length - 1) // 2}"
REG = f"""{WIN}, wide AS (SELECT *, least(greatest({_MID}, 1), {ALN_LENGTH - DESIGN.candidate_region_length + 1})::INT AS a FROM win),
led AS (SELECT a, a + {DESIGN.candidate_region_length - 1} AS b, reference_start AS peak_start, reference_end AS peak_end FROM wide
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY -round(mean_c, 12), -min_c, -round(cov, 12), round(ent, 12), round(gap, 12), -usable, reference_start, reference_end) = 1),
reg AS (SELECT a, b, peak_start, peak_end, count(*) AS n, avg(major) AS mean_c, min(major) AS min_c, avg(coverage) AS cov, avg(gap) AS gap, avg(entropy) AS ent, count(*) FILTER ({_USABLE}) AS usable
  FROM led JOIN pos ON reference_position BETWEEN a AND b GROUP BY a, b, peak_start, peak_end
  HAVING round(avg(major), 12) >= {DESIGN.min_mean_conservation} AND min(major) >= {DESIGN.min_minimum_conservation} AND round(avg(coverage), 12) >= {DESIGN.min_mean_coverage}
    AND round(avg(gap), 12) <= {DESIGN.max_mean_gap_frequency} AND round(avg(entropy), 12) <= {DESIGN.max_mean_entropy_bits} AND count(*) FILTER ({_USABLE}) / count(*) >= {DESIGN.min_usable_fraction})"""


def positions(spark, sf) -> DataFrame:
    cells = alignment(spark, sf)
    coordinates = spark.range(1, ALN_LENGTH + 1).select(F.col("id").cast("int").alias("alignment_position"), F.col("id").cast("int").alias("reference_position"), F.substr(F.lit("ACGT"), 1 + _keyed("r", F.col("id").cast("string")) % 4, F.lit(1)).alias("reference_base"))
    return conserve.position_metrics(cells, F.broadcast(coordinates), table(spark, sf, "supplier").count())


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


def windows(spark, sf) -> DataFrame:
    return conserve.windows(positions(spark, sf), ALN_LENGTH, WINDOWS, regions.usable(DESIGN))


QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"WITH {SEQ} SELECT sequence_id, length(sequence) AS n, md5(sequence) AS digest, regexp_matches(sequence, '^[ACMGRSVTWYHKDBN]*$') AS valid FROM seq")
def q01_seq_normalize(spark, sf):
    s = sequences(spark, sf)
    return s.select("sequence_id", F.length("sequence").cast("long").alias("n"), F.md5(F.col("sequence").cast("binary")).alias("digest"), (iupac.invalid_position(F.col("sequence")) == 0).alias("valid"))


_COUNT = lambda codes: f"length(regexp_replace(sequence, '[^{codes}]', '', 'g'))"


@query(f"""WITH {SEQ} SELECT sequence_id, md5(reverse(translate(sequence, 'ACMGRSVTWYHKDBN', 'TGKCYSBAWRDMHVN'))) AS reverse_digest, {_COUNT('GCS')} AS gc_count,
  round({_COUNT('MRSWYK')} + {_COUNT('VHDB')} * log2(3) + {_COUNT('N')} * 2, 6) AS log2_degeneracy FROM seq""")
def q02_revcomp_gc_degeneracy(spark, sf):
    s = sequences(spark, sf)
    return s.select("sequence_id", F.md5(iupac.reverse_complement(F.col("sequence")).cast("binary")).alias("reverse_digest"), F.length(F.regexp_replace("sequence", "[^GCS]", "")).cast("long").alias("gc_count"), F.round(iupac.log2_degeneracy(F.col("sequence")), 6).alias("log2_degeneracy"))


_QC_CASE = f"""CASE WHEN regexp_matches(sequence, '[^ACMGRSVTWYHKDBN]') THEN 'INVALID_NUCLEOTIDE' WHEN length(sequence) < {QC.min_length} THEN 'TOO_SHORT'
  WHEN length(sequence) > 0 AND length(regexp_replace(sequence, '[ACGT]', '', 'g')) / length(sequence) > {QC.max_ambiguous_fraction} THEN 'EXCESSIVE_AMBIGUITY'
  WHEN length(sequence) NOT BETWEEN {QC.expected_length - QC.expected_length * QC.length_tolerance_fraction} AND {QC.expected_length + QC.expected_length * QC.length_tolerance_fraction} THEN 'INCONSISTENT_LENGTH' END"""
# letters that are no nucleotides stay in some documents, so that every rule is met
_RAW = """raw AS (SELECT doc_id AS ordinal, 'seq-' || doc_id AS sequence_id, CASE WHEN source = 'src1' THEN upper(regexp_replace(text, '[^A-Za-z]', '', 'g'))
  ELSE regexp_replace(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '[^ACMGRSVTWYHKDBN]', '', 'g') END AS sequence FROM documents)"""
QCSQL = f"""{_RAW}, ruled AS (SELECT *, {_QC_CASE} AS rule FROM raw),
qc AS (SELECT ordinal, sequence_id, coalesce(rule, CASE WHEN row_number() OVER (PARTITION BY sequence, rule IS NULL ORDER BY ordinal) > 1 THEN 'DUPLICATE_SEQUENCE' END, 'ACCEPTED') AS code FROM ruled)"""


def _evaluated(spark, sf) -> DataFrame:
    up = F.upper(F.regexp_replace("text", LETTERS, ""))
    seq = F.when(F.col("source") == "src1", up).otherwise(F.regexp_replace(up, f"[^{iupac.CODES}]", ""))
    rows = spread(table(spark, sf, "documents")).select(F.col("doc_id").alias("ordinal"), F.concat(F.lit("seq-"), F.col("doc_id").cast("string")).alias("sequence_id"), seq.alias("sequence"))
    return qc.evaluate(rows, QC)


@query(f"WITH {QCSQL} SELECT sequence_id, CASE code WHEN 'ACCEPTED' THEN 'ACCEPTED' ELSE 'REJECTED' END AS status, code FROM qc")
def q03_qc_status(spark, sf):
    code = F.coalesce(F.try_element_at("reason_codes", F.lit(1)), F.lit("ACCEPTED"))
    return _evaluated(spark, sf).select("sequence_id", "status", code.alias("code"))


@query(f"WITH {QCSQL} SELECT code, count(*) AS n FROM qc GROUP BY code")
def q04_qc_counts(spark, sf):
    return qc.counts(_evaluated(spark, sf))


@query(f"WITH {QCSQL} SELECT l.doc_id, quality FROM labels l WHERE 'seq-' || doc_id IN (SELECT sequence_id FROM qc WHERE code = 'ACCEPTED')")
def q05_approved_semi_join(spark, sf):
    labels = table(spark, sf, "labels").withColumn("sequence_id", F.concat(F.lit("seq-"), F.col("doc_id").cast("string")))
    return qc.approved(labels, _evaluated(spark, sf)).select("doc_id", "quality")


@query(f"WITH {POS} SELECT alignment_position, depth, vA::BIGINT AS votes_a, vC::BIGINT AS votes_c, vG::BIGINT AS votes_g, vT::BIGINT AS votes_t, support FROM votes")
def q06_column_metrics(spark, sf):
    v = conserve.column_votes(alignment(spark, sf))
    return v.select(F.col("alignment_position").cast("long").alias("alignment_position"), "depth", *(F.col(f"votes_{b}").alias(f"votes_{b.lower()}") for b in "ACGT"), F.col("support").cast("long").alias("support"))


@query(f"WITH {POS} SELECT reference_position, round(major, 6) AS major_allele_frequency, round(coverage, 6) AS coverage, round(gap, 6) AS gap_frequency, round(entropy, 6) AS entropy_bits FROM pos")
def q07_entropy(spark, sf):
    return _rounded(positions(spark, sf).select("reference_position", "major_allele_frequency", "coverage", "gap_frequency", "entropy_bits"), "major_allele_frequency", "coverage", "gap_frequency", "entropy_bits")


@query(f"WITH {POS} SELECT string_agg(major_symbol, '' ORDER BY reference_position) AS major_consensus, string_agg(iupac_symbol, '' ORDER BY reference_position) AS iupac_consensus FROM pos")
def q08_consensus_string(spark, sf):
    return conserve.consensus(positions(spark, sf))


_WIN_OUT = "reference_start, reference_end, round(mean_c, 6) AS mean_conservation, round(min_c, 6) AS minimum_conservation, round(cov, 6) AS mean_coverage, round(gap, 6) AS mean_gap_frequency, round(ent, 6) AS mean_entropy_bits, usable AS usable_length"
_MEANS = ("mean_conservation", "minimum_conservation", "mean_coverage", "mean_gap_frequency", "mean_entropy_bits")


@query(f"WITH {WIN} SELECT {_WIN_OUT} FROM win")
def q09_windows_anchored(spark, sf):
    return _rounded(windows(spark, sf).select("reference_start", "reference_end", *_MEANS, F.col("usable_length").cast("long").alias("usable_length")), *_MEANS)


@query(f"WITH {WIN} SELECT {_WIN_OUT} FROM win ORDER BY round(mean_c, 12) DESC, round(min_c, 12) DESC, round(cov, 12) DESC, round(ent, 12), reference_start LIMIT 10")
def q10_top_windows(spark, sf):
    top = conserve.top_windows(windows(spark, sf))
    return _rounded(top.select("reference_start", "reference_end", *_MEANS, F.col("usable_length").cast("long").alias("usable_length")), *_MEANS)


@query(f"""WITH {ALN}, r AS (SELECT alignment_position, symbol FROM aln WHERE ordinal = (SELECT min(ordinal) FROM aln))
SELECT alignment_position, CASE WHEN symbol <> '-' THEN sum(CASE WHEN symbol <> '-' THEN 1 ELSE 0 END) OVER (ORDER BY alignment_position) END AS reference_position, nullif(symbol, '-') AS reference_base FROM r""")
def q11_coordinate_map(spark, sf):
    cells = alignment(spark, sf)
    first = cells.agg(F.min("ordinal").alias("ordinal"))
    out = conserve.coordinate_map(cells.join(F.broadcast(first), "ordinal", "left_semi"))
    return out.select(F.col("alignment_position").cast("long").alias("alignment_position"), F.col("reference_position").cast("long").alias("reference_position"), "reference_base")


@query(f"""WITH {SEQ} SELECT dataset, arg_min(sequence_id, (coalesce(length(regexp_replace(sequence, '[ACGT]', '', 'g')) / nullif(length(sequence), 0), 0), -length(sequence), ordinal)) AS reference_id FROM seq GROUP BY dataset""")
def q12_reference_choice(spark, sf):
    from strandweave.operators.align import reference_key

    return sequences(spark, sf).groupBy("dataset").agg(reference_key().alias("reference_id"))


@query(f"""WITH {WIN} SELECT reference_start, usable AS usable_length, round(mean_c, 12) >= {DESIGN.min_mean_conservation} AND min_c >= {DESIGN.min_minimum_conservation} AND round(cov, 12) >= {DESIGN.min_mean_coverage}
  AND round(gap, 12) <= {DESIGN.max_mean_gap_frequency} AND round(ent, 12) <= {DESIGN.max_mean_entropy_bits} AND usable / n >= {DESIGN.min_usable_fraction} AS eligible FROM win""")
def q13_usable_eligible(spark, sf):
    return windows(spark, sf).select("reference_start", F.col("usable_length").cast("long").alias("usable_length"), regions.eligible(DESIGN).alias("eligible"))


_REG_OUT = "a AS reference_start, b AS reference_end, peak_start, peak_end, n AS position_count, usable AS usable_length, round(mean_c, 6) AS mean_conservation, round(ent, 6) AS mean_entropy_bits"


def _region_rows(df: DataFrame, *extra: str) -> DataFrame:
    longs = {c: F.col(c).cast("long") for c in ("position_count", "usable_length")}
    return _rounded(df.withColumns(longs).select(*extra, "reference_start", "reference_end", "peak_start", "peak_end", "position_count", "usable_length", "mean_conservation", "mean_entropy_bits"), "mean_conservation", "mean_entropy_bits")


@query(f"WITH {REG} SELECT {_REG_OUT} FROM reg")
def q14_region_expand_dedup(spark, sf):
    return _region_rows(regions.candidate_regions(windows(spark, sf), positions(spark, sf), ALN_LENGTH, DESIGN))


_ORDER = "-round(mean_c, 12), -min_c, -round(cov, 12), round(ent, 12), round(gap, 12), -usable, a, b"
_LEN = DESIGN.candidate_region_length


@query(f"""WITH RECURSIVE {REG}, ordered AS (SELECT *, row_number() OVER (ORDER BY {_ORDER}) AS i FROM reg),
chosen(i, starts) AS (SELECT 0::BIGINT, []::INT[] UNION ALL
  SELECT o.i, CASE WHEN len(starts) < {DESIGN.max_candidate_regions} AND len(list_filter(starts, lambda s: greatest(0, {_LEN} - abs(s - a)) / {_LEN}.0 > {DESIGN.max_region_overlap_fraction})) = 0 THEN list_append(starts, a) ELSE starts END
  FROM chosen JOIN ordered o ON o.i = chosen.i + 1), final AS (SELECT starts FROM chosen ORDER BY i DESC LIMIT 1)
SELECT list_position(starts, a)::INT AS rank, 'region-' || lpad(list_position(starts, a)::VARCHAR, 3, '0') AS region_id, {_REG_OUT} FROM reg, final WHERE list_contains(starts, a)""")
def q15_region_greedy(spark, sf):
    return _region_rows(regions.select_regions(windows(spark, sf), positions(spark, sf), ALN_LENGTH, DESIGN), "rank", "region_id")


_BIND = f"major >= {DESIGN.min_minimum_conservation} AND coverage >= {DESIGN.min_mean_coverage} AND gap <= {DESIGN.max_mean_gap_frequency}"


@query(f"""WITH {POS}, spans AS (SELECT 'r' || k AS region_id, 60 * k + 1 AS a, 60 * k + 60 AS b FROM (SELECT unnest([0, 1, 2, 3]) AS k)),
bad AS (SELECT region_id, reference_position - row_number() OVER (PARTITION BY region_id ORDER BY reference_position) AS island, reference_position AS p FROM spans JOIN pos ON reference_position BETWEEN a AND b WHERE NOT ({_BIND}))
SELECT region_id, min(p) AS start, max(p) AS "end" FROM bad GROUP BY region_id, island""")
def q16_exclusion_islands(spark, sf):
    spans = spark.createDataFrame([(f"r{k}", 60 * k + 1, 60 * k + 60) for k in range(4)], "region_id string, reference_start int, reference_end int")
    return regions.exclusions(spans, positions(spark, sf), DESIGN)


def _designed(spark, sf) -> DataFrame:
    """An assay cut from the first long sequence of each dataset, so that hits exist."""
    long = sequences(spark, sf).where(F.length("sequence") >= 130)
    return _cut_assays(long.groupBy("dataset").agg(F.min_by(F.struct("ordinal", F.left("sequence", F.lit(130)).alias("sequence")), "ordinal").alias("f")).select("f.*"))


def _cut_assays(rows: DataFrame) -> DataFrame:
    """An assay of each (ordinal, sequence), its oligos at fixed places."""
    cut = lambda a, n: F.substr("sequence", F.lit(a), F.lit(n))
    each = F.array(
        F.struct(F.lit("FORWARD").alias("role"), cut(11, 20).alias("oligo")), F.struct(F.lit("PROBE").alias("role"), cut(51, 22).alias("oligo")),
        F.struct(F.lit("REVERSE").alias("role"), iupac.reverse_complement(cut(91, 20)).alias("oligo")),
    )
    return rows.select(F.concat(F.lit("assay-"), F.col("ordinal").cast("string")).alias("assay_id"), F.col("ordinal").alias("assay_ordinal"), F.inline(each)).withColumnRenamed("oligo", "sequence")


# A primer's last five letters allow no mismatch and a probe's first six one at most: what is left is compared in full.
_AT = lambda j: f"(l[p + {j}] & ~pm[{j} + 1]) <> 0"
_NONE = lambda js: "NOT (" + " OR ".join(_AT(j) for j in js) + ")"
_SITES = f"""oligo AS (SELECT *, list_transform(string_split(pat, ''), lambda c: instr('ACMGRSVTWYHKDBN', c)) AS pm, length(pat) AS k FROM (
  SELECT 'assay-' || ordinal AS assay_id, ordinal AS assay_ordinal, 'FORWARD' AS role, 1 AS ro, substr(sequence, 11, 20) AS pat FROM cut
  UNION ALL SELECT 'assay-' || ordinal, ordinal, 'PROBE', 2, substr(sequence, 51, 22) FROM cut UNION ALL SELECT 'assay-' || ordinal, ordinal, 'REVERSE', 3, substr(sequence, 91, 20) FROM cut)),
views AS (SELECT dataset, ordinal, sequence_id, orientation, length(v) AS len, list_transform(string_split(v, ''), lambda c: instr('ACMGRSVTWYHKDBN', c)) AS l FROM (
  SELECT *, 'FORWARD' AS orientation, sequence AS v FROM seq UNION ALL SELECT *, 'REVERSE_COMPLEMENT', reverse(translate(sequence, 'ACMGRSVTWYHKDBN', 'TGKCYSBAWRDMHVN')) FROM seq) WHERE length(v) >= 20),
site AS (SELECT *, unnest(generate_series(1, len - 19)) AS p FROM views),
cand AS (
  SELECT s.*, o.* FROM site s, oligo o WHERE role = 'FORWARD' AND p + 19 <= len AND {_NONE(range(19, 14, -1))}
  UNION ALL SELECT s.*, o.* FROM site s, oligo o WHERE role = 'REVERSE' AND p + 19 <= len AND {_NONE(range(5))}
  UNION ALL SELECT s.*, o.* FROM site s, oligo o WHERE role = 'PROBE' AND p + 21 <= len AND {" + ".join(f"({_AT(j)})::INT" for j in range(6))} <= 1),
mm AS (SELECT * EXCLUDE (l), list_sort(list_transform(list_filter(generate_series(1, k), lambda j: (l[p + j - 1] & ~pm[j]) <> 0), lambda j: CASE role WHEN 'REVERSE' THEN k - j + 1 ELSE j END)) AS places FROM cand),
hit AS (SELECT dataset, ordinal, sequence_id, assay_id, assay_ordinal, role, ro, orientation, p AS os, p + k - 1 AS oe, CASE orientation WHEN 'FORWARD' THEN p ELSE len - p - k + 2 END AS ss,
  CASE orientation WHEN 'FORWARD' THEN p + k - 1 ELSE len - p + 1 END AS se, len(places) AS n, places FROM mm WHERE len(places) <= CASE role WHEN 'PROBE' THEN 1 ELSE 2 END)"""
OFFSQL = f"""{SEQ}, cut AS (SELECT * FROM seq WHERE length(sequence) >= 130 QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY ordinal) = 1),
{_SITES}"""


def _hits(spark, sf) -> DataFrame:
    seqs = sequences(spark, sf).withColumn("dataset_ordinal", F.lit(0))
    return specificity.off_target_hits(seqs, _designed(spark, sf), OFF)


@query(f"WITH {OFFSQL} SELECT dataset, sequence_id, assay_id, role, orientation, ss AS source_start, se AS source_end, n AS mismatch_count, array_to_string(places, ',') AS places FROM hit")
def q17_offtarget_hits(spark, sf):
    h = _hits(spark, sf)
    return h.select("dataset", "sequence_id", "assay_id", "role", "orientation", "source_start", "source_end", F.col("mismatch_count").cast("long").alias("mismatch_count"), F.array_join("mismatch_positions", ",").alias("places"))


@query(f"""WITH {OFFSQL} SELECT dataset, assay_id, role, sequence_id, orientation, ss AS source_start, hit_rank FROM (SELECT *, row_number() OVER (PARTITION BY dataset, assay_id, role ORDER BY assay_ordinal, ordinal, ro, orientation, ss, se, n, places) AS hit_rank FROM hit) WHERE hit_rank <= 20""")
def q18_retention_topk(spark, sf):
    return specificity.retained(_hits(spark, sf), OFF).select("dataset", "assay_id", "role", "sequence_id", "orientation", "source_start", F.col("hit_rank").cast("long").alias("hit_rank"))


AMP = f"""{OFFSQL}, amp AS (SELECT f.dataset, f.assay_id, f.ordinal, f.sequence_id, f.orientation, f.os AS fs, f.oe AS fe, r.os AS rs, r.oe AS re, least(f.ss, r.ss) AS source_start, greatest(f.se, r.se) AS source_end, r.oe - f.os + 1 AS amplicon_size
  FROM hit f JOIN hit r ON f.assay_id = r.assay_id AND f.ordinal = r.ordinal AND f.orientation = r.orientation AND f.role = 'FORWARD' AND r.role = 'REVERSE' AND f.oe < r.os AND r.oe - f.os + 1 <= 1000)"""


@query(f"WITH {AMP} SELECT dataset, assay_id, sequence_id, orientation, source_start, source_end, amplicon_size FROM amp")
def q19_amplicons_range_join(spark, sf):
    return specificity.amplicons(materialize(_hits(spark, sf), "hits"), OFF).select("dataset", "assay_id", "sequence_id", "orientation", "source_start", "source_end", "amplicon_size")


@query(f"""WITH {AMP} SELECT amp.dataset, amp.assay_id, amp.sequence_id, amp.orientation, source_start, amplicon_size, count(p.os) AS probes, count(p.os) > 0 AS detectable
  FROM amp LEFT JOIN hit p ON p.role = 'PROBE' AND p.assay_id = amp.assay_id AND p.ordinal = amp.ordinal AND p.orientation = amp.orientation AND p.os > fe AND p.oe < rs GROUP BY ALL""")
def q20_detectable_probe(spark, sf):
    a = specificity.amplicons(materialize(_hits(spark, sf), "hits"), OFF)
    return a.select("dataset", "assay_id", "sequence_id", "orientation", "source_start", "amplicon_size", F.size("probe_source_sites").cast("long").alias("probes"), F.col("detectable_off_target").alias("detectable"))


def _evaluation(spark, sf) -> DataFrame:
    """The alignment's rows without their gaps; some are turned around, some are cut short."""
    rows = alignment(spark, sf).where("symbol <> '-'").groupBy("ordinal", "sequence_id").agg(F.sort_array(F.collect_list(F.struct("alignment_position", "symbol"))).alias("s"))
    plain, k = F.array_join("s.symbol", ""), F.col("ordinal") % 10
    return rows.select("ordinal", "sequence_id", F.when(k == 3, iupac.reverse_complement(plain)).when(k == 7, F.left(plain, F.lit(130))).otherwise(plain).alias("sequence"))


def _assays(spark, sf) -> DataFrame:
    """Three assays on the keyed reference."""
    base = "".join("ACGT"[(ord(__import__("hashlib").md5(f"r{p}".encode()).hexdigest()[0])) % 4] for p in range(1, ALN_LENGTH + 1))
    turn = str.maketrans("ACGT", "TGCA")
    rows = []
    for i, (f, p, r) in enumerate(((11, 51, 91), (61, 100, 141), (121, 160, 201))):
        spot = lambda a, n, flip=False: ((base[a - 1 : a - 1 + n].translate(turn)[::-1] if flip else base[a - 1 : a - 1 + n]), a, a + n - 1)
        rows.append((f"assay-{i}", r + 19 - f + 1, spot(f, 20), spot(p, 22), spot(r, 20, True)))
    oligo = "struct<sequence: string, reference_start: int, reference_end: int>"
    return spark.createDataFrame(rows, f"assay_id string, product_size int, forward {oligo}, probe {oligo}, reverse {oligo}")


_RC = "reverse(translate({0}, 'ACMGRSVTWYHKDBN', 'TGKCYSBAWRDMHVN'))"
EVSQL = f"""{ALN}, ev AS (SELECT ordinal, sequence_id, CASE ordinal % 10 WHEN 3 THEN {_RC.format('s0')} WHEN 7 THEN left(s0, 130) ELSE s0 END AS s
  FROM (SELECT ordinal, sequence_id, string_agg(symbol, '' ORDER BY alignment_position) AS s0 FROM aln WHERE symbol <> '-' GROUP BY ALL))"""
INCSQL = f"""{EVSQL},
base AS (SELECT string_agg(reference_base, '' ORDER BY reference_position) AS b FROM ref),
spot AS (SELECT 'assay-' || a AS assay_id, role, st, st + k - 1 AS en, k, rs + 19 - fs + 1 AS size, substr(b, st, k) AS pat FROM base, (SELECT 0 AS a, 11 AS fs, 51 AS ps, 91 AS rs UNION ALL SELECT 1, 61, 100, 141 UNION ALL SELECT 2, 121, 160, 201),
  LATERAL (SELECT 'FORWARD' AS role, fs AS st, 20 AS k UNION ALL SELECT 'PROBE', ps, 22 UNION ALL SELECT 'REVERSE', rs, 20)),
ov AS (SELECT *, 'FORWARD' AS orientation, s AS v FROM ev UNION ALL SELECT *, 'REVERSE_COMPLEMENT', {_RC.format('s')} FROM ev),
st AS (SELECT ordinal, sequence_id, orientation, length(v) AS len, spot.*, unnest(generate_series(greatest(1, st - {INCL.search_flank}), least(length(v) - k + 1, least(length(v), en + {INCL.search_flank}) - k + 1))) AS p, v FROM ov, spot),
raw AS (SELECT * EXCLUDE (v), substr(v, p, k) AS t FROM st),
bad AS (SELECT *, list_filter(generate_series(1, k), lambda j: (instr('ACMGRSVTWYHKDBN', substr(t, j, 1)) & ~instr('ACMGRSVTWYHKDBN', substr(pat, j, 1))) <> 0) AS w FROM raw),
placed AS (SELECT *, len(w) AS mm, CASE role WHEN 'PROBE' THEN 0 WHEN 'FORWARD' THEN len(list_filter(w, lambda j: j > k - 5)) ELSE len(list_filter(w, lambda j: j <= 5)) END AS tail, abs(p - st) AS away FROM bad),
kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY assay_id, ordinal, role, orientation ORDER BY mm, tail, away, p) AS hit_rank FROM placed) WHERE hit_rank <= {INCL.max_hits_per_oligo}),
trio AS (SELECT f.assay_id, f.ordinal, f.sequence_id, f.orientation, f.p AS fp, p.p AS pp, r.p AS rp, f.mm + p.mm + r.mm AS k1, f.tail + r.tail AS k2, abs(r.p + 19 - f.p + 1 - f.size) AS k3, f.away + p.away + r.away AS k4, r.p + 19 - f.p + 1 AS amplicon_size,
    f.mm <= 2 AND f.tail = 0 AND r.mm <= 2 AND r.tail = 0 AND p.mm <= 1 AS fine
  FROM kept f JOIN kept p ON f.role = 'FORWARD' AND p.role = 'PROBE' AND f.assay_id = p.assay_id AND f.ordinal = p.ordinal AND f.orientation = p.orientation AND f.p + 19 < p.p
  JOIN kept r ON r.role = 'REVERSE' AND f.assay_id = r.assay_id AND f.ordinal = r.ordinal AND f.orientation = r.orientation AND p.p + 21 < r.p AND abs(r.p + 19 - f.p + 1 - f.size) <= {INCL.max_amplicon_size_delta}),
bound AS (SELECT * FROM trio QUALIFY row_number() OVER (PARTITION BY assay_id, ordinal ORDER BY k1, k2, k3, k4, orientation, fp, pp, rp) = 1)"""


def _bound(spark, sf) -> DataFrame:
    return inclusivity.bindings(_evaluation(spark, sf), _assays(spark, sf), INCL)


@query(f"WITH {INCSQL} SELECT assay_id, sequence_id, role, orientation, hit_rank, p AS oriented_start, mm AS mismatch_count, away AS displacement FROM kept")
def q21_inclusivity_hits_topk(spark, sf):
    h = inclusivity.oligo_matches(_bound(spark, sf))
    return h.select("assay_id", "sequence_id", "role", "orientation", *(F.col(c).cast("long").alias(c) for c in ("hit_rank", "oriented_start", "mismatch_count", "displacement")))


@query(f"WITH {INCSQL} SELECT assay_id, sequence_id, orientation, amplicon_size, fine AS original_compatible FROM bound")
def q22_binding_argmin(spark, sf):
    return _bound(spark, sf).where("geometry_found").select("assay_id", "sequence_id", "orientation", F.col("amplicon_size").cast("long").alias("amplicon_size"), "original_compatible")


@query(f"""WITH {INCSQL} SELECT assay_id, sequence_id, role, orientation, p AS oriented_start FROM kept k WHERE NOT EXISTS (FROM bound b WHERE b.assay_id = k.assay_id AND b.ordinal = k.ordinal)
  QUALIFY row_number() OVER (PARTITION BY assay_id, ordinal, role ORDER BY mm, tail, away, orientation, p) = 1""")
def q23_fallback(spark, sf):
    h = inclusivity.oligo_matches(_bound(spark, sf).where("not geometry_found")).where("selected")
    return h.select("assay_id", "sequence_id", "role", "orientation", F.col("oriented_start").cast("long").alias("oriented_start"))


VARSQL = f"""{INCSQL}, sel AS (SELECT k.assay_id, k.role, k.k, CASE role WHEN 'REVERSE' THEN {_RC.format('t')} ELSE t END AS site, CASE role WHEN 'REVERSE' THEN {_RC.format('pat')} ELSE pat END AS o
  FROM kept k JOIN bound b ON k.assay_id = b.assay_id AND k.ordinal = b.ordinal AND k.orientation = b.orientation AND k.p = CASE role WHEN 'FORWARD' THEN fp WHEN 'PROBE' THEN pp ELSE rp END),
cell AS (SELECT assay_id, role, k, i AS oligo_position, substr(o, i, 1) AS original_symbol, instr('ACMGRSVTWYHKDBN', substr(o, i, 1)) AS om, instr('ACMGRSVTWYHKDBN', substr(site, i, 1)) AS tm FROM sel, (SELECT unnest(generate_series(1, 22)) AS i) WHERE i <= k)"""


@query(f"""WITH {VARSQL} SELECT assay_id, role, oligo_position, original_symbol, substr('ACMGRSVTWYHKDBN', bit_or(tm)::INT, 1) AS observed_symbol, count(*) FILTER (tm <> om) AS affected_sequence_count,
  round(count(*) FILTER (tm <> om) / (SELECT count(*) FROM supplier), 6) AS affected_fraction, role <> 'PROBE' AND oligo_position > k - 5 AS primer_3_prime_position FROM cell GROUP BY assay_id, role, k, oligo_position, original_symbol HAVING count(*) FILTER (tm <> om) > 0""")
def q24_variations(spark, sf):
    n = table(spark, sf, "supplier").count()
    v = inclusivity.variations(_bound(spark, sf), _assays(spark, sf), n, INCL)
    return _rounded(v.drop("original_support", "observed_support").withColumn("oligo_position", F.col("oligo_position").cast("long")), "affected_fraction")


def _window_queries(spark, sf) -> DataFrame:
    base = conserve.consensus(positions(spark, sf)).select("major_consensus")
    return windows(spark, sf).crossJoin(F.broadcast(base)).withColumn("query", F.substr("major_consensus", F.col("reference_start"), F.col("reference_end") - F.col("reference_start") + 1)).drop("major_consensus")


def _panel(spark, sf) -> DataFrame:
    nations = table(spark, sf, "nation")
    kind = F.element_at(F.array(*map(F.lit, ("CRITICAL", "IMPORTANT", "BACKGROUND"))), (F.col("n_nationkey") % 3 + 1).cast("int"))
    return nations.select(F.col("n_name").alias("dataset"), F.col("n_nationkey").cast("int").alias("panel_ordinal"), kind.alias("criticality"))


@query()
def q27_similarity_local(spark, sf):
    names = table(spark, sf, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("dataset"))
    home = table(spark, sf, "supplier").join(F.broadcast(names), F.col("s_nationkey") == F.col("k")).select(F.col("s_suppkey").alias("ordinal"), "dataset")
    return _rounded(contrast.best_matches(_window_queries(spark, sf), _evaluation(spark, sf).join(home, "ordinal")), "similarity")


# A stand-in similarity that SQL can express: the share of reference positions where a supplier has the major symbol.
SIMSQL = f"""{WIN}, cellm AS (SELECT s_nationkey, aln.ordinal, reference_position, symbol = major_symbol AS same FROM aln JOIN pos USING (alignment_position) JOIN supplier ON s_suppkey = ordinal),
per AS (SELECT reference_start, reference_end, s_nationkey, ordinal, avg(same::INT) AS sim FROM win JOIN cellm ON reference_position BETWEEN reference_start AND reference_end GROUP BY ALL),
ds AS (SELECT reference_start, reference_end, n_name AS dataset, n_nationkey AS o, ['CRITICAL', 'IMPORTANT', 'BACKGROUND'][(n_nationkey % 3 + 1)::INT] AS criticality, coalesce(max(sim), 0) AS sim
  FROM (SELECT reference_start, reference_end, n_name, n_nationkey FROM win CROSS JOIN nation) LEFT JOIN (SELECT reference_start, reference_end, s_nationkey AS n_nationkey, sim FROM per) USING (reference_start, reference_end, n_nationkey) GROUP BY ALL),
summ AS (SELECT reference_start, reference_end, arg_max(dataset, (sim, -o)) AS worst_dataset, max(sim) AS worst, max(sim) FILTER (criticality = 'CRITICAL') AS wc, max(sim) FILTER (criticality = 'IMPORTANT') AS wi FROM ds GROUP BY ALL)"""


def _evidence(spark, sf) -> DataFrame:
    pos = positions(spark, sf).select("alignment_position", "reference_position", "major_symbol")
    names = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("ordinal"), F.col("s_nationkey"))
    wins = windows(spark, sf)
    cells = alignment(spark, sf).join(F.broadcast(pos), "alignment_position").select("ordinal", "reference_position", (F.col("symbol") == F.col("major_symbol")).cast("int").alias("same"))
    spans = F.broadcast(wins.select("reference_start", "reference_end"))
    per = cells.join(spans, F.col("reference_position").between(F.col("reference_start"), F.col("reference_end"))).groupBy("reference_start", "reference_end", "ordinal").agg(F.avg("same").alias("sim"))
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("dataset"))
    best = per.join(names, "ordinal").join(F.broadcast(nation), "s_nationkey").groupBy("reference_start", "reference_end", "dataset").agg(F.max("sim").alias("similarity"), F.first(F.lit("x")).alias("sequence_id"))
    return contrast.evidence(wins, _panel(spark, sf), best)


def _summaries(spark, sf) -> DataFrame:
    return contrast.summarize(_evidence(spark, sf))


@query(f"WITH {SIMSQL} SELECT reference_start, reference_end, worst_dataset, round(worst, 6) AS worst_similarity, round(wc, 6) AS worst_critical_similarity, round(wi, 6) AS worst_important_similarity, round(mean_c - worst, 6) AS conservation_margin FROM summ JOIN win USING (reference_start, reference_end)")
def q28_window_evidence_conditional_max(spark, sf):
    names = ("worst_similarity", "worst_critical_similarity", "worst_important_similarity", "conservation_margin")
    return _rounded(_summaries(spark, sf).select("reference_start", "reference_end", "worst_dataset", *names), *names)


@query(f"""WITH {SIMSQL}, fit AS (SELECT *, least(greatest({_MID}, 1), {ALN_LENGTH - _LEN + 1})::INT AS a FROM summ JOIN win USING (reference_start, reference_end) WHERE round(mean_c, 12) >= {DESIGN.min_mean_conservation} AND min_c >= {DESIGN.min_minimum_conservation}
  AND round(cov, 12) >= {DESIGN.min_mean_coverage} AND round(gap, 12) <= {DESIGN.max_mean_gap_frequency} AND round(ent, 12) <= {DESIGN.max_mean_entropy_bits} AND usable / n >= {DESIGN.min_usable_fraction})
SELECT a AS region_start, a + {_LEN - 1} AS region_end, arg_min(reference_start, (coalesce(wc, -1), coalesce(wi, -1), coalesce(worst, -1), -round(mean_c, 12), round(ent, 12), reference_start)) AS peak_start,
  string_agg(reference_start || '-' || reference_end, ',' ORDER BY reference_start) AS windows FROM fit GROUP BY a""")
def q29_contrast_candidates(spark, sf):
    c = contrast.candidates(_summaries(spark, sf), positions(spark, sf), ALN_LENGTH, DESIGN)
    return c.select(F.col("reference_start").alias("region_start"), F.col("reference_end").alias("region_end"), "peak_start", text.sites(F.col("contributing_windows")).alias("windows"))


def _rank_evidence(spark, sf) -> DataFrame:
    """Evidence of assays made from parts: every class, missing evidence and ties occur."""
    k, part = F.col("p_partkey"), table(spark, sf, "part")
    frac = lambda m, d: (k * m % 97) / F.lit(97.0) * d
    roles = lambda a, m: F.filter(F.array(*(F.when((k * a + i) % m == 0, F.lit(r)) for i, r in enumerate(("FORWARD", "PROBE", "REVERSE")))), lambda x: x.isNotNull())
    accepted = roles(7, 5)
    return part.select(
        F.concat(F.lit("assay-"), k.cast("string")).alias("assay_id"), F.when(k % 11 == 0, None).otherwise(F.round(F.col("p_retailprice") % 7, 2)).cast("double").alias("pair_penalty"),
        (k % 5).cast("int").alias("primer3_index"), F.when(k % 13 == 0, "SKIPPED").otherwise("COMPLETE").alias("inclusivity_status"),
        F.when(k % 13 == 0, None).when(k % 17 == 0, 0).otherwise(20).cast("int").alias("evaluation_sequence_count"), F.when((k % 13 == 0) | (k % 17 == 0), None).otherwise(F.when(k % 3 == 0, 20).otherwise(16 + k % 5)).cast("int").alias("original_compatible_count"),
        F.when(k % 19 == 0, "SKIPPED").otherwise("COMPLETE").alias("specificity_status"), *(F.when(k % 19 == 0, None).otherwise(v).cast("int").alias(n) for n, v in (("compatible_hit_count", k % 4 * 3), ("plausible_count", F.when(k % 6 == 0, 2).otherwise(0)), ("detectable_count", F.when(k % 12 == 0, 1).otherwise(0)))),
        accepted.alias("accepted_roles"), F.array_except(roles(3, 4), accepted).alias("rejected_roles"),
        F.transform(accepted, lambda r: F.struct(F.lit(1).alias("original"), F.lit(2).alias("proposed"))).alias("accepted_degeneracies"),
        (0.8 + frac(5, 0.2)).alias("mean_conservation"), (0.6 + frac(3, 0.4)).alias("minimum_conservation"), (0.9 + frac(7, 0.1)).alias("mean_coverage"), frac(11, 0.05).alias("mean_gap_frequency"), frac(13, 2.5).alias("mean_entropy_bits"),
    )


_ROLES = lambda a, m: f"list_filter([{', '.join(f'CASE WHEN (k * {a} + {i}) % {m} = 0 THEN {chr(39)}{r}{chr(39)} END' for i, r in enumerate(('FORWARD', 'PROBE', 'REVERSE')))}], lambda x: x IS NOT NULL)"
RANKSQL = f"""ev AS (SELECT p_partkey AS k, 'assay-' || p_partkey AS assay_id, CASE WHEN k % 11 <> 0 THEN round(p_retailprice % 7, 2)::DOUBLE END AS pen, k % 13 = 0 AS skip, k % 17 = 0 AND k % 13 <> 0 AS empty, CASE WHEN k % 3 = 0 THEN 20 ELSE 16 + k % 5 END AS okc,
  k % 19 = 0 AS nospec, k % 4 * 3 AS hits, CASE WHEN k % 6 = 0 THEN 2 ELSE 0 END AS pl, CASE WHEN k % 12 = 0 THEN 1 ELSE 0 END AS det, {_ROLES(7, 5)} AS acc, {_ROLES(3, 4)} AS rej0,
  0.8 + (k * 5 % 97) / 97.0::DOUBLE * 0.2 AS c1, 0.6 + (k * 3 % 97) / 97.0::DOUBLE * 0.4 AS c2, 0.9 + (k * 7 % 97) / 97.0::DOUBLE * 0.1 AS c3, (k * 11 % 97) / 97.0::DOUBLE * 0.05 AS c4, (k * 13 % 97) / 97.0::DOUBLE * 2.5 AS c5 FROM part),
e2 AS (SELECT *, NOT (skip OR empty) AS m, okc / 20.0 AS fr, list_filter(rej0, lambda r: NOT list_contains(acc, r)) AS rej, (skip OR empty OR nospec OR pen IS NULL) AS inc FROM ev),
cls AS (SELECT *, CASE WHEN (m AND fr < 0.9) OR (NOT nospec AND det > 0) THEN 'HIGH_RISK' WHEN skip OR empty OR nospec OR inc OR (m AND fr < 1.0) OR (NOT nospec AND det = 0 AND pl > 0) THEN 'REVIEW' ELSE 'IN SILICO PASS' END AS classification,
  list_filter([CASE WHEN NOT nospec AND det > 0 THEN 'HIGH_RISK:specificity:DETECTABLE_OFF_TARGET' END, CASE WHEN m AND fr < 0.9 THEN 'HIGH_RISK:inclusivity:INCLUSIVITY_BELOW_MINIMUM' END,
    CASE WHEN skip OR empty THEN 'REVIEW:inclusivity:INCLUSIVITY_EVIDENCE_MISSING' END, CASE WHEN m AND fr >= 0.9 AND fr < 1.0 THEN 'REVIEW:inclusivity:INCLUSIVITY_BELOW_PASS' END, CASE WHEN inc THEN 'REVIEW:ranking:EVIDENCE_INCOMPLETE' END,
    CASE WHEN NOT nospec AND det = 0 AND pl > 0 THEN 'REVIEW:specificity:PLAUSIBLE_OFF_TARGET_AMPLICON' END, CASE WHEN nospec THEN 'REVIEW:specificity:SPECIFICITY_EVIDENCE_MISSING' END,
    CASE WHEN len(acc) > 0 THEN 'ADVISORY:degeneracy:IUPAC_PROPOSAL_ACCEPTED' END, CASE WHEN len(rej) > 0 THEN 'ADVISORY:degeneracy:IUPAC_PROPOSAL_REJECTED' END, CASE WHEN NOT nospec AND det = 0 AND pl = 0 AND hits > 0 THEN 'ADVISORY:specificity:ISOLATED_OFF_TARGET_HITS' END], lambda x: x IS NOT NULL) AS rs FROM e2),
sc AS (SELECT *, CASE WHEN m THEN fr END AS s1, CASE WHEN NOT nospec THEN CASE WHEN det > 0 THEN 0.0 WHEN pl > 0 THEN 0.40 WHEN hits > 0 THEN greatest(0.80, 1.0 - 0.02 * hits) ELSE 1.0 END END AS s2,
  (c1 + c2 + c3 + (1.0 - c4) + (1.0 - least(c5 / 2.0, 1.0))) / 5.0 AS s3, 1.0 / (1.0 + pen) AS s4, CASE WHEN m THEN (len(acc) * 0.5 + 3 - len(acc)) / 3.0 END AS s5 FROM cls),
fin AS (SELECT *, 100.0 * (0.35 * s1 + 0.25 * s2 + 0.20 * s3 + 0.10 * s4 + 0.10 * s5)::DOUBLE AS final_score FROM sc)"""


def _reason_text(reasons) -> F.Column:
    """Severity, source and code of each reason, in the order they have."""
    return F.array_join(F.transform(reasons, lambda r: F.concat_ws(":", r["severity"], r["source"], r["code"])), ";")


@query(f"WITH {RANKSQL} SELECT assay_id, classification, len(rs) AS n_reasons, array_to_string(list_sort(rs), ';') AS reasons FROM fin")
def q30_classify(spark, sf):
    rows = ranking.classify(_rank_evidence(spark, sf), RankingConfig())
    names = F.array_sort(F.transform("reasons", lambda r: F.concat_ws(":", r["severity"], r["source"], r["code"])))
    return rows.select("assay_id", "classification", F.size("reasons").cast("long").alias("n_reasons"), F.array_join(names, ";").alias("reasons"))


@query(f"WITH {RANKSQL} SELECT assay_id, round(s1, 6) AS inclusivity_score, round(s2, 6) AS specificity_score, round(s3, 6) AS conservation_score, round(s4, 6) AS primer3_quality_score, round(s5, 6) AS robustness_score, round(final_score, 6) AS final_score FROM fin")
def q31_score(spark, sf):
    names = [f"{c}_score" for c in ranking.COMPONENTS]
    rows = ranking.score_components(_rank_evidence(spark, sf)).withColumn("final_score", ranking.final_score(RankingConfig()))
    return _rounded(rows.select("assay_id", *(F.col(n).cast("double").alias(n) for n in names), "final_score"), *names, "final_score")


@query(f"""WITH {RANKSQL} SELECT row_number() OVER (ORDER BY list_position(['IN SILICO PASS', 'REVIEW', 'HIGH_RISK'], classification), final_score IS NULL, final_score DESC NULLS LAST, s1 DESC NULLS LAST, pen NULLS LAST, k % 5, assay_id) AS rank, assay_id, classification, round(final_score, 6) AS final_score FROM fin""")
def q32_rank_total_order(spark, sf):
    return _rounded(ranking.rank(_rank_evidence(spark, sf), RankingConfig()).select("rank", "assay_id", "classification", "final_score"), "final_score")


@query("""SELECT 'UNKNOWN_ASSAY' AS problem, doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents) UNION ALL
SELECT 'MISSING', doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) UNION ALL SELECT 'DUPLICATE', doc_id FROM labels GROUP BY doc_id HAVING count(*) > 1""")
def q33_evidence_matrix_check(spark, sf):
    docs, labels = (table(spark, sf, t).select(F.col("doc_id").alias("assay_id")) for t in ("documents", "labels"))
    return ranking.evidence_gaps(docs, labels, ["assay_id"], docs).withColumnRenamed("assay_id", "doc_id")


@query("""SELECT source, max(CASE WHEN lang = 'en' THEN s ELSE NULL END) AS en, max(CASE WHEN lang = 'fr' THEN s END) AS fr, max(CASE WHEN lang = 'de' THEN s END) AS de, max(CASE WHEN lang = 'es' THEN s END) AS es FROM
 (SELECT s.source, l.lang, CASE WHEN count(d.doc_id) = 0 THEN 'missing' WHEN count(labels.doc_id) = 0 THEN 'no-match' ELSE 'observed' END AS s FROM (SELECT DISTINCT source FROM documents) s CROSS JOIN (SELECT unnest(['en', 'fr', 'de', 'es']) AS lang) l
  LEFT JOIN documents d ON d.source = s.source AND d.lang = l.lang LEFT JOIN labels ON labels.doc_id = d.doc_id GROUP BY ALL) GROUP BY source""")
def q34_heatmap_pivot(spark, sf):
    langs = ["en", "fr", "de", "es"]
    docs = table(spark, sf, "documents").select("source", "lang", "doc_id").join(table(spark, sf, "labels").select("doc_id", F.lit(1).alias("hit")), "doc_id", "left")
    seen = docs.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("similarity"), F.max("hit").alias("sequence_id"))
    grid = docs.select("source").distinct().withColumn("lang", F.explode(F.array(*map(F.lit, langs))))
    rows = grid.join(seen, ["source", "lang"], "left").select(F.col("source").alias("reference_start"), F.lit(0).alias("reference_end"), F.col("lang").alias("dataset"), "similarity", "sequence_id")
    return contrast.heat_map(rows, langs).withColumnRenamed("reference_start", "source").drop("reference_end")


@query("""WITH RECURSIVE e(a, b) AS (VALUES ('input','qc'),('qc','clustering'),('clustering','alignment'),('alignment','conservation'),('conservation','contrastive_conservation'),('panel','contrastive_conservation'),('contrastive_conservation','primer_design'),
 ('primer_design','inclusivity'),('qc','inclusivity'),('primer_design','specificity'),('inclusivity','ranking'),('specificity','ranking'),('primer_design','ranking')), r(stage, descendant) AS (SELECT a, b FROM e UNION SELECT r.stage, e.b FROM r JOIN e ON r.descendant = e.a) SELECT stage, descendant FROM r""")
def q35_stage_descendants(spark, sf):
    from strandweave.plans import dag

    return spark.createDataFrame([(s, d) for s in dag.STAGES for d in dag.descendants(s)], "stage string, descendant string")


@query("""SELECT doc_id, left(regexp_replace(regexp_replace(text, '[^A-Za-z-]', '', 'g'), '[ACGTURYSWKMBDHVNacgturyswkmbdhvn-]{40,}', '[SEQUENCE_REDACTED]', 'g'), 1000) AS message FROM documents""")
def q36_log_redaction(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.redact(F.regexp_replace("text", "[^A-Za-z-]", "")).alias("message"))


@query("""SELECT page_id, coalesce(nullif(trim(regexp_replace(lower(url), '[^a-z0-9]+', '-', 'g'), '-'), ''), 'dataset') AS slug FROM pages""")
def q37_slug(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.slug(F.col("url")).alias("slug"))


@query("""SELECT l_orderkey, l_linenumber, regexp_replace('NC_' || l_orderkey || CASE WHEN l_linenumber > 2 THEN '.' || l_linenumber ELSE '' END, '\\.\\d+$', '') AS accession FROM lineitem""")
def q38_accession_version(spark, sf):
    key = F.concat(F.lit("NC_"), F.col("l_orderkey").cast("string"), F.when(F.col("l_linenumber") > 2, F.concat(F.lit("."), F.col("l_linenumber").cast("string"))).otherwise(""))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.strip_version(key).alias("accession"))


@query(f"WITH {SEQ} SELECT sequence_id, length(sequence) AS n, md5(sequence) AS digest FROM seq WHERE length(sequence) > 0")
def q39_fasta_roundtrip(spark, sf):
    from strandweave.plans.storage import shared_folder
    from strandweave.sources import fasta

    path = shared_folder(spark, "fasta")
    fasta.write(sequences(spark, sf).where("sequence <> ''"), path)
    return fasta.read(spark, path).select("sequence_id", F.length("sequence").cast("long").alias("n"), F.md5(F.col("sequence").cast("binary")).alias("digest"))


@query()
def q40_cluster_greedy(spark, sf):
    return cluster.clusters(_evaluation(spark, sf), 0.90)


@query("""SELECT o_orderkey, (o_orderkey % 300 + 1) AS left_start, (o_orderkey % 300 + 20) AS left_end, (o_orderkey % 300 + 150 - 20 + 2) AS right_start, (o_orderkey % 300 + 151) AS right_end FROM orders""")
def q41_boulder_decode(spark, sf):
    k = F.col("o_orderkey") % 300
    records = table(spark, sf, "orders").select("o_orderkey", F.concat(k.cast("string"), F.lit(",20")).alias("PRIMER_LEFT_0"), F.concat((k + 150).cast("string"), F.lit(",20")).alias("PRIMER_RIGHT_0"))
    tags = assay_design.boulder_decode(assay_design.boulder_encode(records.withColumnRenamed("o_orderkey", "SEQUENCE_ID"), ["SEQUENCE_ID", "PRIMER_LEFT_0", "PRIMER_RIGHT_0"]))
    out = tags.select(F.try_element_at("tags", F.lit("SEQUENCE_ID")).cast("long").alias("o_orderkey"), *(x.cast("long").alias(f"{side.lower()}_{n}") for side in ("LEFT", "RIGHT") for n, x in zip(("start", "end"), assay_design.oligo_location(F.col("tags"), side, F.lit(0)), strict=True)))
    return out


@query("""SELECT l_orderkey, l_linenumber, least(greatest((a + b) // 2 - 149, 1), 701)::INT AS first_place, (least(greatest((a + b) // 2 - 149, 1), 701) + 299)::INT AS last_place FROM (SELECT l_orderkey, l_linenumber, (l_partkey % 900 + 1)::INT AS a, (l_partkey % 900 + 1 + l_quantity)::INT AS b FROM lineitem)""")
def q42_expanded_interval(spark, sf):
    a = (F.col("l_partkey") % 900 + 1).cast("int")
    first, last = expanded(a, (a + F.col("l_quantity")).cast("int"), F.lit(1000), 300)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", first.alias("first_place"), last.alias("last_place"))


@query(f"""WITH {OFFSQL} SELECT d.dataset, a.assay_id, r.role, count(hit.os) AS total_hit_count, least(count(hit.os), 20) AS retained_hit_count, count(hit.os) > 20 AS truncated FROM (SELECT DISTINCT dataset FROM seq) d CROSS JOIN (SELECT DISTINCT assay_id FROM oligo) a
 CROSS JOIN (SELECT unnest(['FORWARD', 'PROBE', 'REVERSE']) AS role) r LEFT JOIN hit ON hit.dataset = d.dataset AND hit.assay_id = a.assay_id AND hit.role = r.role GROUP BY ALL""")
def q43_retention_zero_fill(spark, sf):
    seqs, oligos = sequences(spark, sf), _designed(spark, sf)
    return specificity.retention(_hits(spark, sf), seqs.select("dataset").distinct(), oligos.select("assay_id").distinct(), OFF)


@query(f"WITH {RANKSQL} SELECT classification, CASE WHEN final_score IS NULL THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS score_status, count(*) AS n FROM fin GROUP BY ALL")
def q44_report_counts(spark, sf):
    return ranking.report_counts(ranking.rank(_rank_evidence(spark, sf), RankingConfig()))


def _fasta_folder(spark, sf) -> str:
    from strandweave.plans.storage import shared_folder
    from strandweave.sources import data_source, fasta

    data_source.register(spark)
    path = shared_folder(spark, "fasta")
    fasta.write(sequences(spark, sf).where("sequence <> ''"), path)
    return path


def _digests(rows: DataFrame) -> DataFrame:
    return rows.select("sequence_id", F.length("sequence").cast("long").alias("n"), F.md5(F.col("sequence").cast("binary")).alias("digest"))


@query(SQL["q39_fasta_roundtrip"])
def q81_fasta_format(spark, sf):
    """FASTA files through the data source, in splits."""
    return _digests(spark.read.format("fasta").option("splitBytes", 1 << 20).load(_fasta_folder(spark, sf)))


@query(SQL["q39_fasta_roundtrip"])
def q82_fasta_stream(spark, sf):
    """FASTA files as a stream, appended to a table."""
    path = _fasta_folder(spark, sf)
    stream = _digests(spark.readStream.format("fasta").load(path))
    stream.writeStream.format("parquet").option("path", f"{path}-out").option("checkpointLocation", f"{path}-state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}-out")


@query(SQL["q06_column_metrics"])
def q80_votes_of_rows(spark, sf):
    """The same votes from whole aligned rows, a matrix a task."""
    rows = alignment(spark, sf).groupBy("ordinal").agg(F.sort_array(F.collect_list(F.struct("alignment_position", "symbol"))).alias("s"))
    v = conserve.aligned_votes(rows.select(F.array_join("s.symbol", "").alias("aligned_sequence")))
    return v.select(F.col("alignment_position").cast("long").alias("alignment_position"), "depth", *(F.col(f"votes_{b}").alias(f"votes_{b.lower()}") for b in "ACGT"), F.col("support").cast("long").alias("support"))


@query(f"""WITH {EVSQL}, seq AS (SELECT ordinal, sequence_id, 'family' AS dataset, s AS sequence FROM ev), cut AS (SELECT * FROM seq WHERE length(sequence) >= 130),
{_SITES} SELECT sequence_id, assay_id, role, orientation, ss AS source_start, se AS source_end, n AS mismatch_count, array_to_string(places, ',') AS places FROM hit""")
def q79_seed_index_hits(spark, sf):
    """An assay of every long sequence of a family, searched for in the seed index of all of them."""
    seqs = materialize(_evaluation(spark, sf), "family")
    derived = {"places": F.array_join("mismatch_positions", ",")}
    hits = seed_index.search_once(seqs, _cut_assays(seqs.where(F.length("sequence") >= 130)), OFF, ["ordinal", "sequence_id"], derived)
    return hits.select("sequence_id", "assay_id", "role", "orientation", "source_start", "source_end", F.col("mismatch_count").cast("long").alias("mismatch_count"), "places")


from strandweave.plans import evidence_queries  # noqa: E402, F401  (registers the rest)
