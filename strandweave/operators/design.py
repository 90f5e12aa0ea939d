"""Primer and probe candidates of regions and their assays: enumeration, filters, range joins, top k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandweave.functions import iupac
from strandweave.plans.config import OligoConstraints, PrimerDesignConfig

# Nearest-neighbour enthalpy (kcal/mol) and entropy (cal/mol/K), SantaLucia 1998.
ENTHALPY = {"AA": -7.9, "AT": -7.2, "TA": -7.2, "CA": -8.5, "GT": -8.4, "CT": -7.8, "GA": -8.2, "CG": -10.6, "GC": -9.8, "GG": -8.0}
ENTROPY = {"AA": -22.2, "AT": -20.4, "TA": -21.3, "CA": -22.7, "GT": -22.4, "CT": -21.0, "GA": -22.2, "CG": -27.2, "GC": -24.4, "GG": -19.9}
ENDS = {"A": (2.3, 4.1), "T": (2.3, 4.1), "C": (0.1, -2.8), "G": (0.1, -2.8)}
GAS, SALT_MOLAR, OLIGO_MOLAR = 1.987, 0.05, 50e-9


def _pairs(table: dict[str, float]) -> dict[str, float]:
    turn = str.maketrans("ACGT", "TGCA")
    return table | {k.translate(turn)[::-1]: v for k, v in table.items()}


def _map(table: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))


def melting_temperature(seq: Column) -> Column:
    """Degrees Celsius by nearest neighbours; null for sequences with other letters than A, C, G, T."""
    h, s = _map(_pairs(ENTHALPY)), _map(_pairs(ENTROPY))
    first, last = F.substr(seq, F.lit(1), F.lit(1)), F.substr(seq, F.length(seq), F.lit(1))
    ends_h, ends_s = _map({k: v[0] for k, v in ENDS.items()}), _map({k: v[1] for k, v in ENDS.items()})
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(seq) - 1)), lambda i: F.substr(seq, i, F.lit(2)))
    total = lambda table, ends: F.aggregate(steps, F.try_element_at(ends, first) + F.try_element_at(ends, last), lambda acc, d: acc + F.try_element_at(table, d))
    entropy = total(s, ends_s) + 0.368 * (F.length(seq) - 1) * F.log(F.lit(SALT_MOLAR))
    return 1000.0 * total(h, ends_h) / (entropy + GAS * F.log(F.lit(OLIGO_MOLAR / 4))) - 273.15


def oligos(regions: DataFrame, template: DataFrame, excluded: DataFrame, c: OligoConstraints, role: str) -> DataFrame:
    """Oligos of one role in each region, within size, temperature and GC bounds, off excluded runs.

    ``template``: one row (sequence) of the reference's consensus. Reverse primers are given 5' first.
    """
    starts = F.sequence(F.col("reference_start"), F.greatest(F.col("reference_start"), F.col("reference_end") - c.min_size + 1))
    sizes = F.sequence(F.lit(c.min_size), F.lit(c.max_size))
    rows = regions.select("region_id", "reference_start", "reference_end", F.explode(starts).alias("start")).withColumn("size", F.explode(sizes)).withColumn("end", F.col("start") + F.col("size") - 1).where(F.col("end") <= F.col("reference_end"))
    runs = excluded.groupBy("region_id").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    free = F.coalesce(~F.exists("runs", lambda r: (r["start"] <= F.col("end")) & (r["end"] >= F.col("start"))), F.lit(True))
    rows = rows.join(F.broadcast(runs), "region_id", "left").where(free).crossJoin(F.broadcast(template.select(F.col("sequence").alias("_template"))))
    plain = F.substr("_template", F.col("start"), F.col("size"))
    rows = rows.withColumn("sequence", iupac.reverse_complement(plain) if role == "REVERSE" else plain).where(F.col("sequence").rlike("^[ACGT]+$"))
    rows = rows.withColumns({"tm": melting_temperature(F.col("sequence")), "gc_percent": iupac.gc_percent(F.col("sequence"))})
    rows = rows.where(F.col("tm").between(c.min_tm, c.max_tm) & F.col("gc_percent").between(c.min_gc_percent, c.max_gc_percent))
    penalty = F.abs(F.col("tm") - c.opt_tm) + F.abs(F.col("size") - c.opt_size)
    return rows.select("region_id", F.lit(role).alias("role"), "sequence", F.col("start").cast("int").alias("reference_start"), F.col("end").cast("int").alias("reference_end"), F.col("size").alias("length"), "tm", "gc_percent", penalty.alias("penalty"))


def assays(regions: DataFrame, template: DataFrame, excluded: DataFrame, c: PrimerDesignConfig, anchored: bool = False) -> DataFrame:
    """Best assays of each region: forward, probe and reverse in order without overlap.

    With ``anchored`` the amplicon must hold the region's peak. Ties are broken by place.
    """
    forward, probe, reverse = (oligos(regions, template, excluded, c.probe if role == "PROBE" else c.primer, role) for role in ("FORWARD", "PROBE", "REVERSE"))
    body = F.struct("sequence", "reference_start", "reference_end", "length", "tm", "gc_percent", "penalty")
    f, p, r = (x.select("region_id", body.alias(n)) for x, n in ((forward, "forward"), (probe, "probe"), (reverse, "reverse")))
    size = F.col("reverse.reference_end") - F.col("forward.reference_start") + 1
    pairs = f.join(r, "region_id").where((F.col("forward.reference_end") < F.col("reverse.reference_start")) & size.between(c.product_size_min, c.product_size_max))
    if anchored:
        pairs = pairs.join(F.broadcast(regions.select("region_id", "peak_start", "peak_end")), "region_id").where((F.col("forward.reference_start") <= F.col("peak_start")) & (F.col("peak_end") <= F.col("reverse.reference_end"))).drop("peak_start", "peak_end")
    between = (F.col("forward.reference_end") < F.col("probe.reference_start")) & (F.col("probe.reference_end") < F.col("reverse.reference_start"))
    rows = pairs.join(p, "region_id").where(between)
    rows = rows.withColumns({"product_size": size, "pair_penalty": F.col("forward.penalty") + F.col("reverse.penalty")})
    order = [F.round(F.col("pair_penalty") + F.col("probe.penalty"), 9), *(F.col(f"{n}.{e}") for n in ("forward", "reverse", "probe") for e in ("reference_start", "reference_end"))]
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("region_id").orderBy(*order))).where(F.col("n") <= c.assays_per_region)
    return ranked.select(
        F.format_string("%s-assay-%03d", "region_id", "n").alias("assay_id"), "region_id", (F.col("n") - 1).alias("primer3_index"), "forward", "probe", "reverse", F.col("product_size").cast("int").alias("product_size"), "pair_penalty"
    )


def long_view(assays_: DataFrame) -> DataFrame:
    """(assay_id, role, sequence, ...): one row per oligo."""
    each = F.array(*(F.struct(F.lit(r.upper()).alias("role"), F.col(r).alias("o")) for r in ("forward", "probe", "reverse")))
    return assays_.select("assay_id", F.inline(each)).select("assay_id", "role", "o.*")


def contains_anchor(assays_: DataFrame, regions: DataFrame) -> DataFrame:
    flag = (F.col("forward.reference_start") <= F.col("peak_start")) & (F.col("peak_end") <= F.col("reverse.reference_end"))
    return assays_.join(F.broadcast(regions.select("region_id", "peak_start", "peak_end")), "region_id").select("assay_id", flag.alias("contains_anchor"))


def problems(assays_: DataFrame, regions: DataFrame, c: PrimerDesignConfig, anchored: bool = False) -> DataFrame:
    """(problem, assay_id) of assays that break the geometry they must have."""
    g = lambda n, e: F.col(f"{n}.reference_{e}")
    code = (
        F.when(~((g("forward", "end") < g("probe", "start")) & (g("probe", "end") < g("reverse", "start"))), "OVERLAP")
        .when(F.col("product_size") != g("reverse", "end") - g("forward", "start") + 1, "PRODUCT_SIZE")
        .when(~F.col("product_size").between(c.product_size_min, c.product_size_max), "PRODUCT_RANGE")
        .when((g("forward", "start") < F.col("reference_start")) | (g("reverse", "end") > F.col("reference_end")), "OUTSIDE_REGION")
    )
    if anchored:
        code = code.when((g("forward", "start") > F.col("peak_start")) | (g("reverse", "end") < F.col("peak_end")), "ANCHOR")
    return assays_.join(regions.select("region_id", "reference_start", "reference_end", "peak_start", "peak_end"), "region_id").select(code.alias("problem"), "assay_id").where("problem is not null")


def tool_input(regions: DataFrame, template: DataFrame, excluded: DataFrame, c: PrimerDesignConfig) -> DataFrame:
    """(rank, value): the Boulder-IO record that asks an external tool for a region's assays.

    ``excluded``: (region_id, excluded) tags of runs where neither primers nor probes may bind.
    """
    bounds = {"OPT_SIZE": "opt_size", "MIN_SIZE": "min_size", "MAX_SIZE": "max_size", "OPT_TM": "opt_tm", "MIN_TM": "min_tm", "MAX_TM": "max_tm", "MIN_GC": "min_gc_percent", "MAX_GC": "max_gc_percent"}
    fixed = {"PRIMER_TASK": "generic", "PRIMER_PICK_LEFT_PRIMER": 1, "PRIMER_PICK_INTERNAL_OLIGO": 1, "PRIMER_PICK_RIGHT_PRIMER": 1, "PRIMER_FIRST_BASE_INDEX": 0, "PRIMER_NUM_RETURN": c.assays_per_region}
    fixed |= {"PRIMER_PRODUCT_SIZE_RANGE": f"{c.product_size_min}-{c.product_size_max}"}
    fixed |= {f"PRIMER_{k}": getattr(c.primer, v) for k, v in bounds.items()} | {f"PRIMER_INTERNAL_{k}": getattr(c.probe, v) for k, v in bounds.items()}
    size = F.col("reference_end") - F.col("reference_start") + 1
    rows = regions.join(excluded, "region_id", "left").crossJoin(F.broadcast(template.select(F.col("sequence").alias("SEQUENCE_TEMPLATE"))))  # one row
    rows = rows.select(
        "rank", F.col("region_id").alias("SEQUENCE_ID"), "SEQUENCE_TEMPLATE", F.concat(F.col("reference_start") - 1, F.lit(","), size).alias("SEQUENCE_INCLUDED_REGION"),
        F.col("excluded").alias("SEQUENCE_EXCLUDED_REGION"), F.col("excluded").alias("SEQUENCE_INTERNAL_EXCLUDED_REGION"), *(F.lit(str(v)).alias(k) for k, v in fixed.items()),
    )
    return boulder_encode(rows, [n for n in rows.columns if n != "rank"], "rank")


def boulder_encode(records: DataFrame, tags: list[str], *keep: str) -> DataFrame:
    """Boulder-IO text of each row: its tags' lines, then ``=``. Null tags are left out."""
    lines = [F.when(F.col(t).isNotNull(), F.concat(F.lit(t + "="), F.col(t).cast("string"))) for t in tags]
    return records.select(*keep, F.concat(F.concat_ws("\n", *lines), F.lit("\n=\n")).alias("value"))


def boulder_decode(text: DataFrame) -> DataFrame:
    """Tags of each Boulder-IO record as a map; a line without ``=`` fails the query."""
    lines = F.filter(F.split("value", "\n"), lambda s: (s != "") & (s != "="))
    fine = F.transform(lines, lambda s: F.when(s.contains("="), s).otherwise(F.raise_error(F.lit("bad Boulder-IO line")).cast("string")))
    return text.select(F.map_from_entries(F.transform(fine, lambda s: F.struct(F.substring_index(s, "=", 1).alias("k"), F.substr(s, F.instr(s, "=") + 1).alias("v")))).alias("tags"))


def oligo_location(tags: Column, side: str, index: Column) -> tuple[Column, Column]:
    """1-based (start, end) of a returned oligo: LEFT and INTERNAL give a 0-based start, RIGHT the 3' end."""
    spot = F.split(F.try_element_at(tags, F.concat(F.lit(f"PRIMER_{side}_"), index.cast("string"))), ",")
    at, size = spot[0].cast("int"), spot[1].cast("int")
    return (at - size + 2, at + 1) if side == "RIGHT" else (at + 1, at + size)


def _number(tags: Column, name: Column) -> Column:
    return F.try_element_at(tags, name).try_cast("int")


def _returned(tags: Column, index: Column) -> Column:
    """What a tool's record says of one of its pairs: three oligos and the pair's size and penalty."""
    parts = []
    for n, side in (("forward", "LEFT"), ("probe", "INTERNAL"), ("reverse", "RIGHT")):
        start, end = oligo_location(tags, side, index)
        said = lambda k, side=side: F.try_element_at(tags, F.concat(F.lit(f"PRIMER_{side}_"), index.cast("string"), F.lit(k)))
        parts.append(F.struct(said("_SEQUENCE").alias("sequence"), start.alias("reference_start"), end.alias("reference_end"), (end - start + 1).alias("length"), said("_TM").try_cast("double").alias("tm"), said("_GC_PERCENT").try_cast("double").alias("gc_percent"), said("_PENALTY").try_cast("double").alias("penalty")).alias(n))
    pair = lambda k: F.try_element_at(tags, F.concat(F.lit("PRIMER_PAIR_"), index.cast("string"), F.lit(k)))
    return F.struct(index.alias("primer3_index"), *parts, pair("_PRODUCT_SIZE").try_cast("int").alias("product_size"), pair("_PENALTY").try_cast("double").alias("pair_penalty"))


def returned_assays(tags: DataFrame) -> DataFrame:
    """Assays of a tool's decoded records (tags), one row a pair; ``returned_problems`` tells what is wrong with them."""
    t = F.col("tags")
    n = F.coalesce(_number(t, F.lit("PRIMER_PAIR_NUM_RETURNED")), F.lit(0))
    rows = tags.select(F.try_element_at(t, F.lit("SEQUENCE_ID")).alias("region_id"), t, F.explode(F.when(n > 0, F.sequence(F.lit(0), n - 1))).alias("i"))
    return rows.select("region_id", _returned(t, F.col("i")).alias("a")).select(F.format_string("%s-assay-%03d", "region_id", F.col("a.primer3_index") + 1).alias("assay_id"), "region_id", "a.*")


def returned_problems(tags: DataFrame, regions: DataFrame, anchored: bool = False) -> DataFrame:
    """(problem, region_id) of a tool's decoded records for ``regions``: errors it told, records that are
    missing, unknown or repeated, counts that don't fit, and pairs without size, order or place."""
    t = F.col("tags")
    rows = tags.select(F.try_element_at(t, F.lit("SEQUENCE_ID")).alias("region_id"), t)
    ids = rows.groupBy("region_id").agg(F.count(F.lit(1)).alias("n"))
    often = ids.where("n > 1").select(F.lit("DUPLICATE_RECORD").alias("problem"), "region_id")
    other = ids.join(regions.select("region_id"), "region_id", "left_anti").select(F.lit("UNKNOWN_RECORD").alias("problem"), "region_id")
    none = regions.select("region_id").join(ids, "region_id", "left_anti").select(F.lit("MISSING_RECORD").alias("problem"), "region_id")
    counts = {k: _number(t, F.lit(f"PRIMER_{k}_NUM_RETURNED")) for k in ("LEFT", "INTERNAL", "RIGHT", "PAIR")}
    bad_count = F.lit(False)
    for k in counts.values():
        bad_count = bad_count | k.isNull() | (k < 0) | (counts["PAIR"] > k)
    told = rows.select(F.when(F.try_element_at(t, F.lit("PRIMER_ERROR")).isNotNull(), "TOOL_ERROR").when(bad_count, "RETURNED_COUNT").alias("problem"), "region_id").where("problem is not null")
    g = lambda n, e: F.col(f"{n}.reference_{e}")
    absent = F.lit(False)
    outside = F.lit(False)
    for n in ("forward", "probe", "reverse"):
        absent = absent | g(n, "start").isNull() | F.col(f"{n}.sequence").isNull() | (F.length(f"{n}.sequence") != F.col(f"{n}.length"))
        outside = outside | (g(n, "start") < F.col("low")) | (g(n, "end") > F.col("high"))
    code = (
        F.when(absent, "OLIGO").when(outside, "OUTSIDE_REGION").when(F.col("product_size").isNull() | (F.col("product_size") <= 0), "PRODUCT_SIZE")
        .when(~((g("forward", "end") < g("probe", "start")) & (g("probe", "end") < g("reverse", "start"))), "ORDER")
        .when(F.col("product_size") != g("reverse", "end") - g("forward", "start") + 1, "PRODUCT_SIZE")
    )
    if anchored:
        code = code.when((g("forward", "start") > F.col("peak_start")) | (g("reverse", "end") < F.col("peak_end")), "ANCHOR")
    spans = regions.select("region_id", F.col("reference_start").alias("low"), F.col("reference_end").alias("high"), "peak_start", "peak_end")
    pairs = returned_assays(tags).join(spans, "region_id").select(code.alias("problem"), "region_id").where("problem is not null")
    return often.unionByName(other).unionByName(none).unionByName(told).unionByName(pairs)
