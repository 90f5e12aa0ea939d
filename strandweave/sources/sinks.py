"""Published artifacts: tables as TSV, sequences as FASTA, reports as JSON, HTML and a bundle.

Tables are written by Spark; a single file is gathered only where it is asked for, row by row.
Data go first and the report last, after the old report is gone: a report always tells of its data.
"""

from __future__ import annotations

import html
import json
import os
import re
import shutil
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns of the published tables.
COORDINATES = ("alignment_position", "reference_position", "reference_base")
POSITIONS = (
    "alignment_position", "reference_position", "reference_base", "depth", "coverage", "frequency_a", "frequency_c", "frequency_g", "frequency_t", "gap_frequency",
    "major_allele_frequency", "entropy_bits", "major_consensus", "iupac_consensus",
)
WINDOWS = ("reference_start", "reference_end", "position_count", "mean_conservation", "minimum_conservation", "mean_coverage", "mean_gap_frequency", "mean_entropy_bits")
REGIONS = (
    "region_id", "rank", "reference_start", "reference_end", "peak_start", "peak_end", "position_count", "usable_length", "usable_fraction", "mean_conservation",
    "minimum_conservation", "mean_coverage", "mean_gap_frequency", "mean_entropy_bits",
)
OFF_TARGET_HITS = (
    "dataset_name", "assay_id", "sequence_id", "role", "orientation", "hit_rank", "source_start", "source_end", "mismatch_positions", "mismatch_count", "exact_match",
    "three_prime_mismatch", "compatible",
)
AMPLICONS = (
    "dataset_name", "assay_id", "sequence_id", "orientation", "source_start", "source_end", "amplicon_size", "forward_source_start", "forward_source_end", "reverse_source_start",
    "reverse_source_end", "probe_source_sites", "forward_hit_rank", "reverse_hit_rank", "probe_hit_ranks", "primer_amplicon_plausible", "detectable_off_target",
)
OLIGO_FIELDS = ("sequence", "reference_start", "reference_end", "length", "tm", "gc_percent", "penalty")
ASSAYS = ("assay_id", "region_id", "primer3_index", *(f"{o}_{c}" for o in ("forward", "probe", "reverse") for c in OLIGO_FIELDS), "product_size", "pair_penalty")
OLIGO_MATCHES = (
    "assay_id", "sequence_id", "role", "orientation", "hit_rank", "source_start", "source_end", "expected_start", "expected_end", "displacement", "mismatch_positions",
    "mismatch_count", "exact_match", "three_prime_mismatch", "probe_mismatch", "compatible", "selected",
)
ASSAY_INCLUSIVITY = (
    "assay_id", "sequence_id", "orientation", "geometry_found", "source_amplicon_start", "source_amplicon_end", "amplicon_size", "forward_hit_rank", "probe_hit_rank",
    "reverse_hit_rank", "original_forward_compatible", "original_probe_compatible", "original_reverse_compatible", "original_compatible", "proposed_forward_compatible",
    "proposed_probe_compatible", "proposed_reverse_compatible", "proposed_compatible",
)
VARIATIONS = (
    "assay_id", "role", "oligo_position", "original_symbol", "original_support", "observed_symbol", "observed_support", "affected_sequence_ids", "affected_sequence_count",
    "affected_fraction", "primer_3_prime_position",
)
PROPOSALS = (
    "assay_id", "role", "original_sequence", "proposed_sequence", "status", "reason", "original_degeneracy", "proposed_degeneracy", "changed_positions", "binding_site_count",
    "original_exact_count", "original_exact_fraction", "proposed_exact_count", "proposed_exact_fraction",
)
_WORST = ("worst_dataset_name", "worst_dataset_criticality", "worst_similarity", "worst_critical_similarity", "worst_important_similarity", "contrast_margin")
CONTRAST_WINDOWS = (
    "reference_start", "reference_end", "target_mean_conservation", "target_minimum_conservation", "target_mean_coverage", "target_mean_gap_frequency",
    "target_mean_entropy_bits", "target_eligible", *_WORST,
)
CONTRAST_DATASETS = ("reference_start", "reference_end", "dataset_name", "criticality", "sequence_count", "best_sequence_id", "best_orientation", "similarity")
CONTRAST_REGIONS = (
    "region_id", "rank", "reference_start", "reference_end", "peak_start", "peak_end", "contributing_windows", "mean_conservation", "minimum_conservation", "mean_coverage",
    "mean_gap_frequency", "mean_entropy_bits", *_WORST,
)
RANKING = (
    "rank", "assay_id", "region_id", "classification", "score_status", "final_score", "inclusivity", "specificity", "conservation", "primer3_quality", "robustness",
    "original_compatible_count", "evaluation_sequence_count", "inclusivity_fraction", "compatible_off_target_hit_count", "plausible_off_target_count",
    "detectable_off_target_count", "pair_penalty", "reason_codes",
)


def cell(value) -> str:
    """A table cell: nothing for null, true and false, lists by commas, (start, end) pairs as a-b."""
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, list):
        return ",".join(map(cell, value))
    if isinstance(value, dict):
        return "-".join(cell(x) for x in value.values())
    return re.sub("[\t\r\n]", " ", value) if isinstance(value, str) else str(value)


def quoted_cell(value) -> str:
    """A cell of the tables that quote: as it is, in quotation marks where it holds a tab, a quote or a
    line end; lists of pairs as JSON."""
    if isinstance(value, list):
        value = json.dumps([list(x.values()) if isinstance(x, dict) else x for x in value])
    text = "" if value is None else str(value)
    return '"' + text.replace('"', '""') + '"' if any(ch in text for ch in '\t"\r\n') else text


def lines(df: DataFrame, columns: tuple[str, ...], quoted: bool = False) -> DataFrame:
    """(value): a line of text for each row, made where the rows are."""
    form = quoted_cell if quoted else cell

    def run(batches):
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            yield pa.record_batch([pa.array(["\t".join(map(form, row)) for row in rows], pa.string())], names=["value"])

    return df.select(*(F.col(c) for c in columns)).mapInArrow(run, "value string")


def write_parts(df: DataFrame, path: str, columns: tuple[str, ...], *order, quoted: bool = False) -> None:
    """A folder of parts without header, which in the order of their names hold the rows in order."""
    lines(df.orderBy(*order) if order else df, columns, quoted).write.mode("overwrite").text(path)


def replace_text(path: Path, text: str) -> None:
    """Write beside and rename: readers see the old file or the new one."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part = path.with_name(f".{path.name}.part")
    part.write_text(text, encoding="utf-8")
    os.replace(part, path)


def write_table(df: DataFrame, path: str, columns: tuple[str, ...], *order, quoted: bool = False, bare: bool = False) -> None:
    """One TSV file in order: its lines are made and sorted in tasks; the driver only joins their files.

    ``bare``: one column's text as it is, without header.
    """
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    parts, part = target.with_name(f".{target.name}.parts"), target.with_name(f".{target.name}.part")
    if bare:
        whole = F.regexp_replace(columns[0], "\n$", "")  # the writer ends each row with a line end
        df.orderBy(*order).select(whole.alias("value")).write.mode("overwrite").text(f"file://{parts.resolve()}")
    else:
        write_parts(df, f"file://{parts.resolve()}", columns, *order, quoted=quoted)
    with part.open("wb") as out:
        out.write(b"" if bare else ("\t".join(columns) + "\n").encode())
        for p in sorted(parts.glob("part-*")):
            with p.open("rb") as f:
                shutil.copyfileobj(f, out)
    shutil.rmtree(parts)
    os.replace(part, target)


def write_fasta(df: DataFrame, path: str, *order, line: int = 60) -> None:
    """One FASTA file of (sequence_id, sequence) in order, as ``write_table`` does."""
    record = F.concat(F.lit(">"), F.col("sequence_id"), F.lit("\n"), F.regexp_replace(F.regexp_replace("sequence", f"(.{{1,{line}}})", "$1\n"), "\n$", ""))
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    parts, part = target.with_name(f".{target.name}.parts"), target.with_name(f".{target.name}.part")
    df.orderBy(*order).select(record.alias("value")).write.mode("overwrite").text(f"file://{parts.resolve()}")
    with part.open("wb") as out:
        for p in sorted(parts.glob("part-*")):
            with p.open("rb") as f:
                shutil.copyfileobj(f, out)
    shutil.rmtree(parts)
    os.replace(part, target)


def write_json_rows(path: str, name: str, rows: DataFrame, *order, **more) -> None:
    """A JSON file of an object with a list ``name`` of rows, in order, and ``more``. Rows become text
    in tasks and pass through the driver a line at a time."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    parts, part = target.with_name(f".{target.name}.parts"), target.with_name(f".{target.name}.part")
    rows.orderBy(*order).select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(f"file://{parts.resolve()}")
    with part.open("w", encoding="utf-8") as out:
        rest = json.dumps(more, sort_keys=True, allow_nan=False)[1:-1]
        out.write("{" + (rest + ", " if rest else "") + json.dumps(name) + ": [")
        gap = "\n"
        for p in sorted(parts.glob("part-*")):
            with p.open(encoding="utf-8") as f:
                for line in f:
                    out.write(gap + line.rstrip("\n"))
                    gap = ",\n"
        out.write("\n]}\n")
    shutil.rmtree(parts)
    os.replace(part, target)


def write_report(path: str, report: dict, publish) -> None:
    """Drop the old report, publish the data, then write the report."""
    target = Path(path)
    target.unlink(missing_ok=True)
    publish()
    replace_text(target, json.dumps(report, indent=2, sort_keys=True, allow_nan=False) + "\n")


# What a bundle may hold, files of the run's folder and whole folders below it.
BUNDLED_FILES = ("report.html", "report_error.json", "run_manifest.json", "run_summary.json", "qc_report.json", "ncbi_dataset_manifest.json")
BUNDLED_FOLDERS = ("panel", "conservation", "contrastive_conservation", "primer_design", "inclusivity", "specificity", "ranking")


def bundle(folder: str, target: str, extra: tuple[str, ...] = ()) -> list[str]:
    """A ZIP of a run's published files and of its checkpoints' manifests, the same bytes for the same
    files; links are left out. ``extra`` files go below inputs/ and must not share a name."""
    root, out = Path(folder), Path(target)
    if not root.is_dir():
        raise ValueError(f"no run in {folder}")
    plain = lambda p: p.is_file() and not p.is_symlink() and p != out
    found = {name: root / name for name in BUNDLED_FILES if plain(root / name)}
    for name, files in [*((n, "*") for n in BUNDLED_FOLDERS), (".checkpoints", "manifest.json")]:
        if (root / name).is_dir() and not (root / name).is_symlink():
            found |= {p.relative_to(root).as_posix(): p for p in (root / name).rglob(files) if plain(p)}
    for x in map(Path, extra):
        name = f"inputs/{x.name}"
        if not plain(x) or name in found:
            raise ValueError(f"{x} is no plain file or repeats a name")
        found[name] = x
    out.parent.mkdir(parents=True, exist_ok=True)
    part = out.with_name(f".{out.name}.part")
    with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED, compresslevel=9) as z:
        for name in sorted(found):
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.compress_type, info.external_attr = zipfile.ZIP_DEFLATED, 0o100644 << 16
            with found[name].open("rb") as f, z.open(info, "w") as to:
                shutil.copyfileobj(f, to)
    os.replace(part, out)
    return sorted(found)


def html_table(title: str, columns: tuple[str, ...], rows) -> str:
    cells = lambda tag, values: "".join(f"<{tag}>{html.escape('' if v is None else str(v))}</{tag}>" for v in values)
    body = "".join(f"<tr>{cells('td', (r[c] for c in columns))}</tr>" for r in rows)
    return f"<h2>{html.escape(title)}</h2><table><tr>{cells('th', columns)}</tr>{body}</table>"


def line_chart(points: list[tuple[float, float | None]], width: int = 640, height: int = 160) -> str:
    """An SVG line of shares by place; a missing value breaks it."""
    known = [x for x, _ in points]
    low, high = min(known, default=0), max(known, default=1)
    spot = lambda x, y: f"{(x - low) / ((high - low) or 1) * width:.1f},{height - min(1.0, max(0.0, y)) * height:.1f}"
    runs, run = [], []
    for x, y in [*points, (0, None)]:
        if y is None:
            runs += [run] if run else []
            run = []
        else:
            run.append(spot(x, y))
    lines = "".join(f'<polyline fill="none" stroke="currentColor" points="{" ".join(r)}"/>' for r in runs)
    return f'<svg viewBox="0 0 {width} {height}" role="img">{lines}</svg>'


def page(title: str, *parts: str) -> str:
    return f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{"".join(parts)}</body></html>'


def read_table(spark, path: str, schema: str) -> DataFrame:
    """A published table with stated types: ids and position lists stay text whatever they look like."""
    return spark.read.option("sep", "\t").option("header", True).option("mode", "FAILFAST").option("nullValue", "").schema(schema).csv(path)
