"""FASTA by Spark's text source: records are cut at line starts with ``>``, so large files split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.plans.storage import number_rows

LINE = 60


def place() -> list[Column]:
    """Where a row of a text file is: its file, its split of the file, and its place in the split."""
    return [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_at")]


def in_file_order(rows: DataFrame) -> DataFrame:
    """Rows with their ``place`` numbered from 0 (``ordinal``) by file name and place, and stored: however
    the files are split and dealt to tasks, and however often they are read, numbers stay the same."""
    return number_rows(rows, "ordinal", "_file", "_start", "_at").withColumn("ordinal", F.col("ordinal") - 1).drop("_start", "_at")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(ordinal, sequence_id, description, sequence): id is the header's first word, letters upper case.

    Ordinals number the records by file and place. Text before a file's first header is no record.
    """
    text = spark.read.option("lineSep", "\n>").text(path).select(*place(), F.regexp_replace("value", "\r", "").alias("value"))
    first = F.regexp_extract("value", "^[^\n]*", 0)
    headed = first.startswith(">")
    header = F.when(headed, F.substr(first, F.lit(2))).otherwise(first)
    body = F.substr("value", F.length(first) + 1)
    named = text.where(F.length(F.btrim("value")) > 0).withColumns({"_headed": headed, "description": header, "sequence": F.upper(F.regexp_replace(body, r"\s", ""))}).drop("value")
    rows = in_file_order(named)
    # the separator eats all marks of headers but a file's first: where that has none it is no record
    bare = rows.groupBy("_file").agg(F.min("ordinal").alias("ordinal"), F.min_by("_headed", "ordinal").alias("headed")).where("not headed").select("ordinal")
    if not bare.isEmpty():
        rows = rows.join(bare, "ordinal", "left_anti")
    return rows.select("ordinal", F.regexp_extract("description", r"^\s*(\S*)", 1).alias("sequence_id"), "description", "sequence")


def write(sequences: DataFrame, path: str, line: int = LINE) -> None:
    """Records of (sequence_id, sequence), lines of ``line`` letters."""
    wrapped = F.regexp_replace("sequence", f"(.{{1,{line}}})", "$1\n")
    sequences.select(F.concat(F.lit(">"), F.col("sequence_id"), F.lit("\n"), F.regexp_replace(wrapped, "\n$", "")).alias("value")).write.text(path)


def datasets(spark: SparkSession, paths: dict[str, str], reader=None) -> DataFrame:
    """Off-target datasets by name in order: (dataset, dataset_ordinal, ordinal, sequence_id, sequence).

    Ids must be present and occur once in each dataset; an empty file is an empty dataset, but one
    with text and no record is an error. ``reader`` tells a path's reader, FASTA where it tells none.
    """
    out = None
    for i, (name, path) in enumerate(paths.items()):
        own = (reader and reader(name)) or read
        rows = own(spark, path)
        if rows.isEmpty() and not spark.read.text(path).where(F.btrim("value") != "").isEmpty():
            raise ValueError(f"dataset {name!r} has text but no records")
        part = rows.select(F.lit(name).alias("dataset"), F.lit(i).alias("dataset_ordinal"), "ordinal", "sequence_id", "sequence")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no datasets")
    bad = out.groupBy("dataset", "sequence_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or sequence_id = ''").limit(1).collect()
    if bad:
        raise ValueError(f"dataset {bad[0].dataset!r} has a blank or repeated sequence id")
    return out
