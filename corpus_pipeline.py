"""A corpus pipeline: quality, toxicity, exact and near de-duplication, packing.

Each stage takes (spark, docs, sf_dir); docs is what the stage before it kept, stored as Parquet.
All but the last return documents with their columns as they are. Labels come from ``sf_dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandweave.llm.common import read_table, stored, workspace
from strandweave.llm.exact_dedup import dedup_documents
from strandweave.llm.packing import pack_documents
from strandweave.llm.quality import keep_quality
from strandweave.llm.queries import tokenizer_path
from strandweave.llm.simhash import near_dedup_documents
from strandweave.llm.toxicity import drop_toxic


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that score as good text stay.

    Null texts count as empty and score the class prior; rows that repeat stay or go together;
    all rows stay where labels can't teach anything; no rows give no rows; columns are unchanged.
    """
    return keep_quality(docs, read_table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that score as toxic go.

    Null and empty texts aren't toxic; rows that repeat stay or go together; all rows stay where
    labels can't teach anything; no rows give no rows; columns are unchanged.
    """
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: of documents with equal texts up to white space the one with the least id stays.

    Null texts count as empty; null ids come last; of rows that repeat id and text one stays; no rows
    give no rows; columns are unchanged.
    """
    return dedup_documents(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near-duplicates the document with the least id stays.

    Null and empty texts form one group; null ids come last; of rows that repeat id and text one
    stays; no rows give no rows; columns are unchanged.
    """
    return near_dedup_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: where each piece of each document's ids goes in sequences of 4096.

    Null texts count as empty and have the end id alone; rows that repeat are packed each; null ids
    stay null; other columns are left out; no rows give no rows.
    """
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("exact_dedup", exact), ("near_dedup", near), ("packing", packing)]

#: The stages learn and search, which SQL can't express; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result stored and read again as the next one's docs."""
    folder = workspace(spark, "pipeline")
    out = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        out = stored(stage(spark, out, sf_dir), f"{folder}/{i}-{name}")
    return out
