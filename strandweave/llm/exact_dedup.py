"""Exact de-duplication against a persistent digest index.

The index is a Parquet table bucketed and sorted by digest in a folder that outlives the session.
A batch is reduced to its distinct digests (map-side combined, so copies never travel), sort-merge
anti-joined against the index without moving the index, and only new digests are appended.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandweave.llm.common import join_to_groups, pick_rows, row_order, stored, workspace

WHITE = r"[\x20\x09-\x0D]+"


def text_digest(text: str = "text"):
    """SHA-256 (binary) of the text with each run of ASCII white space made one space; null is empty."""
    plain = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ")
    return F.unhex(F.sha2(F.encode(plain, "UTF-8"), 256))


class DigestIndex:
    """Digests seen so far, each with the key of the row that stays.

    ``folder`` holds the Parquet files; any later session opens it again by the same folder and
    bucket number (the session's shuffle partitions where none is given). Appends are Spark writes,
    so a failed batch leaves no part of itself behind. One writer at a time: two batches that are added
    at once may each append a digest that both bring.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None, key_type: str = "bigint"):
        self.spark, self.folder = spark, folder
        self.buckets = buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.table = "digest_index_" + hashlib.md5(folder.encode()).hexdigest()
        place = folder.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {key_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{place}'"
        )

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def forget(self) -> None:
        """Take the table's name out of the session's catalogue; its files stay where they are."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def add(self, groups: DataFrame) -> None:
        """``groups``: one row per digest with its ``keep_id``. Digests already present stay as they are."""
        new = groups.select("digest", "keep_id").repartition(self.buckets, "digest")
        new = new.join(self.entries().hint("merge"), "digest", "left_anti")
        new = stored(new, workspace(self.spark, "new-digests"))
        (
            new.repartition(self.buckets, "digest")
            .write.format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.folder)
            .mode("append")
            .saveAsTable(self.table)
        )
        self.spark.catalog.refreshTable(self.table)


def exact_dedup(
    docs: DataFrame,
    index: DigestIndex | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
) -> DataFrame:
    """Decide for each row which row of its equal texts stays.

    Returns (id_col, keep_id, group_size, kept, text_sha256), one row per input row, dropped ones
    too. Null texts count as empty. The least non-null id of a group stays unless the index already
    knows the digest from an earlier batch, whose row then stays. Rows that repeat id and text are
    all marked kept where that id stays (``row_col`` names a unique column that breaks such ties).
    A null id never wins over another; a group with null ids only has a null keep_id and kept true.
    Other columns, whatever their names, are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "exact-dedup")
    own = index is None
    index = index or DigestIndex(spark, f"{folder}/index")
    mine = row_col or id_col
    rows = docs.select(F.col(id_col).alias("_id"), F.col(mine).alias("_row"), text_digest(text_col).alias("digest"))
    rows = stored(rows, f"{folder}/digests")
    groups = stored(
        rows.groupBy("digest").agg(F.min("_row").alias("keep_id"), F.count(F.lit(1)).alias("group_size")),
        f"{folder}/groups",
    )
    index.add(groups)
    known = stored(groups.select("digest", "group_size").join(index.entries().hint("merge"), "digest"), f"{folder}/known")
    if own:
        index.forget()
    out = join_to_groups(rows, known, "digest", "group_size", rows.count())
    columns = [F.col("_id").alias(id_col), "keep_id", "group_size"]
    columns += [F.col("_row").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")]
    return out.select(*columns, *([F.col("_row").alias(row_col)] if row_col and row_col != id_col else []))


def dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the least id; columns as before.

    Null texts count as empty; null ids come last. Of rows with equal id and equal texts the least
    text hash stays, and of rows that repeat both id and text any one, whatever their other columns,
    which may have any names. Rows are told apart by what they hold, so reading ``docs`` again in
    other splits changes nothing. An empty table gives no rows.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "dedup-documents")
    slim = docs.select(row_order(id_col, text_col).alias("_order"), F.col(text_col).alias("text"))
    index = DigestIndex(spark, f"{folder}/index", key_type=slim.schema["_order"].dataType.simpleString())
    kept = exact_dedup(slim, index, "_order", "text").where("kept").groupBy(F.col("_order").alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    out = pick_rows(docs, kept, id_col, text_col, folder)
    index.forget()
    return out
