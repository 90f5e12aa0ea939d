"""Merkle manifest of a table with an inclusion proof for every row, looked up by coordinates.

Rows are leaves; each group's leaves, in order, are hashed in runs of ``ARITY`` until one node is
left, and the groups' roots likewise give the table's root. Each level's runs are one row each of a
node table, keyed by (tree, level, run), so no tree is ever in one place. A leaf knows from its index
and its group's size which runs hold its siblings: it explodes those coordinates, joins the node
table and folds what it gets in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import HOT_SHARE, join_to_groups, stored, workspace

ARITY, BITS = 16, 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree of the groups' roots; a group's tree is its name after an "s", or empty for null.
TOP = "r"


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (hex) of the columns' values, each as its bytes' number, a colon and the value; null is a dash."""

    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, columns)), 256)


def _numbered(rows: DataFrame, order: list[Column], path: str) -> DataFrame:
    """``rows`` with ``idx`` (from 0, in each tree's order) and ``n`` (rows of the tree).

    Ranges are sorted in parallel and stored; a row's index is its place in its stored part plus the
    rows of its tree in the parts before, of which there is one count for each part and tree.
    """
    at = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    at = stored(at.withColumn("row", F.monotonically_increasing_id()), path)
    at = at.withColumn("part", F.struct("tree", F.shiftright("row", 33).alias("p")))
    parts = at.groupBy("part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("held"))
    parts = parts.select(
        "part", "first", "held",
        F.expr("coalesce(sum(held) OVER (PARTITION BY part.tree ORDER BY part.p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)").alias("ahead"),
        F.expr("sum(held) OVER (PARTITION BY part.tree)").alias("n"),
    )
    out = join_to_groups(at, stored(parts, path + "-parts"), "part", "held", at.count())
    return out.withColumn("idx", F.col("row") - F.col("first") + F.col("ahead")).drop("part", "first", "held", "ahead")


def _levels(nodes: DataFrame, path: str) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level of every tree, and (tree, digest, size) of each tree's root.

    ``nodes``: (tree, idx, n, digest, size), size being the leaves below. A run is (tree, level, run,
    size, digests: its nodes' digests, 32 bytes each).
    """
    level, runs = 0, []
    most = nodes.agg(F.max("n")).first()[0] or 0
    roots = [nodes.where("n = 1").select("tree", "digest", "size")]
    while most > ARITY**level:
        run = F.shiftright("idx", BITS).alias("run")
        held = F.array_sort(F.collect_list(F.struct("idx", "digest")))
        made = nodes.where(F.col("n") > ARITY**level).groupBy("tree", run).agg(
            held["digest"].alias("held"), F.sum("size").alias("size"), F.max("n").alias("n")
        ).select(
            "tree", F.lit(level).alias("level"), "run", "size", "n", F.unhex(F.array_join("held", "")).alias("digests"),
            F.sha2(F.array_join("held", ""), 256).alias("digest"),
        )
        made = stored(made, f"{path}-{level}")
        runs.append(made.select("tree", "level", "run", "size", "digests"))
        nodes = made.select("tree", F.col("run").alias("idx"), "n", "digest", "size")
        level += 1
        roots.append(nodes.where((F.col("n") <= ARITY**level)).select("tree", "digest", "size"))
    return runs, reduce(DataFrame.unionByName, roots)


def _coordinates(tree: str, idx: str, n: str, after: int) -> Column:
    """Where a node's siblings are: for each level of its tree the run that it is in, and its place there."""
    return F.expr(
        f"transform(filter(sequence(0, 14), l -> shiftleft(1L, {BITS} * l) < {n}), l -> named_struct("
        f"'at', named_struct('tree', {tree}, 'level', l, 'run', shiftright({idx}, {BITS} * (l + 1))), "
        f"'turn', l + {after}, 'slot', cast(shiftright({idx}, {BITS} * l) & {ARITY - 1} as int)))"
    )


def merkle_manifest(
    docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", tampered: Column | None = None
) -> DataFrame:
    """One row per row of ``docs``: (id_col, leaf, subroot, root, proof_sha256, folded_root, verified).

    ``tampered`` (a condition on ``docs``) names the rows whose text's A-Z are lower-cased before they
    are folded with the siblings of the table as it was; ``verified`` tells whether that gives the
    root. Leaves of a group ascend by id, null ids first; leaves of equal ids by their digests. Null
    values, ids and groups are a leaf's dash; null groups are one group, before the others. Rows that
    repeat are leaves each. An empty text is not a null one. A table of one row has its leaf as root
    and a proof without siblings; an empty table gives no rows. Columns not named here, whatever
    their names, are ignored.

    Runs below which over 1/HOT_SHARE of all leaves are (at most HOT_SHARE a level) are broadcast to the
    leaves that ask for them; all others are merge-joined, each asked for by few.
    """
    folder = workspace(docs.sparkSession, "merkle")
    text = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = [text if c == text_col else F.col(c) for c in columns]
    leaf = leaf_digest([F.col(c) for c in columns])
    touched = F.coalesce(tampered, F.lit(False)) if tampered is not None else F.lit(False)
    base = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.concat(F.lit("s"), F.col(group_col).cast("string")), F.lit("")).alias("tree"),
        leaf.alias("leaf"), F.when(touched, leaf_digest(changed)).otherwise(leaf).alias("shown"),
    )
    base = stored(base, f"{folder}/hashed")
    leaves = stored(_numbered(base, [F.col("id").asc_nulls_first(), F.col("leaf")], f"{folder}/sorted"), f"{folder}/leaves")
    total = leaves.count()
    runs, roots = _levels(leaves.select("tree", "idx", "n", F.col("leaf").alias("digest"), F.lit(1).cast("long").alias("size")), f"{folder}/runs")
    tops = roots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("own"), "digest", "size")
    tops = stored(_numbered(tops, [F.col("own")], f"{folder}/groups"), f"{folder}/tops")
    top_runs, root = _levels(tops.select("tree", "idx", "n", "digest", "size"), f"{folder}/top")
    groups = stored(tops.select(F.col("own").alias("tree"), F.col("idx").alias("top_idx"), F.col("n").alias("top_n"), F.col("digest").alias("subroot"), "size"), f"{folder}/subroots")
    rows = stored(join_to_groups(leaves, groups, "tree", "size", total).drop("size"), f"{folder}/rows")
    table = reduce(DataFrame.unionByName, runs + top_runs) if runs + top_runs else None
    out = _folded(rows, table, total).crossJoin(F.broadcast(root.select(F.col("digest").alias("root"))))
    proof = F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), "")
    folded = F.aggregate("path", F.col("shown"), lambda found, p: F.sha2(F.concat(p["left"], found, p["right"]), 256))
    out = out.withColumn("folded_root", folded)
    return out.select(
        F.col("id").alias(id_col), "leaf", "subroot", "root", F.sha2(proof, 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def _folded(rows: DataFrame, table: DataFrame | None, total: int) -> DataFrame:
    """(row, id, leaf, shown, subroot, path): the siblings left and right of each level's node, upward."""
    spots = F.concat(_coordinates("tree", "idx", "n", 0), _coordinates(f"'{TOP}'", "top_idx", "top_n", 20))
    held = ("row", "id", "leaf", "shown", "subroot")
    if table is None:  # one leaf, or none
        none = F.array().cast("array<struct<turn:int,left:string,right:string>>")
        return rows.select(*held, none.alias("path"))
    table = table.select(F.struct("tree", "level", "run").alias("at"), "size", "digests")
    hot = F.broadcast(table.where(F.col("size") * HOT_SHARE > total).select("at", "digests"))
    cold = table.where(F.col("size") * HOT_SHARE <= total).select("at", "digests")
    asked = rows.select("row", F.inline(spots))
    found = asked.join(hot.select("at"), "at", "left_anti").join(cold.hint("merge"), "at").select("row", F.struct("turn", "slot", "digests").alias("step"))
    own = rows.select("row", F.struct("id", "leaf", "shown", "subroot", "tree", "idx", "n", "top_idx", "top_n").alias("own"))
    # the few steps that many leaves share are added after the rows of a leaf have met, so they never move
    steps = found.withColumn("own", F.lit(None).cast(own.schema["own"].dataType)).unionByName(own.withColumn("step", F.lit(None).cast(found.schema["step"].dataType)))
    low = steps.groupBy("row").agg(F.max("own").alias("own"), F.collect_list("step").alias("low"))
    low = low.select("row", "own.*", "low").withColumn("spot", F.explode_outer(spots)).withColumn("at", F.col("spot.at"))
    high = low.join(hot, "at", "left").groupBy("row").agg(
        *(F.first(c).alias(c) for c in ("id", "leaf", "shown", "subroot", "low")),
        F.collect_list(F.when(F.col("digests").isNotNull(), F.struct("spot.turn", "spot.slot", "digests"))).alias("high"),
    )
    side = lambda p, start, size: F.lower(F.hex(F.substring(p["digests"], start, size)))
    path = F.transform(
        F.array_sort(F.concat("low", "high")),
        lambda p: F.struct(p["turn"].alias("turn"), side(p, F.lit(1), p["slot"] * 32).alias("left"), side(p, p["slot"] * 32 + 33, F.lit(32 * ARITY)).alias("right")),
    )
    return high.select(*held, path.alias("path"))
