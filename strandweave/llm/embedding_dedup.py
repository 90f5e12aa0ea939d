"""Embedding near-duplicates by an epsilon grid order join (Boehm et al., 2001).

Unit vectors with cosine >= c lie within e = sqrt(2 - 2c) of each other. Their leading principal
components never lie further apart than they do, so a grid of side e over those orders the vectors
lexicographically by cell, and two intervals of that order whose cells differ by more than one in
any dimension hold no pair. The order is cut into blocks; only blocks that may touch are paired, and
each pair of blocks is joined by halving both intervals until they are provably apart or small.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandweave.llm.common import join_to_groups, stored, workspace
from strandweave.llm.components import connected_components

#: Leading principal dimensions of the grid, vectors of a block and of a base case.
GRID_DIMS, BLOCK, BASE = 6, 2048, 256
#: Partners that a block meets in one task.
PARTNERS = 16
#: Blocks that may touch find each other by their cells in so many dimensions, in STRIPES steps each.
KEY_DIMS, STRIPES = 3, 12
#: Cells are this much wider than e, so that rounding never parts a pair.
SLACK = 1e-6


def _canonical(kind: str):
    """(id, label, digest, vec): usable vectors as numbers of the input's kind; the digest tells equal ones."""

    def run(batches):
        yield from _usable(batches, kind)

    return run


def _usable(batches, kind: str):
    for batch in batches:
        ids, labels, digests, vectors = [], [], [], []
        for i, label, vec in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if vec is None or None in vec:
                continue
            v = np.array(vec, dtype=np.float64) + 0.0
            if len(v) and np.isfinite(v).all() and v.any():
                data = v.astype(kind).tobytes()
                ids.append(i)
                labels.append(label)
                digests.append(hashlib.blake2b(data, digest_size=16).digest())
                vectors.append(data)
        yield pa.record_batch(
            [pa.array(ids, batch.schema.field(0).type), pa.array(labels, batch.schema.field(1).type), pa.array(digests, pa.binary()), pa.array(vectors, pa.binary())],
            names=["id", "label", "digest", "vec"],
        )


def _units(vectors: list[bytes], kind: str) -> np.ndarray:
    """The vectors' directions, in double precision."""
    v = np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def principal_axes(vectors: DataFrame, dims: int, keep: int, kind: str = "<f8") -> np.ndarray:
    """Leading eigenvectors of the second moments of all unit vectors of ``dims`` components."""

    def moments(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                u = _units(batch.column(0).to_pylist(), kind)
                total += u.T @ u
        yield pa.record_batch([pa.array(range(dims), pa.int32()), pa.array(list(total))], names=["row", "values"])

    parts = vectors.where(F.length("vec") == np.dtype(kind).itemsize * dims).select("vec").mapInArrow(moments, "row int, values array<double>")
    sums = parts.select("row", F.posexplode("values")).groupBy("row", "pos").agg(F.sum("col").alias("s"))
    total = np.zeros((dims, dims))
    for r in sums.collect():  # dims squared numbers, however many vectors
        total[r.row, r.pos] = r.s
    return np.linalg.eigh((total + total.T) / 2)[1][:, ::-1][:, :keep]


def _blocks(size: int):
    """Rows in grid order to blocks of one label: cell bounds, ids, weights and vectors."""

    def run(batches):
        label, rows, serial = None, [], TaskContext.get().partitionId() << 32

        def close():
            nonlocal serial, rows
            if not rows:
                return
            cells = np.array([r[1] for r in rows])
            yield pa.record_batch(
                [
                    pa.array([serial], pa.int64()), pa.array([label], pa.string()),
                    pa.array([cells.min(0).tolist()], pa.list_(pa.int32())), pa.array([cells.max(0).tolist()], pa.list_(pa.int32())),
                    pa.array([cells.astype("<i4").tobytes()], pa.binary()),
                    pa.array([np.array([r[2] for r in rows], "<i8").tobytes()], pa.binary()),
                    pa.array([np.array([r[3] for r in rows], "<i8").tobytes()], pa.binary()),
                    pa.array([b"".join(r[4] for r in rows)], pa.binary()),
                ],
                names=["block", "label", "low", "high", "cells", "ids", "weights", "vecs"],
            )
            serial, rows = serial + 1, []

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[0] != label or len(rows) >= size:
                    yield from close()
                    label = row[0]
                rows.append(row)
        yield from close()

    return run


class _Side:
    def __init__(self, cells: bytes, ids: bytes, weights: bytes, vecs: bytes, kind: str):
        self.ids = np.frombuffer(ids, "<i8")
        n = len(self.ids)
        self.cells = np.frombuffer(cells, "<i4").reshape(n, -1)
        self.weights = np.frombuffer(weights, "<i8")
        self.units = _units([vecs], kind).reshape(n, -1) if n == 1 else _units([vecs[i * len(vecs) // n : (i + 1) * len(vecs) // n] for i in range(n)], kind)


def _join(a: _Side, b: _Side, least: float, same: bool):
    """Link counts of both sides, and links enough to connect what all links connect."""
    counts_a, counts_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
    links: list[tuple[np.ndarray, np.ndarray]] = []
    todo = [(0, len(a.ids), 0, len(b.ids))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        if same and b1 <= a0:  # the mirrored half is done from the other side
            continue
        ca, cb = a.cells[a0:a1], b.cells[b0:b1]
        if ((ca.min(0) - cb.max(0) > 1) | (cb.min(0) - ca.max(0) > 1)).any():
            continue
        if a1 - a0 > BASE or b1 - b0 > BASE:
            if a1 - a0 >= b1 - b0:
                mid = (a0 + a1) // 2
                todo += [(a0, mid, b0, b1), (mid, a1, b0, b1)]
            else:
                mid = (b0 + b1) // 2
                todo += [(a0, a1, b0, mid), (a0, a1, mid, b1)]
            continue
        near = a.units[a0:a1] @ b.units[b0:b1].T >= least
        if same:
            near &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)[None, :]
        if not near.any():
            continue
        counts_a[a0:a1] += near @ b.weights[b0:b1]
        counts_b[b0:b1] += near.T @ a.weights[a0:a1]
        # a tree of each part of the bipartite graph: first partners join rows that share a column
        u, v = _connect(near)
        links.append((a.ids[a0 + u], b.ids[b0 + v]))
    return counts_a, counts_b, links


def _connect(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Some cells of a boolean matrix, under rows + columns, that connect what all its cells connect."""
    rows = np.flatnonzero(near.any(1))
    cols = np.flatnonzero(near.any(0))
    first = near[rows].argmax(1)
    top = near[:, cols].argmax(0)
    root = np.arange(near.shape[0] + near.shape[1])

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    us, vs = [], []

    def link(u, v):
        x, y = find(u), find(near.shape[0] + v)
        if x != y:
            root[y] = x
            us.append(u)
            vs.append(v)

    for u, v in zip(rows.tolist(), first.tolist(), strict=True):
        link(u, v)
    for v, u in zip(cols.tolist(), top.tolist(), strict=True):
        link(u, v)
    names = np.array([find(i) for i in range(len(root))])
    while True:  # what first partners leave apart: one cell for each root and round
        other = near & (names[: near.shape[0], None] != names[None, near.shape[0] :])
        if not other.any():
            return np.array(us, dtype=np.int64), np.array(vs, dtype=np.int64)
        for u in np.flatnonzero(other.any(1)).tolist():
            link(u, int(other[u].argmax()))
        names = np.array([find(i) for i in range(len(root))])


def _pairs_join(least: float, kind: str):
    """Rows come sorted by group: a block (partner false), then its partners there; itself, if it is one."""

    def run(batches):
        group, a, own = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                side = _Side(row["cells"], row["ids"], row["weights"], row["vecs"], kind)
                if not row["partner"]:
                    group, a, own = (row["a"], row["turn"]), side, row["block"]
                    continue
                assert group == (row["a"], row["turn"])
                same = row["block"] == own
                b = a if same else side
                counts_a, counts_b, links = _join(a, b, least, same)
                u = [np.empty(0, np.int64), *(x for x, _ in links), a.ids[counts_a > 0], b.ids[counts_b > 0]]
                v = [np.empty(0, np.int64), *(y for _, y in links), a.ids[counts_a > 0], b.ids[counts_b > 0]]
                n = [np.zeros(sum(len(x) for x, _ in links), np.int64), counts_a[counts_a > 0], counts_b[counts_b > 0]]
                yield pa.record_batch([pa.array(np.concatenate(x)) for x in (u, v, n)], names=["u", "v", "n"])

    return run


def embedding_groups(
    vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    grid_dims: int = GRID_DIMS, block: int = BLOCK,
) -> DataFrame:
    """(id_col, n_links, component_id, kept), one row per input row.

    Rows of one non-null label link where the cosine, in double precision, is at least ``least``
    (over 0). n_links counts the other rows a row links with, copies included; component_id is the
    least id reachable, its own included; kept marks rows that are their component's id. Vectors
    that are null, empty, all zero or hold null or non-finite components, rows with a null label or
    id, and vectors of different lengths link with nothing; a null id's component is null and it
    isn't kept. Equal vectors are joined as one, whose weight counts them; rows that repeat an id
    are rows like others. Other columns are ignored; no rows give no rows.
    """
    spark = vectors.sparkSession
    folder = workspace(spark, "embedding")
    slim = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vec"))
    kind = "<f4" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "<f8"
    width = np.dtype(kind).itemsize
    usable = slim.where("id is not null and label is not null").mapInArrow(_canonical(kind), "id long, label string, digest binary, vec binary")
    usable = stored(usable, f"{folder}/usable")
    classes = stored(
        usable.groupBy("label", "digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.max("vec").alias("vec")),
        f"{folder}/classes",
    )
    lengths = [r[0] for r in classes.select((F.length("vec") / width).cast("int")).distinct().collect()]
    side = float(np.sqrt(2 - 2 * least)) + SLACK
    found = None
    for dims in lengths:  # as a rule one
        part = _joined(classes.where(F.length("vec") == width * dims), dims, side, least, grid_dims, block, kind, f"{folder}/{dims}")
        found = part if found is None else found.unionByName(part)
    everyone = slim.select("id")
    if found is None:
        lone = F.col("id")
        return everyone.select(lone.alias(id_col), F.lit(0).cast("long").alias("n_links"), lone.alias("component_id"), lone.isNotNull().alias("kept"))
    found = stored(found, f"{folder}/found")
    counts = found.where("u = v").groupBy(F.col("u").alias("rep")).agg(F.sum("n").alias("n"))
    homes = connected_components(found.where("u <> v").select("u", "v"), "embedding-components")
    told = (
        classes.select("label", "digest", "rep", "weight")
        .join(counts, "rep", "left")
        .join(homes, F.col("rep") == F.col("node"), "left")
        .select(
            F.struct("label", "digest").alias("key"), "weight",
            (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"),
        )
    )
    told = stored(told, f"{folder}/told")
    rows = usable.select(F.struct("label", "digest").alias("key"), "id")
    linked = join_to_groups(rows, told, "key", "weight", usable.count()).select("id", "n_links", "component_id")
    # rows without a usable vector, told by their number for each id, as an id may repeat
    rest = (
        everyone.withColumn("n", F.lit(1)).unionByName(usable.select("id", F.lit(-1).alias("n")))
        .groupBy("id").agg(F.sum("n").alias("n")).where("n > 0")
        .select(F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))), "id").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    )
    return linked.unionByName(rest).select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def touching_blocks(bounds: DataFrame, dims: int, side: float) -> DataFrame:
    """(a, b), a <= b: pairs of blocks (block, label, low, high) of a label whose cells may touch.

    Blocks meet on their cells in up to KEY_DIMS dimensions, taken together STRIPES to the whole
    range, so that few blocks of far cells are ever compared; a pair meets once, at the least cells
    that both reach.
    """
    keys = min(KEY_DIMS, dims)
    width = max(1, int(np.ceil(2 / side / STRIPES)))
    stripe = lambda x: F.floor(x / width).cast("int")
    left = bounds.select(F.col("block").alias("a"), "label", F.col("low").alias("a_low"), F.col("high").alias("a_high"))
    right = bounds.select(F.col("block").alias("b"), "label", F.col("low").alias("b_low"), F.col("high").alias("b_high"))
    for i in range(keys):
        left = left.withColumn(f"c{i}", F.explode(F.sequence(stripe(F.col("a_low")[i]), stripe(F.col("a_high")[i]))))
        right = right.withColumn(f"c{i}", F.explode(F.sequence(stripe(F.col("b_low")[i] - 1), stripe(F.col("b_high")[i] + 1))))
    touch = F.col("a") <= F.col("b")
    for i in range(dims):
        touch = touch & (F.col("a_low")[i] - F.col("b_high")[i] <= 1) & (F.col("b_low")[i] - F.col("a_high")[i] <= 1)
    for i in range(keys):
        touch = touch & (F.col(f"c{i}") == F.greatest(stripe(F.col("a_low")[i]), stripe(F.col("b_low")[i] - 1)))
    return left.join(right, ["label", *(f"c{i}" for i in range(keys))]).where(touch).select("a", "b")


def _joined(classes: DataFrame, dims: int, side: float, least: float, grid_dims: int, block: int, kind: str, folder: str) -> DataFrame:
    axes = principal_axes(classes, dims, min(grid_dims, dims), kind)
    keep = axes.shape[1]

    def grid(batches):
        for batch in batches:
            if batch.num_rows:
                cells = np.floor(_units(batch.column(3).to_pylist(), kind) @ axes / side).astype(np.int32)
                yield pa.record_batch([batch.column(0), pa.array(list(cells), pa.list_(pa.int32())), *batch.columns[1:]], names=["label", "cell", "rep", "weight", "vec"])

    count = classes.count()
    parts = max(1, -(-count // (16 * block)))
    order = ["label", *(F.col("cell")[i] for i in range(keep)), "rep"]
    ordered = (
        classes.select("label", "rep", "weight", "vec")
        .mapInArrow(grid, "label string, cell array<int>, rep long, weight long, vec binary")
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
    )
    shape = "block long, label string, low array<int>, high array<int>, cells binary, ids binary, weights binary, vecs binary"
    blocks = stored(ordered.mapInArrow(_blocks(block), shape), f"{folder}/blocks")
    pairs = touching_blocks(blocks.select("block", "label", "low", "high"), keep, side)
    # a block's partners are dealt to turns, in each of which it is sent once and they are
    turn = F.floor((F.row_number().over(Window.partitionBy("a").orderBy("b")) - 1) / PARTNERS).cast("int")
    pairs = stored(pairs.withColumn("turn", turn), f"{folder}/pairs")
    body = ("cells", "ids", "weights", "vecs")
    whole = blocks.select("block", *body)
    lead = pairs.select("a", "turn", F.lit(False).alias("partner"), F.col("a").alias("block")).distinct()
    rows = lead.unionByName(pairs.select("a", "turn", F.lit(True).alias("partner"), F.col("b").alias("block"))).join(whole, "block")
    tasks = max(1, -(-pairs.count() // PARTNERS))
    dealt = rows.repartition(tasks, F.xxhash64("a", "turn")).sortWithinPartitions("a", "turn", "partner")
    return dealt.mapInArrow(_pairs_join(least, kind), "u long, v long, n long")
