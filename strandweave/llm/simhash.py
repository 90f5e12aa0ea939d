"""SimHash near-duplicates by covering locality-sensitive hashing (Pagh, 2016).

For radius r every bit position gets a non-zero vector of r+1 bits; table v (each non-zero vector)
masks the positions whose vector has an odd inner product with v. The vectors of r positions never
span all r+1 dimensions, so some v is orthogonal to all of them and its table ignores just those
bits: every pair within the radius shares a bucket in at least one of the 2^(r+1)-1 tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandweave.llm.common import join_to_groups, pick_rows, row_order, stored, workspace
from strandweave.llm.components import connected_components

SEED = 42
#: Buckets of more distinct fingerprints than this are dealt to finer covering tables.
BUCKET_LIMIT = 512
BITS = 64
#: Rows of hashes whose bits are counted at once; bounds the memory of very long texts.
CHUNK = 1 << 16


def fingerprint(text: str | bytes | None, width: int = 3) -> int:
    """64-bit SimHash over word shingles, repeats included; no words give 0."""
    data = text.encode() if isinstance(text, str) else (text or b"")
    words = data.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, CHUNK):
        part = hashes[i : i + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches):
        for batch in batches:
            values = [fingerprint(x.as_py(), width) for x in batch.column(1)]
            yield pa.record_batch(
                [batch.column(0), pa.array(np.array(values, dtype=np.uint64).view(np.int64))], names=["id", "fp"]
            )

    return run


def simhash(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(id, fp) of each row; fp is the fingerprint's 64 bits as a long."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    kind = slim.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("fp", T.LongType())])
    return slim.mapInArrow(_fingerprints(width), schema)


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """The 2^(radius+1)-1 masks; bit i's vector is i mod that number, plus one, so masks are balanced."""
    n = (1 << (radius + 1)) - 1
    vectors = [i % n + 1 for i in range(bits)]
    return [sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() & 1) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(fps: np.ndarray, reps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (as pairs of reps) of the links within the radius among few fingerprints."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= radius
    label = np.arange(len(fps))
    while True:  # each round takes the least label around
        least = np.where(near, label[None, :], len(fps)).min(axis=1)
        if (least == label).all():
            break
        label = least
    # breadth first from each root: a parent is a linked node reached in an earlier round
    depth = np.where(label == np.arange(len(fps)), 0, -1)
    a, b = [], []
    level = 0
    while (depth < 0).any():
        front = near & (depth == level)[None, :]
        reached = (depth < 0) & front.any(axis=1)
        a.append(reps[reached])
        b.append(reps[front[reached].argmax(axis=1)])
        depth[reached] = level + 1
        level += 1
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _in_buckets(radius: int, limit: int):
    """Rows come sorted by (slot, bucket); yields links (u, v), or the rows of too large buckets dealt
    to the covering tables of those bits on which the bucket's fingerprints may still differ.

    Each turn leaves under half of the bits, so the buckets of all slots end: where no more than
    ``radius`` bits are left, all of a bucket is within the radius and a star keeps its connection.
    """
    names = ["u", "v", "big", "slot", "bucket", "rest"]
    deals: dict[int, list[int]] = {}

    def masks(rest: int) -> list[int]:
        if rest not in deals:
            at = [i for i in range(BITS) if rest >> i & 1]
            # with fewer bits than the tables have vectors, one of radius + 1 parts is surely equal
            parts = [sum(1 << i for i in range(k, len(at), radius + 1)) for k in range(radius + 1)]
            local = covering_masks(radius, len(at)) if len(at) >= (2 << radius) - 1 else parts
            deals[rest] = [sum(1 << at[i] for i in range(len(at)) if m >> i & 1) for m in local]
        return deals[rest]

    def links(u, v):
        n = len(u)
        none = pa.nulls(n, pa.int64())
        return pa.record_batch([pa.array(u), pa.array(v), pa.array(np.zeros(n, bool)), none, none, none], names=names)

    def deal(key, rest, rows):
        fps, reps = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True))
        fill = lambda x: pa.array(np.full(len(fps), _signed(x), np.int64))
        for i, m in enumerate(masks(rest)):
            slot = xxhash.xxh64_intdigest(f"{key[0]} {key[1]} {i}", SEED)
            yield pa.record_batch([pa.array(fps), pa.array(reps), pa.array(np.ones(len(fps), bool)), fill(slot), pa.array(fps & np.int64(_signed(m))), fill(rest & ~m)], names=names)

    def run(batches):
        key, rest, held, big, first = None, 0, [], False, None

        def close():
            nonlocal held
            rows, held = held, []
            if not rows:
                return
            if first is not None:
                yield links(np.array([r for _, r in rows if r != first], dtype=np.int64), np.full(sum(r != first for _, r in rows), first, dtype=np.int64))
            elif big:
                yield from deal(key, rest, rows)
            elif len(rows) > 1:
                fps, reps = (np.array(x, dtype=np.int64) for x in zip(*rows, strict=True))
                u, v = _forest(fps.view(np.uint64), reps, radius)
                if len(u):
                    yield links(u, v)

        for batch in batches:
            for slot, bucket, fp, rep, left in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (slot, bucket) != key:
                    yield from close()
                    key, rest, big = (slot, bucket), left & ((1 << BITS) - 1), False
                    first = rep if rest.bit_count() <= radius else None
                held.append((fp, rep))
                if len(held) > limit:
                    big = True
                    yield from close()
        yield from close()

    return run


def fingerprint_links(groups: DataFrame, radius: int = 2, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``groups``: distinct fingerprints (fp, rep). Returns links (u, v) between reps that connect
    exactly what the pairs within the radius connect, without listing all pairs of a bucket.

    Buckets over ``bucket_limit`` are dealt again to the covering tables of the bits they leave open,
    at any radius, until none is left; the limit changes the work and never the components.
    """
    folder = workspace(groups.sparkSession, "covering")
    masks = covering_masks(radius)
    whole = (1 << BITS) - 1
    tables = F.array(
        *(F.struct(F.lit(i).cast("long").alias("slot"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bucket"), F.lit(_signed(whole & ~m)).alias("rest")) for i, m in enumerate(masks))
    )
    keyed = groups.select(F.inline(tables), "fp", "rep")
    links, turn = None, 0
    while True:
        dealt = keyed.select("slot", "bucket", "fp", "rep", "rest").repartition("slot", "bucket").sortWithinPartitions("slot", "bucket", "fp")
        found = stored(dealt.mapInArrow(_in_buckets(radius, bucket_limit), "u long, v long, big boolean, slot long, bucket long, rest long"), f"{folder}/{turn}")
        own = found.where("not big").select("u", "v")
        links = own if links is None else links.unionByName(own)
        crowded = found.where("big")
        if crowded.isEmpty():
            return links
        keyed = crowded.select("slot", "bucket", F.col("u").alias("fp"), F.col("v").alias("rep"), "rest")
        turn += 1


def _homes(rows: DataFrame, radius: int, bucket_limit: int, folder: str) -> DataFrame:
    """``rows`` (key, fp): (fp, size, first), first being the least key of the fingerprint's component."""
    groups = stored(rows.groupBy("fp").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("size")), f"{folder}/groups")
    links = fingerprint_links(groups.select("fp", F.col("fp").alias("rep")), radius, bucket_limit)
    joined = connected_components(links, "simhash-components").withColumnRenamed("node", "fp")
    linked = stored(groups.join(joined, "fp"), f"{folder}/linked")
    least = stored(linked.groupBy("component").agg(F.min("first").alias("least"), F.count(F.lit(1)).alias("members")), f"{folder}/least")
    told = join_to_groups(linked, least, "component", "members", linked.count()).select("fp", "size", F.col("least").alias("first"), "component")
    alone = groups.join(joined.select("fp"), "fp", "left_anti").select("fp", "size", "first", F.col("fp").alias("component"))
    return stored(told.unionByName(alone), f"{folder}/homes")


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2, bucket_limit: int = BUCKET_LIMIT
) -> DataFrame:
    """(id_col, fingerprint, component_id) for each row, near-duplicates transitively joined.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the least id reachable,
    a row's own id included. Null and empty texts have fingerprint zero and link like any other.
    A row with a null id links nothing and has a null component. Repeated rows and equal texts fall
    on one fingerprint before any comparison. Other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "simhash")
    rows = stored(simhash(docs, id_col, text_col, width), f"{folder}/fingerprints")
    named = rows.where("id is not null").select(F.col("id").alias("key"), "fp")
    homes = _homes(named, radius, bucket_limit, folder)
    out = join_to_groups(named, homes, "fp", "size", named.count()).select("fp", F.col("key").alias("id"), F.col("first").alias("component_id"))
    lone = rows.where("id is null").select("fp", "id", F.lit(None).cast(rows.schema["id"].dataType).alias("component_id"))
    return out.unionByName(lone).select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def near_dedup_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2) -> DataFrame:
    """``docs`` with one row of each near-duplicate group, the one with the least id; columns as before.

    Null texts count as empty, and empty texts are near-duplicates of each other; null ids come last.
    Of rows with equal id the least text hash stays, and of rows that repeat both id and text any
    one. Rows are told apart by what they hold, so reading ``docs`` again in other splits changes
    nothing. Other columns may have any names; an empty table gives no rows.
    """
    folder = workspace(docs.sparkSession, "near-dedup")
    slim = docs.select(row_order(id_col, text_col).alias("_key"), F.col(text_col).alias("_text"))
    rows = stored(simhash(slim, "_key", "_text", width).withColumnRenamed("id", "key"), f"{folder}/fingerprints")
    homes = _homes(rows, radius, BUCKET_LIMIT, folder)
    firsts = homes.groupBy("component").agg(F.min("first").alias("key"))
    copies = rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    return pick_rows(docs, copies.join(firsts, "key", "left_semi"), id_col, text_col, folder)
