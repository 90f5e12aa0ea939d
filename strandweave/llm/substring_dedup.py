"""Repeated passages across documents by prefix-partitioned suffix trees, and texts without the repeats.

A window is ``least`` consecutive words. Of the windows' suffixes only those are kept that start at an
anchor, the first of the least hashed prefixes (some words) in a window: equal windows have equal
anchors at equal places, so a match of a window is a match of two anchors' suffixes, to the left and
right. Suffixes are dealt by their prefix; prefixes of one document only, and all but one suffix of equal
surroundings, leave at once. Prefixes with too many suffixes for a task's memory are lengthened, in the
last step to the whole window, where the least document of each is an aggregate.

In a task each prefix's suffixes are a subtree, refined a word at a time, and its nodes deep enough to
hold windows give the repeats with the least document of each. A document loses what it shares with an
earlier one.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import join_to_groups, stored, workspace
from strandweave.llm.words import byte_groups, split_words

#: Suffixes of one prefix that a task builds a subtree of at once; a prefix of more is lengthened.
MOST = 256
#: Suffixes of many prefixes whose subtrees are built together.
TOGETHER = 20_000
#: How many windows of an anchor go on together each time that a prefix is lengthened.
CELLS = (14, 5, 2, 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BITS = np.uint64(31)
LAST = (1 << 63) - 1


def prefix_words(least: int) -> int:
    """Words of an anchor's prefix: a window then has at most 62 places for its anchor."""
    return max(1, least // 5, least - 61)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class _Rolled:
    """Hashes of any stretch of words in constant time: sums of word hashes times powers of a number."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        with np.errstate(over="ignore"):
            self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _STEP)]), dtype=np.uint64)
            down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64)
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * down[:n], dtype=np.uint64)])

    def __call__(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[end] - self.sums[first]) * self.up[first])


def window_anchors(flat: pa.Array, offsets: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """(text, place, low, high, prefix, around) of each anchor of texts' windows.

    The windows that have the anchor start ``low`` to ``high`` words before it; ``around`` is a hash of
    those numbers and of all words in these windows.
    """
    n, width = len(flat), prefix_words(least)
    sizes = np.diff(offsets)
    coded = flat.dictionary_encode()
    digests = b"".join(map(xxhash.xxh128_digest, coded.dictionary.cast(pa.large_binary()).to_pylist()))
    lanes = np.frombuffer(digests, "<u8").reshape(-1, 2)[coded.indices.to_numpy(zero_copy_only=False)]
    one, two = _Rolled(lanes[:, 0]), _Rolled(lanes[:, 1])
    places = np.arange(max(0, n - width + 1))
    prefix = one(places, places + width)
    key = (prefix >> _BITS << _BITS) | places.astype(np.uint64)  # the first of the least
    reach, span = 1, least - width + 1
    while reach < span:
        more = min(reach, span - reach)
        key = np.minimum(key[:-more], key[more:])
        reach += more
    # windows that end in their text
    fits = np.maximum(sizes - least + 1, 0)
    starts = np.repeat(offsets[:-1] - np.concatenate([[0], np.cumsum(fits)[:-1]]), fits) + np.arange(fits.sum())
    text = np.repeat(np.arange(len(sizes)), fits)
    anchor = (key[starts] & np.uint64((1 << int(_BITS)) - 1)).astype(np.int64)
    edge = np.ones(len(starts), bool)
    edge[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(edge)
    last = np.append(first, len(starts))[1:] - 1
    place = anchor[first]
    high, low = place - starts[first], place - starts[last]
    around = two(place - high, place - low + least)
    with np.errstate(over="ignore"):
        around = _mixed(around + (low * 64 + high).astype(np.uint64) * _STEP)
    return text[first], place - offsets[text[first]], low, high, prefix[place].view(np.int64), around.view(np.int64)


def _known(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(d, r, id, text): the id as a place in the order, and what tells rows of one id apart."""
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("d"), F.xxhash64(id_col, F.col(text_col).cast("binary")).alias("r"),
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
    )


def _anchors(rows: DataFrame, least: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            texts = batch.column(2)
            for first, number in byte_groups(texts):
                flat, offsets = split_words(texts.slice(first, number))
                text, place, low, high, prefix, around = window_anchors(flat, offsets, least)
                of = pa.array(text + first)
                yield pa.record_batch(
                    [batch.column(0).take(of), batch.column(1).take(of), pa.array(place.astype(np.int32)), pa.array(low.astype(np.int16)), pa.array(high.astype(np.int16)), pa.array(prefix), pa.array(around)],
                    names=["d", "r", "place", "low", "high", "prefix", "around"],
                )

    return rows.select("d", "r", "text").mapInArrow(run, "d long, r long, place int, low short, high short, prefix long, around long")


def _surroundings(rows: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """(prefix, around, d, low, high, words) of the anchors in ``wanted``, their texts read again."""
    asked = wanted.groupBy("d", "r").agg(F.collect_list(F.struct("place", "low", "high", "prefix", "around")).alias("asked"))
    both = rows.select("d", "r", "text").join(asked, ["d", "r"]).dropDuplicates(["d", "r"]).select("d", "asked", "text")

    def run(batches):
        for batch in batches:
            for first, number in byte_groups(batch.column(2)):
                part = batch.slice(first, number)
                flat, offsets = split_words(part.column(2))
                of = pc.list_parent_indices(part.column(1)).to_numpy(zero_copy_only=False)
                place, low, high, prefix, around = (x for x in part.column(1).flatten().flatten())
                lo, hi = low.to_numpy(zero_copy_only=False).astype(np.int64), high.to_numpy(zero_copy_only=False).astype(np.int64)
                begin = offsets[of] + place.to_numpy(zero_copy_only=False) - hi
                size = hi - lo + least
                ends = np.concatenate([[0], np.cumsum(size)])
                spots = np.repeat(begin - ends[:-1], size) + np.arange(ends[-1])
                words = pa.LargeListArray.from_arrays(pa.array(ends), flat.take(pa.array(spots)))
                text = pc.binary_join(words, pa.scalar(" ", pa.large_string())).cast(pa.string())
                yield pa.record_batch([prefix, around, part.column(0).take(pa.array(of)), low, high, text], names=["prefix", "around", "d", "low", "high", "words"])

    return both.mapInArrow(run, "prefix long, around long, d long, low short, high short, words string")


def _ids(*parts: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the distinct combinations of non-negative numbers."""
    key = parts[0].astype(np.int64)
    for p in parts[1:]:
        key = np.unique(key * (int(p.max()) + 1 if len(p) else 1) + p, return_inverse=True)[1]
    return key


def subtree_repeats(group: np.ndarray, d: np.ndarray, low: np.ndarray, high: np.ndarray, flat: pa.Array, offsets: np.ndarray, least: int) -> np.ndarray:
    """For each suffix the bits (from its ``low``) of its windows that a smaller document has too.

    ``group`` numbers prefixes; row k's words, ``high`` of them before its anchor, are ``flat[offsets[k]:offsets[k + 1]]``.
    Nodes are refined a word at a time; a suffix that shares its node with no other leaves.
    """
    words = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    at, n, width = offsets[:-1] + high, len(group), prefix_words(least)
    left = [np.zeros(n, np.int64)]
    for k in range(int(high.max(initial=0))):
        node = np.zeros(n, np.int64)
        own = np.flatnonzero(high > k)
        node[own] = _ids(left[-1][own], words[at[own] - k - 1])
        left.append(node)
    bits = np.zeros(n, np.int64)
    alive, node = np.arange(n), group
    for depth in range(least + 1):
        if depth >= width:
            back = least - depth  # windows that start so many words before the anchor
            here = (low[alive] <= back) & (back <= high[alive])
            own = alive[here]
            if len(own):
                shared = _ids(node[here], left[back][own])
                order = np.lexsort((d[own], shared))
                edge = np.ones(len(order), bool)
                edge[1:] = shared[order[1:]] != shared[order[:-1]]
                least_d = np.empty(len(own), np.int64)
                least_d[order] = d[own][order[np.maximum.accumulate(np.where(edge, np.arange(len(order)), 0))]]
                hit = own[d[own] > least_d]
                bits[hit] |= np.int64(1) << (back - low[hit])
        if depth == least:
            break
        deeper = least - low[alive] > depth
        alive, node = alive[deeper], node[deeper]
        if not len(alive):
            break
        node = _ids(node, words[at[alive] + depth])
        kept = np.bincount(node)[node] > 1
        alive, node = alive[kept], node[kept]
    return bits


def _subtrees(rows: DataFrame, least: int) -> DataFrame:
    """(prefix0, around, bits) of rows (prefix, prefix0, around, d, low, high, start, words), whole prefixes in tasks."""

    def made(table: pa.Table):
        flat, offsets = split_words(table["words"].combine_chunks())
        prefix, d, low, high, start = (table[c].to_numpy().astype(np.int64) for c in ("prefix", "d", "low", "high", "start"))
        group = np.unique(prefix, return_inverse=True)[1]
        bits = subtree_repeats(group, d, low, high, flat, offsets, least) << (low - start)
        some = pa.array(bits != 0)
        out = pa.table({"prefix0": table["prefix0"], "around": table["around"], "bits": pa.array(bits)}).filter(some)
        return out.combine_chunks().to_batches()

    def run(batches):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size < TOGETHER:
                continue
            table = pa.Table.from_batches(held)
            prefix = table["prefix"].to_numpy()
            cut = int(np.searchsorted(prefix, prefix[-1]))  # the last prefix may go on
            if cut:
                yield from made(table.slice(0, cut))
            held, size = table.slice(cut).to_batches(), table.num_rows - cut
        if size:
            yield from made(pa.Table.from_batches(held))

    dealt = rows.select("prefix", "prefix0", "around", "d", "low", "high", "start", "words").repartition("prefix").sortWithinPartitions("prefix")
    return dealt.mapInArrow(run, "prefix0 long, around long, bits long")


def _lengthened(rows: DataFrame, cell: int, least: int) -> DataFrame:
    """Each row's windows in cells of ``cell`` places, with the words that all windows of a cell have as prefix."""
    low, high = F.col("low").cast("int"), F.col("high").cast("int")
    cells = rows.withColumn("_cell", F.explode(F.sequence((low / cell).cast("int"), (high / cell).cast("int"))))
    at = F.col("_cell") * cell
    new_low, new_high = F.greatest(low, at), F.least(high, at + cell - 1)
    all_words = F.split("words", " ")
    held = F.slice(all_words, high - new_high + 1, new_high - new_low + least)
    sure = F.slice(all_words, high - at + 1, F.lit(least - cell + 1))
    return cells.select(
        F.xxhash64(F.lit(cell), at, F.array_join(sure, " ")).alias("prefix"), "prefix0", "around", "d", new_low.cast("short").alias("low"),
        new_high.cast("short").alias("high"), "start", F.array_join(held, " ").alias("words"),
    )


def _shared(suffixes: DataFrame, least: int, most: int, folder: str) -> DataFrame:
    """(prefix, around, bits): the windows of each suffix that suffixes of smaller documents have too.

    ``suffixes``: (prefix, around, d, low, high, words), one for each ``around``.
    """
    rows = suffixes.withColumn("prefix0", F.col("prefix")).withColumn("start", F.col("low"))
    found = []
    places = least - prefix_words(least) + 1
    for step, cell in enumerate((*(c for c in CELLS if c < places), 0)):
        sizes = rows.groupBy("prefix").agg(F.count(F.lit(1)).alias("size"), F.min("d").alias("least"), F.max("d").alias("last"))
        sizes = stored(sizes.where("size > 1 and least < last"), f"{folder}/{step}-sizes")
        if not cell:  # whole windows now
            marked = join_to_groups(rows, sizes.select("prefix", "size", "least"), "prefix", "size", rows.count())
            found.append(marked.where("d > least").select("prefix0", "around", F.expr("shiftleft(1L, low - start)").alias("bits")))
            break
        few = rows.join(sizes.where(F.col("size") <= most).select("prefix"), "prefix")
        found.append(stored(_subtrees(few, least), f"{folder}/{step}-bits"))
        many = sizes.where(F.col("size") > most)
        if many.isEmpty():
            break
        rows = stored(_lengthened(join_to_groups(rows, many.select("prefix", "size"), "prefix", "size", rows.count()), cell, least), f"{folder}/{step}-rows")
    return reduce(DataFrame.unionByName, found).groupBy(F.col("prefix0").alias("prefix"), "around").agg(F.bit_or("bits").alias("bits"))


def repeated_windows(docs: DataFrame, least: int = 50, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """(d, r, place, low, high, bits): per anchor the windows (as bits from ``low``) that a smaller document has.

    ``d`` is the id, nulls as the largest; ``r`` a hash of id and text. Only anchors with such windows.
    """
    folder = workspace(docs.sparkSession, "substrings")
    rows = _known(docs, id_col, text_col)
    anchors = stored(_anchors(rows, least), f"{folder}/anchors")
    alike = stored(
        anchors.groupBy("prefix", "around").agg(
            F.min(F.struct("d", "r", "place", "low", "high")).alias("first"), F.max("d").alias("last"), F.count(F.lit(1)).alias("held")
        ).select("prefix", "around", "first.*", "last", "held"),
        f"{folder}/alike",
    )
    prefixes = alike.groupBy("prefix").agg(F.count(F.lit(1)).alias("size"), F.min("d").alias("least"), F.max("d").alias("most"))
    prefixes = stored(prefixes.where("size > 1 and least < most").select("prefix", "size"), f"{folder}/prefixes")
    wanted = join_to_groups(alike, prefixes, "prefix", "size", alike.count()).select("prefix", "around", "d", "r", "place", "low", "high")
    suffixes = stored(_surroundings(rows, wanted, least), f"{folder}/suffixes")
    bits = stored(_shared(suffixes, least, most, folder), f"{folder}/bits")
    known = alike.select("prefix", "around", F.col("d").alias("first"), "last", "held").join(bits, ["prefix", "around"], "left").where("last > first or bits is not null")
    known = stored(known.select(F.struct("prefix", "around").alias("key"), "first", "held", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")), f"{folder}/known")
    keyed = anchors.withColumn("key", F.struct("prefix", "around"))
    whole: Column = F.expr("shiftleft(1L, high - low + 1) - 1")
    out = join_to_groups(keyed, known, "key", "held", anchors.count())
    out = out.withColumn("bits", F.when(F.col("d") > F.col("first"), whole).otherwise(F.col("bits")))
    return out.where("bits <> 0").select("d", "r", "place", "low", "high", "bits")


def substring_dedup(docs: DataFrame, least: int = 50, id_col: str = "doc_id", text_col: str = "text", most: int = MOST) -> DataFrame:
    """(id_col, n_words, n_removed, spans, kept) for each row of ``docs``.

    Words are what ASCII white space parts. Each word is removed that a window of ``least`` words covers
    which also starts in a row with a smaller id, whatever of that row is removed itself. ``spans`` are the removed
    stretches as (start, length) in words, ``kept`` the other words, one space between.

    Ids are integers; null ids come last and count as equal. Rows of equal ids take nothing from each other. Null
    and empty texts have no words; an empty table gives no rows; other columns, whatever their names, are
    ignored. Suffixes meet by 64 bits of their prefix, and are taken as equal in all their windows where 128
    bits of both hashes are.
    """
    folder = workspace(docs.sparkSession, "substring-spans")
    windows = repeated_windows(docs, least, id_col, text_col, most)
    marks = stored(windows.groupBy("d", "r").agg(F.collect_set(F.struct("place", "low", "bits")).alias("marks")), f"{folder}/marks")
    rows = _known(docs, id_col, text_col)
    both = rows.join(marks, ["d", "r"], "left").select("id", "text", "marks")
    kind = rows.schema["id"].dataType.simpleString()

    def cut(texts: pa.Array, marks: pa.Array):
        flat, offsets = split_words(texts)
        n = len(flat)
        of = pc.list_parent_indices(marks).to_numpy(zero_copy_only=False)
        place, low, bits = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in marks.flatten().flatten())
        change = np.zeros(n + 1, np.int64)
        for k in range(int(low.max(initial=-1)) + 64 if len(low) else 0):
            own = np.flatnonzero((k >= low) & (k - low < 63) & ((bits >> np.clip(k - low, 0, 62)) & 1 == 1))
            begin = offsets[of[own]] + place[own] - k
            np.add.at(change, begin, 1)
            np.add.at(change, begin + least, -1)
        gone = np.cumsum(change[:n]) > 0
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # a stretch ends where its text does
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        inner = np.unique(inner[gone[inner - 1] & gone[inner]]) if len(inner) else inner
        begin, end = np.sort(np.concatenate([begin, inner])), np.sort(np.concatenate([end, inner]))
        which = np.searchsorted(offsets, begin, side="right") - 1
        ends = np.searchsorted(which, np.arange(len(texts) + 1))
        pairs = pa.StructArray.from_arrays([pa.array(begin - offsets[which]), pa.array(end - begin)], names=["start", "length"])
        spans = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pairs)
        ahead = np.concatenate([[0], np.cumsum(gone)])[offsets]
        left = pa.LargeListArray.from_arrays(pa.array(offsets - ahead), flat.filter(pa.array(~gone)))
        kept = pc.binary_join(left, pa.scalar(" ", pa.large_string())).cast(pa.string())
        return pa.array(np.diff(offsets)), pa.array(np.diff(ahead)), spans, kept

    def run(batches):
        for batch in batches:
            for first, number in byte_groups(batch.column(1)):
                part = batch.slice(first, number)
                yield pa.record_batch([part.column(0), *cut(part.column(1), part.column(2))], names=["id", "n_words", "n_removed", "spans", "kept"])

    out = both.mapInArrow(run, f"id {kind}, n_words long, n_removed long, spans array<struct<start:long,length:long>>, kept string")
    return out.withColumnRenamed("id", id_col)
