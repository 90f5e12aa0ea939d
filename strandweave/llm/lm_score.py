"""Stupid-backoff language-model scores (Brants et al., 2007), computed relationally.

S(w | history) is the relative frequency of the n-gram where the corpus has it, else ALPHA times the
score with a shorter history. All n-grams of all documents are counted; none is dropped.

``train`` and ``score``: tables of counts are partitioned by the hash of the history, so an n-gram
meets its history's count in the partition where it is counted. To score, texts are exploded into
their n-grams, dealt to the same partitions and joined there; what a partition doesn't know goes on
to the next shorter order, and the parts are summed per document. N-grams with over 1/HOT of all
tokens are few: scores of those come from a broadcast, and n-grams after such a history are dealt by
their own hash, so that no partition is crowded.

``split_scores`` is ``score(docs, train(known rows))`` in one go, for a table of which some rows are
counted and all are scored. A hold's distinct n-grams of all orders are dealt once by their hash; a
part counts its n-grams into its table, joins the table to what each hold asked for and answers with
counts, a byte each or so. The hold's texts then meet their counts, back off where there are none, and
are summed. So an n-gram travels once, whether it is counted, scored or both, and no text goes along.

``lm_scores`` counts and scores the same texts, so every longest history answers and the logs of a
text's relative frequencies, a difference of two counts' logs each, chain up: n-grams of the model's
order add the log of their count, the (order - 1)-grams within the text take theirs off. One
exploded row then serves both: a partition counts its n-grams and joins the counts to them at once.

All work in turns, each for the n-grams of one range of hashes, so that no shuffle holds all n-grams
of an order at once; rows travel packed, one row for many n-grams of a hold of texts. An n-gram that
is frequent in a hold is dealt as one count, which the partition answers to the hold.
"""

from __future__ import annotations

from collections import defaultdict
from contextlib import contextmanager
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import join_to_groups, row_order, stored, workspace

ORDER, ALPHA, TURNS = 3, 0.4, 2
#: n-grams with over 1/HOT of all tokens are at most HOT of each order: they are broadcast.
HOT = 65_536
#: Tokens that a worker holds before it passes on their n-grams; n-grams of a partition and turn;
#: n-grams of a row of a table; words remembered.
HOLD, PART, ROW, MEMORY = 600_000, 2_000_000, 500_000, 400_000
#: n-grams that are so often in a hold are answered to it instead of bringing their texts along.
OFTEN = 256
#: In place of an n-gram's key: the history stands at the end of a text.
END = np.uint64(0)
_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released_shuffles(spark):
    """Spark drops the shuffle files of each query that ends in here, which it stores elsewhere."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, 42) or 1
        if len(self) < MEMORY and len(word) <= 64:
            self[word] = h
        return h


_words = _Words()


def words_of(text: bytes | None) -> np.ndarray:
    """Keys of a text's words: ASCII lower case, cut at ASCII white space."""
    words = (text or b"").lower().split()
    return np.fromiter(map(_words.__getitem__, words), dtype=np.uint64, count=len(words))


def join_keys(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Key of the n-grams with these (n-1)-gram prefixes and suffixes; never END."""
    with np.errstate(over="ignore"):
        z = prefix * _MIX[0] + (suffix ^ (suffix >> np.uint64(29))) * _MIX[1] + np.uint64(1)
        z = (z ^ (z >> np.uint64(30))) * _MIX[1]
        z = (z ^ (z >> np.uint64(27))) * _MIX[2]
        z ^= z >> np.uint64(31)
        return z + (z == END)


def _keys(words: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams of 1 to ``order`` words that end at each token (of texts run together)."""
    out = [words]
    for _ in range(order - 1):
        key = np.ones_like(words)
        key[1:] = join_keys(out[-1][:-1], out[-1][1:])
        out.append(key)
    return out


def _find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where, found) of keys in a sorted array."""
    if not len(known):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    where = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return where, known[where] == keys


def _pack(a: np.ndarray) -> bytes:
    """Non-negative whole numbers in as few bytes each as the largest needs, which the last byte tells."""
    kind = next(w for w in (1, 2, 4, 8) if w == 8 or not len(a) or a.max() < 1 << 8 * w)
    return a.astype(f"<u{kind}").tobytes() + bytes([kind])


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(memoryview(data)[:-1], f"<u{data[-1]}").astype(np.int64)


def _holds(batches):
    """(other columns, words, starts) of texts, the last column, of about HOLD tokens at a time."""
    others, words, size = [], [], 0

    def close():
        sizes = np.array([len(w) for w in words])
        return [list(chain.from_iterable(c)) for c in zip(*others, strict=True)], np.concatenate(words), np.concatenate([[0], np.cumsum(sizes)])

    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            own = [words_of(x.as_py()) for x in part.columns[-1]]
            others.append([c.to_pylist() for c in part.columns[:-1]])
            words += own
            size += sum(map(len, own)) + len(own)
            if size >= HOLD:
                yield close()
                others, words, size = [], [], 0
    if words:
        yield close()


HELD = "a binary, b binary, sizes binary, words binary, at binary"


def _hold(texts: DataFrame, path: str) -> DataFrame:
    """Texts (a, b, text) cut into words once and stored: a row for each hold, with its distinct words."""

    def run(batches):
        for (a, b), words, starts in _holds(batches):
            known, at = np.unique(words, return_inverse=True)
            row = (np.array(a, np.int64).tobytes(), np.array(b, np.int64).tobytes(), _pack(np.diff(starts)), known.tobytes(), _pack(at))
            yield pa.record_batch([pa.array([x], pa.binary()) for x in row], names=[c.split()[0] for c in HELD.split(", ")])

    return stored(texts.select("a", "b", "text").mapInArrow(run, HELD), path)


def _held(batches):
    """((a, b), words, starts) of stored holds."""
    for batch in batches:
        for row in range(batch.num_rows):
            a, b, sizes, words, at = (c[row].as_py() for c in batch.columns)
            starts = np.concatenate([[0], np.cumsum(_unpack(sizes))]).astype(np.int64)
            yield (np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)), np.frombuffer(words, np.uint64)[_unpack(at)], starts


@dataclass
class NgramModel:
    """``table``: stored rows (k, turn, part, total, key, n, of) of packed n-grams, sorted by key: how
    often each occurs and how often its history does. ``hot``: (keys, n, log of n / of) of each order."""

    order: int
    alpha: float
    parts: int
    turns: int
    tokens: int = 0
    table: DataFrame | None = None
    hot: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def shape(self) -> NgramModel:
        """What tasks need to know."""
        return NgramModel(self.order, self.alpha, self.parts, self.turns, self.tokens, None, self.hot)

    def places(self, k: int, hist: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(turn, part) of n-grams of k words."""
        by = key if k == 1 else np.where(_find(self.hot[k - 2][0], hist)[1], key, hist)
        with np.errstate(over="ignore"):
            slot = ((by * _MIX[2]) >> np.uint64(20)).astype(np.int64)
        return slot % self.turns, slot // self.turns % self.parts

    def ngrams(self) -> DataFrame:
        """(k, key, n, of): a row for each n-gram of the model, by the 64-bit hash of its words."""
        tokens = self.tokens

        def run(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    n, of = _unpack(r["n"]), _unpack(r["of"]) if r["k"] > 1 else None
                    keys = np.frombuffer(r["key"], np.int64)
                    yield pa.record_batch([pa.array(np.full(len(n), r["k"], np.int32)), pa.array(keys), pa.array(n), pa.array(np.full(len(n), tokens) if of is None else of)], names=["k", "key", "n", "of"])

        return self.table.select("k", "key", "n", "of").mapInArrow(run, "k int, key long, n long, of long")


TABLE = "k int, turn int, part int, total long, key binary, n binary, of binary"


def _parcels(part: np.ndarray, make, names: list[str]):
    """One row for each part that occurs: ``make(part, rows of it)``."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order], prepend=-1))
    rows = [make(int(part[own[0]]), own) for own in np.split(order, cuts[1:])] if len(order) else []
    for at in range(0, len(rows), 64):
        columns = list(zip(*rows[at : at + 64], strict=True))
        kinds = [pa.int32() if isinstance(c[0], int) else pa.binary() for c in columns]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


def _explode_counts(k: int, turn: int, model: NgramModel):
    """Holds to (part, hist, key, n): n-grams of k words of one turn, counted for each hold."""

    def run(batches):
        for _, words, starts in _held(batches):
            sizes = np.diff(starts)
            place = np.arange(len(words)) - np.repeat(starts[:-1], sizes)
            keys = _keys(words, k)
            at = np.flatnonzero(place >= k - 1)
            key, hist = keys[k - 1][at], (keys[k - 2][at - 1] if k > 1 else np.zeros(len(at), np.uint64))
            if k > 1:
                ends = keys[k - 2][starts[1:][sizes >= k - 1] - 1]
                ends = ends[~_find(model.hot[k - 2][0], ends)[1]]
                key, hist = np.concatenate([key, np.full(len(ends), END)]), np.concatenate([hist, ends])
            turns, part = model.places(k, hist, key)
            own = np.flatnonzero(turns == turn)
            key, hist, part = key[own], hist[own], part[own]
            # an n-gram's key tells its history; ends of texts are told by their history
            tell = np.where(key == END, hist, key)
            order = np.argsort(tell)
            tell, key = tell[order], key[order]
            new = np.ones(len(tell), bool)
            new[1:] = (tell[1:] != tell[:-1]) | (key[1:] != key[:-1])
            first = np.flatnonzero(new)
            n = np.diff(np.append(first, len(tell)))
            key, hist, part = key[first], hist[order][first], part[order][first]
            yield from _parcels(part, lambda p, i: (p, hist[i].tobytes(), key[i].tobytes(), _pack(n[i])), ["part", "hist", "key", "n"])  # noqa: B023

    return run


def _count(k: int, turn: int, model: NgramModel):
    """The rows of a part to rows of the table."""

    def run(batches):
        held = defaultdict(lambda: ([], [], []))
        for batch in batches:
            for part, hist, key, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for own, x in zip(held[part], (np.frombuffer(hist, np.uint64), np.frombuffer(key, np.uint64), _unpack(n)), strict=True):
                    own.append(x)
        for part, columns in held.items():
            hist, key, n = (np.concatenate(c) for c in columns)
            end = key == END
            end_hist, end_n = hist[end], n[end]
            hist, key, n = hist[~end], key[~end], n[~end]
            order = np.argsort(key)
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
            if not len(first):
                continue
            key, hist, n = key[first], hist[order][first], np.add.reduceat(n[order], first)
            of = n
            if k > 1:
                known, inverse = np.unique(hist, return_inverse=True)
                where, found = _find(known, end_hist)
                total = np.bincount(inverse, n, len(known)) + np.bincount(where[found], end_n[found], len(known))
                of = total.astype(np.int64)[inverse]
                keys, counts, _ = model.hot[k - 2]
                where, found = _find(keys, hist)
                of[found] = counts[where[found]]
            for i in range(0, len(key), ROW):
                s = slice(i, i + ROW)
                yield pa.record_batch(
                    [pa.array([k], pa.int32()), pa.array([turn], pa.int32()), pa.array([part], pa.int32()), pa.array([int(n[s].sum())]), pa.array([key[s].tobytes()]), pa.array([_pack(n[s])]), pa.array([_pack(of[s]) if k > 1 else b"\x01"])],
                    names=["k", "turn", "part", "total", "key", "n", "of"],
                )

    return run


def _hot_of(table: DataFrame, k: int, tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams of k words with over 1/HOT of all tokens: at most HOT."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                n = _unpack(r["n"])
                of = np.full(len(n), tokens) if k == 1 else _unpack(r["of"])
                i = np.flatnonzero(n * HOT > tokens)
                yield pa.record_batch([pa.array(np.frombuffer(r["key"], np.int64)[i]), pa.array(n[i]), pa.array(of[i])], names=["key", "n", "of"])

    rows = table.select("key", "n", "of").mapInArrow(run, "key long, n long, of long").collect()
    key, n, of = (np.array([r[i] for r in rows], np.int64) for i in range(3))
    order = np.argsort(key.view(np.uint64))
    return key.view(np.uint64)[order], n[order], np.log(n[order] / of[order])


def train(docs: DataFrame, text_col: str = "text", order: int = ORDER, alpha: float = ALPHA, turns: int = TURNS, folder: str | None = None) -> NgramModel:
    """Counts of all n-grams of 1 to ``order`` words of all texts, stored below ``folder`` (a fresh
    one where none is given). Null texts have no words; repeated rows count each. No rows give an
    empty model.
    """
    spark = docs.sparkSession
    folder = folder or workspace(spark, "ngrams")
    none = F.lit(0).cast("long")
    texts = docs.select(none.alias("a"), none.alias("b"), F.col(text_col).cast("binary").alias("text"))
    size = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    # six bytes a word or so; only the size of parts hangs on it
    parts = max(spark.sparkContext.defaultParallelism, -(-size // (6 * turns * PART)))
    model = NgramModel(order, alpha, parts, turns)
    with released_shuffles(spark):
        holds = _hold(texts, f"{folder}/holds")
        for k in range(1, order + 1):
            own = []
            for turn in range(turns):
                sent = model.shape()
                exploded = holds.mapInArrow(_explode_counts(k, turn, sent), "part int, hist binary, key binary, n binary")
                counted = exploded.repartitionById(parts, "part").mapInArrow(_count(k, turn, sent), TABLE)
                own.append(stored(counted, f"{folder}/{k}-{turn}"))
            for t in own:
                model.table = t if model.table is None else model.table.unionByName(t)
            level = own[0]
            for t in own[1:]:
                level = level.unionByName(t)
            if k == 1:
                model.tokens = level.agg(F.sum("total")).first()[0] or 0
            model.hot.append(_hot_of(level, k, max(1, model.tokens)))
        spark.createDataFrame([], holds.schema).write.mode("overwrite").parquet(f"{folder}/holds")  # nothing reads them any more
    return model


ENTRIES = "kind int, k int, part int, a binary, b binary, doc binary, key binary, more binary"


def _grams(words: np.ndarray, k: int, at: np.ndarray) -> list[np.ndarray]:
    """The k words of the n-grams that end at these tokens."""
    return [words[at - i] for i in range(k - 1, -1, -1)]


def _gram_keys(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(history, key) of n-grams by their words."""
    keys, hist = grams, np.zeros(len(grams[0]), np.uint64)
    while len(keys) > 1:
        hist = keys[0]
        keys = [join_keys(a, b) for a, b in zip(keys, keys[1:], strict=False)]
    return hist, keys[0]


def _entries(model: NgramModel, a: np.ndarray, b: np.ndarray, doc: np.ndarray, grams: list[np.ndarray], turn: int | None):
    """Rows of n-grams, but hot ones, of one turn or all, for their parts: distinct words and each n-gram's places in them."""
    k = len(grams)
    hist, key = _gram_keys(grams)
    rest = ~_find(model.hot[k - 1][0], key)[1]
    turns, part = model.places(k, hist, key)
    own = np.flatnonzero(rest & (turns == turn) if turn is not None else rest)
    part = part[own]

    def make(p, i):
        i = own[i]
        docs, local = np.unique(doc[i], return_inverse=True)
        words, at = np.unique(np.concatenate([g[i] for g in grams]), return_inverse=True)
        return 1, k, p, a[docs].tobytes(), b[docs].tobytes(), _pack(local), words.tobytes(), _pack(at)

    yield from _parcels(part, make, [c.split()[0] for c in ENTRIES.split(", ")])


def _explode(model: NgramModel, orders: tuple[int, ...], turn: int | None):
    """Holds to their n-grams of some orders: of the model's own order those at all tokens, of shorter
    ones those at the texts' beginnings."""

    def run(batches):
        for (a, b), words, starts in _held(batches):
            sizes = np.diff(starts)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(words)) - starts[doc]
            for k in orders:
                at = np.flatnonzero(place >= k - 1 if k == model.order else place == k - 1)
                if len(at):
                    yield from _entries(model, a, b, doc[at], _grams(words, k, at), turn)

    return run


JOINED = "a long, b long, s double, entry struct<kind int, k int, part int, a binary, b binary, doc binary, key binary, more binary>"
_ENTRY = pa.struct([("kind", pa.int32()), ("k", pa.int32()), ("part", pa.int32()), *((n, pa.binary()) for n in ("a", "b", "doc", "key", "more"))])


def _join(model: NgramModel):
    """Rows of a part, the table's (kind 0) first: sums per text, and entries of the next order."""
    back = np.log(model.alpha)

    def run(batches):
        known: dict[int, list] = {}
        ready: dict[int, tuple[np.ndarray, np.ndarray]] = {}

        def table(k):
            if k not in ready:
                rows = known.pop(k, [])
                keys = np.concatenate([np.empty(0, np.uint64), *(np.frombuffer(r[0], np.uint64) for r in rows)])
                n = np.concatenate([np.empty(0), *(_unpack(r[1]) for r in rows)])
                of = np.concatenate([np.empty(0), *(_unpack(r[2]) for r in rows)]) if k > 1 else model.tokens
                value = np.log(n / of)
                if (keys[1:] < keys[:-1]).any():
                    order = np.argsort(keys)
                    keys, value = keys[order], value[order]
                ready[k] = keys, value
            return ready[k]

        def sums(a, b, doc, value):
            own, local = np.unique(doc, return_inverse=True)
            total = np.bincount(local, value, len(own))
            return pa.record_batch([pa.array(a[own]), pa.array(b[own]), pa.array(total), pa.nulls(len(own), _ENTRY)], names=["a", "b", "s", "entry"])

        for batch in batches:
            for r in batch.to_pylist():
                k = r["k"]
                if r["kind"] == 0:
                    known.setdefault(k, []).append((r["key"], r["more"], r["doc"]))
                    continue
                a, b = np.frombuffer(r["a"], np.int64), np.frombuffer(r["b"], np.int64)
                doc, grams = _unpack(r["doc"]), list(np.frombuffer(r["key"], np.uint64)[_unpack(r["more"])].reshape(k, -1))
                key = _gram_keys(grams)[1]
                keys, value = table(k)
                where, found = _find(keys, key)
                if found.any():
                    yield sums(a, b, doc[found], value[where[found]])
                if found.all() or k == 1:
                    continue
                left = np.flatnonzero(~found)
                yield sums(a, b, doc[left], np.full(len(left), back))
                # hot n-grams are known here; the others go on to their parts
                grams, k = [g[left] for g in grams[1:]], k - 1
                hot, _, values = model.hot[k - 1]
                where, found = _find(hot, _gram_keys(grams)[1])
                if found.any():
                    yield sums(a, b, doc[left[found]], values[where[found]])
                if found.all():
                    continue
                for e in _entries(model, a, b, doc[left[~found]], [g[~found] for g in grams], None):
                    none = [pa.nulls(e.num_rows, t) for t in (pa.int64(), pa.int64(), pa.float64())]
                    yield pa.record_batch([*none, pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(e.columns, _ENTRY, strict=True)], fields=list(_ENTRY))], names=["a", "b", "s", "entry"])

    return run


def _beginnings(model: NgramModel, kind: str):
    """Each text's row: (id, a, b, number of tokens, score of its hot n-grams)."""

    def run(batches):
        for (ids, a, b), words, starts in _holds(batches):
            sizes = np.diff(starts)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(words)) - starts[doc]
            keys = _keys(words, model.order)
            total = np.zeros(len(sizes))
            for k in range(1, model.order + 1):
                at = np.flatnonzero(place >= k - 1 if k == model.order else place == k - 1)
                where, found = _find(model.hot[k - 1][0], keys[k - 1][at])
                total += np.bincount(doc[at][found], model.hot[k - 1][2][where[found]], len(sizes))
            yield pa.record_batch([pa.array(ids, kind), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sizes.astype(np.int64)), pa.array(total)], names=["id", "a", "b", "t", "s"])

    return run


def score(docs: DataFrame, model: NgramModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, log_score, mean_log_score): natural logs; the mean is null without tokens.

    Words that training never saw count nothing but their backing off. A null text has no tokens.
    Rows that repeat an id are scored each. Other columns are ignored; no rows give no rows. Texts are
    told apart by id and text hash.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "lm-score")
    slim = _keyed(docs, id_col, text_col)
    sent = model.shape()

    def joined(entries, orders, turn, path):
        own = model.table.where(F.col("k").isin(*orders))
        if turn is not None:
            own = own.where(F.col("turn") == turn)
        own = own.select(F.lit(0).alias("kind"), "k", "part", *(F.lit(None).cast("binary").alias(c) for c in "ab"), F.col("of").alias("doc"), "key", F.col("n").alias("more"))
        dealt = own.unionByName(entries).repartitionById(model.parts, "part").sortWithinPartitions("kind")
        return stored(dealt.mapInArrow(_join(sent), JOINED), path)

    with released_shuffles(spark):
        first = slim.schema["id"].dataType
        base = stored(slim.mapInArrow(_beginnings(sent, _arrow_type(first)), f"id {first.simpleString()}, a long, b long, t long, s double"), f"{folder}/base")
        holds = _hold(slim, f"{folder}/holds")
        found, waiting = [], []
        for turn in range(model.turns):
            entries = holds.mapInArrow(_explode(sent, (model.order,), turn), ENTRIES)
            out = joined(entries, (model.order,), turn, f"{folder}/{model.order}-{turn}")
            found.append(out)
            waiting.append(out)
        for k in range(model.order - 1, 0, -1):
            orders = (k,)
            entries = holds.mapInArrow(_explode(sent, orders, None), ENTRIES)
            for w in waiting:
                entries = entries.unionByName(w.where(F.col("entry.k").isin(*orders)).select("entry.*"))
            out = joined(entries, orders, None, f"{folder}/{orders[0]}")
            found.append(out)
            waiting.append(out)
        none = F.lit(None).cast(first).alias("id")
        rows = base.select("id", "a", "b", "t", "s", F.lit(1).cast("long").alias("m"))
        for f in found:
            rows = rows.unionByName(f.where("a is not null").select(none, "a", "b", F.lit(0).cast("long").alias("t"), "s", F.lit(0).cast("long").alias("m")))
        total = rows.groupBy("a", "b").agg(F.max("id").alias("id"), F.max("t").alias("n_tokens"), F.sum("m").alias("m"), F.sum("s").alias("s"))
        total = stored(total.select(F.struct("a", "b").alias("key"), "id", "n_tokens", "m", (F.col("s") / F.col("m")).alias("log_score")), f"{folder}/scores")
    return _per_row(total, slim, id_col)


def _arrow_type(kind) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


ASKED = "part int, k int, hold long, slot int, key binary, n binary"
_ASKED = pa.schema([("part", pa.int32()), ("k", pa.int32()), ("hold", pa.int64()), ("slot", pa.int32()), ("key", pa.binary()), ("n", pa.binary())])
_ANSWERED = pa.schema([f for f in _ASKED if f.name in ("k", "hold", "slot", "n")])
_EVEN = ~np.uint64(1)


def _pack_counts(n: np.ndarray) -> bytes:
    """Counts in a byte each; those of 255 and more follow in full."""
    large = n[n >= 255]
    return np.minimum(n, 255).astype(np.uint8).tobytes() + large.astype("<i8").tobytes() + np.int64(len(large)).tobytes()


def _unpack_counts(data: bytes) -> np.ndarray:
    n_large = int(np.frombuffer(data[-8:], "<i8")[0])
    end = len(data) - 8 * (n_large + 1)
    out = np.frombuffer(data, np.uint8, end).astype(np.int64)
    if n_large:
        out[out == 255] = np.frombuffer(data, "<i8", n_large, end)
    return out


def _hold_split(texts: DataFrame, kind: str, path: str) -> DataFrame:
    """Texts (id, known, text) cut into words once and stored: a row for each hold, which numbers it."""
    ddl = f"hold long, ids array<{kind}>, known binary, tokens long, sizes binary, words binary, at binary"
    ids_type = pa.list_(_arrow_type(texts.schema["id"].dataType))

    def run(batches):
        hold = TaskContext.get().partitionId() << 32
        for (ids, flags), words, starts in _holds(batches):
            known, sizes = np.array(flags, bool), np.diff(starts)
            own, at = np.unique(words, return_inverse=True)
            row = (hold, ids, known.tobytes(), int(sizes[known].sum()), _pack(sizes), own.tobytes(), _pack(at))
            kinds = (pa.int64(), ids_type, pa.binary(), pa.int64(), *[pa.binary()] * 3)
            yield pa.record_batch([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], names=[c.split()[0] for c in ddl.split(", ")])
            hold += 1

    return stored(texts.mapInArrow(run, ddl), path)


def _opened(sizes: bytes, words: bytes, at: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, text, place in the text) of a stored hold's tokens."""
    n = _unpack(sizes)
    doc = np.repeat(np.arange(len(n)), n)
    return np.frombuffer(words, np.uint64)[_unpack(at)], doc, np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)


def _ask(order: int, turn: int, turns: int, parts: int):
    """Holds (hold, known, sizes, words, at) to their distinct n-grams of all orders in one turn's range of hashes, with their known counts, a row a part."""

    def run(batches):
        for batch in batches:
            for hold, known, sizes, words, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words, doc, place = _opened(sizes, words, at)
                counted = np.frombuffer(known, np.uint8)[doc].astype(np.uint64)
                rows = []
                for k, key in enumerate(_keys(words, order), 1):
                    # parts are ranges of hashes; the last bit tells the known, so one sort counts them
                    slot = ((key >> np.uint64(32)) * np.uint64(parts * turns)) >> np.uint64(32)
                    own = (place >= k - 1) & (slot // np.uint64(parts) == turn)
                    key = np.sort(key[own] & _EVEN | counted[own])
                    if not len(key):
                        continue
                    flag, key = key & np.uint64(1), key & _EVEN
                    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                    n, key = np.add.reduceat(flag, first).astype(np.int64), key[first]
                    slot = (((key >> np.uint64(32)) * np.uint64(parts * turns)) >> np.uint64(32)).astype(np.int64)
                    cuts = np.append(np.flatnonzero(np.diff(slot, prepend=-1)), len(slot))
                    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                        rows.append((int(slot[i]) % parts, k, hold, int(slot[i]), key[i:j].tobytes(), _pack_counts(n[i:j])))
                for i in range(0, len(rows), 64):
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 64], strict=True), _ASKED, strict=True)], schema=_ASKED)

    return run


def _answer():
    """A part's rows: its n-grams are counted, and the counts joined to what each hold asked for."""

    def run(batches):
        asked = defaultdict(list)
        for batch in batches:
            for _, k, hold, slot, key, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                asked[k].append((hold, slot, key, n))
        for k in sorted(asked):
            rows = asked.pop(k)
            key = np.frombuffer(b"".join(r[2] for r in rows), np.uint64)
            n = np.concatenate([_unpack_counts(r[3]) for r in rows])
            ends = np.cumsum([len(r[2]) // 8 for r in rows])
            order = np.argsort(key)
            key = key[order]
            new = np.concatenate([[True], key[1:] != key[:-1]])
            table = np.add.reduceat(n[order], np.flatnonzero(new))
            n[order] = table[np.cumsum(new) - 1]
            del key, new, order, table
            heads, counts = [(k, hold, slot) for hold, slot, _, _ in rows], np.split(n, ends[:-1])
            del rows
            for i in range(0, len(heads), 64):
                own = [(*head, _pack_counts(x)) for head, x in zip(heads[i : i + 64], counts[i : i + 64], strict=True)]
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*own, strict=True), _ANSWERED, strict=True)], schema=_ANSWERED)

    return run


def _meet(order: int, alpha: float, total: int, kind: pa.DataType):
    """Rows sorted by hold, k and slot, each hold's own (k 0) before its answers, to each text's (id, n_tokens, log_score)."""
    back = np.log(alpha)

    def close(head, answers):
        words, doc, place = _opened(head["sizes"], head["words"], head["at"])
        counts = [np.full(len(words), total)]  # of the n-gram of k words that ends at each token, 0 where there is none
        for k, key in enumerate(_keys(words, order), 1):
            at = np.flatnonzero(place >= k - 1)
            found = np.zeros(len(words), np.int64)
            if len(at):
                inverse = np.unique(key[at] & _EVEN, return_inverse=True)[1]
                found[at] = np.concatenate([_unpack_counts(x) for x in answers[k]])[inverse]
            counts.append(found)
        most = np.minimum(place, order - 1)
        value, left = back * most, np.ones(len(words), bool)
        for k in range(order, 0, -1):
            at = np.flatnonzero(left & (counts[k] > 0))
            before = counts[k - 1][at - 1] if k > 1 else total
            value[at] = np.log(counts[k][at] / before) + back * (most[at] + 1 - k)
            left[at] = False
        sizes = _unpack(head["sizes"])
        return pa.record_batch([pa.array(head["ids"], kind), pa.array(sizes), pa.array(np.bincount(doc, value, len(sizes)), pa.float64())], names=["id", "n_tokens", "log_score"])

    def run(batches):
        head, answers = None, defaultdict(list)
        for batch in batches:
            for row in range(batch.num_rows):
                k = batch.column("k")[row].as_py()
                if k:
                    answers[k].append(batch.column("n")[row].as_py())
                    continue
                if head:
                    yield close(head, answers)
                head, answers = {c: batch.column(c)[row].as_py() for c in ("ids", "sizes", "words", "at")}, defaultdict(list)
        if head:
            yield close(head, answers)

    return run


def split_scores(docs: DataFrame, known: Column, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, alpha: float = ALPHA, turns: int = TURNS) -> DataFrame:
    """(id_col, n_tokens, log_score, mean_log_score) of all rows under the model of all rows where
    ``known`` holds: what ``score(docs, train(docs.where(known)))`` gives, with each n-gram dealt once.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "split-scores")
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(known, F.lit(False)).alias("known"), F.col(text_col).cast("binary").alias("text"))
    kind = slim.schema["id"].dataType
    with released_shuffles(spark):
        holds = _hold_split(slim, kind.simpleString(), f"{folder}/holds")
        total, held = holds.agg(F.sum("tokens"), F.sum(F.length("at"))).first()
        # two bytes of a hold a word and under two n-grams a word; only the size of parts hangs on it
        parts = max(spark.sparkContext.defaultParallelism, -(-(held or 0) // (turns * PART)))
        rows = holds.select("hold", F.lit(0).alias("k"), F.lit(0).alias("slot"), F.lit(None).cast("binary").alias("n"), "ids", "sizes", "words", "at")
        for turn in range(turns):
            asked = holds.select("hold", "known", "sizes", "words", "at").mapInArrow(_ask(order, turn, turns, parts), ASKED)
            answers = asked.repartitionById(parts, "part").mapInArrow(_answer(), "k int, hold long, slot int, n binary")
            rows = rows.unionByName(stored(answers, f"{folder}/answers-{turn}"), allowMissingColumns=True)
        homes = max(2 * spark.sparkContext.defaultParallelism, -(-(held or 0) // (8 * HOLD)))
        met = rows.repartition(homes, "hold").sortWithinPartitions("hold", "k", "slot").select("k", "n", "ids", "sizes", "words", "at")
        met = met.mapInArrow(_meet(order, alpha, total or 0, _arrow_type(kind)), f"id {kind.simpleString()}, n_tokens long, log_score double")
        out = stored(met, f"{folder}/scores")
    return out.select(F.col("id").alias(id_col), "n_tokens", "log_score", F.expr("log_score / nullif(n_tokens, 0)").alias("mean_log_score"))


OWN = "part int, kind int, hold long, size int, sign int, key binary, n binary, m binary, doc binary, a binary, b binary"
_OWN = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("hold", pa.int64()), ("size", pa.int32()), ("sign", pa.int32()), *((c, pa.binary()) for c in ("key", "n", "m", "doc", "a", "b"))])
#: Kinds of rows: a hold's texts; its n-grams for a part; those it has often, their counts for a part and their
#: texts for itself; a part's sums and its answers for a hold.
TEXTS, GRAMS, COUNTS, PLACES, SUMS, ANSWERS = range(6)


def _classes(words: np.ndarray, starts: np.ndarray, order: int):
    """(keys, texts, is it counted, which occurrences a text's score takes, sign) of n-grams of a hold.

    For a text of n words: +log count of each n-gram of ``order`` words; -log count of each
    (order - 1)-gram but the first and the last; for n < order +log count of the whole text.
    """
    sizes = np.diff(starts)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(words)) - starts[doc]
    keys = _keys(words, order)
    at = np.flatnonzero(place >= order - 1)
    yield keys[order - 1][at], doc[at], True, np.ones(len(at), bool), 1
    if order == 1:
        return
    at = np.flatnonzero(place >= order - 2)
    inner = (place[at] > order - 2) & (place[at] < sizes[doc[at]] - 1)
    yield keys[order - 2][at], doc[at], True, inner, -1
    for k in range(1, order):
        short = np.flatnonzero(sizes == k)
        if len(short):
            yield keys[k - 1][starts[1:][short] - 1], short, False, np.ones(len(short), bool), 1
        if k < order - 1:
            at = np.flatnonzero(place >= k - 1)
            yield keys[k - 1][at], doc[at], True, np.zeros(len(at), bool), 1


def _explode_own(order: int, turn: int, turns: int, parts: int):
    """Texts (a, b, text) to the packed n-grams of one turn, by the part that counts them."""

    def run(batches):
        serial = TaskContext.get().partitionId() << 32
        for (a, b), words, starts in _holds(batches):
            hold, size, rows = serial, len(starts) - 1, []
            serial += 1

            def add(part, kind, sign=0, key=None, n=None, m=None, doc=None, a=None, b=None):
                rows.append((part, kind, hold, size, sign, key, n, m, doc, a, b))  # noqa: B023

            sizes = np.diff(starts)
            add(hold % parts, TEXTS, n=_pack(sizes), a=np.array(a, np.int64).tobytes(), b=np.array(b, np.int64).tobytes())
            for key, doc, counted, taken, sign in _classes(words, starts, order):
                own = np.flatnonzero((key >> np.uint64(9)) % np.uint64(turns) == turn) if turns > 1 else slice(None)
                with np.errstate(over="ignore"):
                    key = key[own] * _MULTIPLY  # one to one; parts are ranges of it
                if not len(key):
                    continue
                by = np.argsort(key)
                key, doc, taken = key[by], doc[own][by], taken[own][by]
                new = np.ones(len(key), bool)
                new[1:] = key[1:] != key[:-1]
                first = np.flatnonzero(new)
                key, n = key[first], np.diff(np.append(first, len(key)))
                m = np.add.reduceat(taken.astype(np.int64), first)
                doc = doc[taken]
                part = (((key >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
                often = n >= OFTEN if counted else np.zeros(len(n), bool)
                if often.any():
                    mine = np.repeat(often, m)
                    add(hold % parts, PLACES, sign, key[often].tobytes(), m=_pack(m[often]), doc=_pack(doc[mine]))
                    for p in np.unique(part[often]).tolist():
                        i = often & (part == p)
                        add(p, COUNTS, 0, key[i].tobytes(), _pack(n[i]))
                    key, n, m, part, doc = key[~often], n[~often], m[~often], part[~often], doc[~mine]
                cuts = np.searchsorted(part, np.arange(parts + 1))
                ends = np.concatenate([[0], np.cumsum(m)])
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    i, j = cuts[p], cuts[p + 1]
                    add(p, GRAMS, sign, key[i:j].tobytes(), _pack(n[i:j]) if counted else None, _pack(m[i:j]), _pack(doc[ends[i] : ends[j]]))
            for i in range(0, len(rows), 64):
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 64], strict=True), _OWN, strict=True)], schema=_OWN)

    return run


def _row(kind, hold, **values):
    own = {"part": 0, "kind": kind, "hold": hold} | values
    return pa.RecordBatch.from_pylist([own], schema=_OWN)


def _count_own():
    """A part's rows: its n-grams are counted, and the counts joined to the n-grams of each hold."""

    def run(batches):
        held = []
        for batch in batches:
            for r in batch.to_pylist():
                if r["kind"] in (GRAMS, COUNTS):
                    keys = np.frombuffer(r["key"], np.uint64)
                    held.append((r["kind"], r["hold"], r["sign"], keys, r["n"], r["m"], r["doc"]))
                else:
                    yield pa.RecordBatch.from_pylist([r], schema=_OWN)
        counted = [(k, n) for _, _, _, k, n, _, _ in held if n is not None]
        if not held:
            return
        keys, n = np.concatenate([k for k, _ in counted]), np.concatenate([_unpack(n) for _, n in counted])
        by = np.argsort(keys)
        keys = keys[by]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        keys, count = keys[first], np.add.reduceat(n[by], first)
        del n, by, new
        logs = np.log(count)
        for kind, hold, sign, own, _, m, doc in held:
            at = np.searchsorted(keys, own)
            if kind == COUNTS:
                yield _row(ANSWERS, hold, key=own.tobytes(), n=_pack(count[at]))
                continue
            doc = _unpack(doc)
            if len(doc):
                texts, local = np.unique(doc, return_inverse=True)
                sums = np.bincount(local, sign * np.repeat(logs[at], _unpack(m)), len(texts))
                yield _row(SUMS, hold, doc=_pack(texts), m=sums.tobytes())

    return run


def _sum_own(first_turn: bool):
    """Rows sorted by hold: sums of its texts, (a, b, s, t); words are told in the first turn."""

    def close(rows):
        head = next(r for r in rows if r["kind"] == TEXTS)
        a, b, sizes = np.frombuffer(head["a"], np.int64), np.frombuffer(head["b"], np.int64), _unpack(head["n"])
        total = np.zeros(len(a))
        for r in rows:
            if r["kind"] == SUMS:
                total[_unpack(r["doc"])] += np.frombuffer(r["m"], np.float64)
        answers = [(np.frombuffer(r["key"], np.uint64), _unpack(r["n"])) for r in rows if r["kind"] == ANSWERS]
        if answers:
            keys, counts = (np.concatenate(c) for c in zip(*answers, strict=True))
            by = np.argsort(keys)
            keys, logs = keys[by], np.log(counts[by])
            for r in rows:
                if r["kind"] == PLACES:
                    at = np.searchsorted(keys, np.frombuffer(r["key"], np.uint64))
                    total += np.bincount(_unpack(r["doc"]), r["sign"] * np.repeat(logs[at], _unpack(r["m"])), len(a))
        return pa.record_batch([pa.array(a), pa.array(b), pa.array(total), pa.array(sizes if first_turn else np.zeros(len(a), np.int64))], names=["a", "b", "s", "t"])

    def run(batches):
        rows: list[dict] = []
        for batch in batches:
            for r in batch.to_pylist():
                if rows and rows[0]["hold"] != r["hold"]:
                    yield close(rows)
                    rows = []
                rows.append(r)
        if rows:
            yield close(rows)

    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, turns: int = TURNS) -> DataFrame:
    """Scores of all rows under the model of all rows: (id_col, n_tokens, log_score, mean_log_score).

    As each n-gram of a row was counted, its longest history always answers and nothing backs off:
    what ``score(docs, train(docs))`` gives, at the cost of reading the texts once a turn. Natural
    logs; a null text has no tokens; a text without tokens scores 0 with a null mean. Rows that repeat
    an id are scored each; rows that repeat id and text share their score. Other columns are ignored;
    no rows give no rows.
    """
    spark = docs.sparkSession
    folder = workspace(spark, "lm-scores")
    slim = _keyed(docs, id_col, text_col)
    texts = slim.select("a", "b", "text")
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, -(-size // (4 * turns * PART)))  # six bytes a word, three n-grams for two words
    found = None
    with released_shuffles(spark):
        for turn in range(turns):
            dealt = texts.mapInArrow(_explode_own(order, turn, turns, parts), OWN).repartitionById(parts, "part")
            told = stored(dealt.mapInArrow(_count_own(), OWN), f"{folder}/parts-{turn}")
            out = told.repartition(parts, "hold").sortWithinPartitions("hold").mapInArrow(_sum_own(turn == 0), "a long, b long, s double, t long")
            out = stored(out, f"{folder}/sums-{turn}")
            spark.createDataFrame([], told.schema).write.mode("overwrite").parquet(f"{folder}/parts-{turn}")  # nothing reads it any more
            found = out if found is None else found.unionByName(out)
        total = found.agg(F.sum("t")).first()[0] or 1
        kind = slim.schema["id"].dataType
        rows = slim.select("id", "a", "b", F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("t"), F.lit(1).cast("long").alias("m"))
        rows = rows.unionByName(found.select(F.lit(None).cast(kind).alias("id"), "a", "b", "s", "t", F.lit(0).cast("long").alias("m")))
        rows = rows.groupBy("a", "b").agg(F.max("id").alias("id"), F.sum("t").alias("t"), F.sum("m").alias("m"), F.sum("s").alias("s"))
        n = (F.col("t") / F.col("m")).cast("long")
        base = F.log(F.lit(float(total))) * (F.col("n_tokens") if order == 1 else F.when(F.col("n_tokens") > 0, 1.0).otherwise(0.0))
        rows = rows.select(F.struct("a", "b").alias("key"), "id", n.alias("n_tokens"), "m", (F.col("s") / F.col("m")).alias("s"))
        rows = stored(rows.select("key", "id", "n_tokens", "m", (F.col("s") - base).alias("log_score")), f"{folder}/scores")
    return _per_row(rows, slim, id_col)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, a, b, text): a and b tell a row by its id and its text's hash."""
    slim = docs.select(F.col(id_col).alias("id"), row_order(id_col, text_col).alias("_key"), F.col(text_col).cast("binary").alias("text"))
    return slim.select("id", F.xxhash64("id", "_key.a").alias("a"), F.xxhash64("_key.b", "id").alias("b"), "text")


def _per_row(total: DataFrame, slim: DataFrame, id_col: str) -> DataFrame:
    """Scores of (key, id, n_tokens, m, log_score) for each row; m rows that repeat id and text share one."""
    out = total.where("m = 1").select("id", "n_tokens", "log_score")
    again = total.where("m > 1").drop("id")
    if not again.isEmpty():
        rows = slim.select("id", F.struct("a", "b").alias("key"))
        out = out.unionByName(join_to_groups(rows, again, "key", "m", rows.count()).select("id", "n_tokens", "log_score"))
    return out.select(F.col("id").alias(id_col), "n_tokens", "log_score", F.expr("log_score / nullif(n_tokens, 0)").alias("mean_log_score"))
