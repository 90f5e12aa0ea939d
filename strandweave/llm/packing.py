"""Best-fit packing of tokenised documents into sequences of bounded length.

Packing is a bounded-space online best fit: each task keeps a fixed number of open bins in a bitset
keyed by free space; a piece goes to the open bin with the least sufficient space, and where a new
bin would be one too many the fullest closes first. Rows reach a task in windows, longest pieces
first within a window, so that the short ones that follow fill what the long ones left.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import stored, workspace

MAX_LENGTH = 4096
END_ID = 1
#: Open bins of a task, pieces of a window and pieces of a task.
OPEN_BINS, WINDOW, TASK_PIECES = 65_536, 50_000, 1_000_000
#: Words remembered by a worker; longer words than LONG aren't.
MEMORY, LONG = 800_000, 64
ROWS = 256
_SIGNS = bytes(b for b in range(33, 127) if not chr(b).isalnum())


class BestFit:
    """Open bins by free space. ``place`` gives (bin, offset); bins are numbered as they open."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.limit = capacity, open_bins
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = 0  # bit f: some open bin has f free
        self.open = self.opened = 0

    def _take(self, space: int) -> int:
        bins = self.free[space]
        out = bins.pop()
        if not bins:
            self.bits ^= 1 << space
        self.open -= 1
        return out

    def place(self, length: int) -> tuple[int, int]:
        fits = self.bits >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            chosen = self._take(space)
        else:
            if self.open >= self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
            chosen, space = self.opened, self.capacity
            self.opened += 1
        left = space - length
        if left:
            if not self.free[left]:
                self.bits |= 1 << left
            self.free[left].append(chosen)
            self.open += 1
        return chosen, self.capacity - space


def _is_letters(word: str) -> bool:
    """Letters that stay letters in lower case, which puts a mark in place of some."""
    return word.isalpha() and word.lower().isalpha()


class WordIds:
    """Ids of whole texts, by words where the tokenizer allows it.

    Where ASCII white space ends a token and is dropped and letters are lower-cased (tried on load),
    each word has ids of its own. Texts that may hold one of the tokenizer's added tokens, which it
    finds before it splits words, and all texts of other tokenizers are encoded whole.
    """

    PROBE = "The QUICK  brown\t\nFox's 12,345 (odd) Ünï-Code\x0b\x0c\r re-tokenised... a"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        added = {t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.marks = sorted(added)
        vocab = self.tokenizer.get_vocab()
        # ids that end a word, where the vocabulary marks them
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        probe = self.PROBE.encode()
        each = self._each(list(dict.fromkeys(probe.lower().split())))
        self.by_words = b"".join(each[w] for w in probe.lower().split()) == self._whole(probe) and self._whole(b" \t\n") == b""

    def _whole(self, text: bytes) -> bytes:
        ids = self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _each(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words, each encoded by itself."""
        got = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return dict(zip(words, (np.array(e.ids, dtype="<u4").tobytes() for e in got), strict=True))

    def _letters(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words of letters, encoded as one text and cut after the ids that end a word.

        Every word has one such id at least; so where there are as many as words, each has one.
        """
        ids = np.array(self.tokenizer.encode_batch_fast([b" ".join(words).decode()], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words) or cuts[-1] != len(ids):
            return self._each(words)
        data, bounds = ids.tobytes(), [0, *(4 * cuts).tolist()]
        return {w: data[a:b] for w, a, b in zip(words, bounds, bounds[1:], strict=False)}

    def _new(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words not known yet. Signs after a word of letters are a token of their own."""
        stems = {w: w.rstrip(_SIGNS) for w in words}
        plain = {s: _is_letters(s.decode("utf-8", "replace")) for s in stems.values()}
        parts = {x for w, s in stems.items() if plain[s] for x in (s, w[len(s) :]) if x and x not in self.known}
        letters = [x for x in parts if plain.get(x)]
        other = [x for x in parts if not plain.get(x)] + [w for w, s in stems.items() if not plain[s] and w not in parts]
        out: dict[bytes, bytes] = {}
        for at in range(0, len(letters), 500):
            out.update(self._letters(letters[at : at + 500]))
        for at in range(0, len(other), 500):
            out.update(self._each(other[at : at + 500]))
        get = lambda x: self.known[x] if x in self.known else out[x]
        out.update({w: get(s) + get(w[len(s) :]) for w, s in stems.items() if plain[s] and s != w})
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        split: list[list[bytes] | None] = []
        for text in texts:
            low = text.lower()
            split.append(low.split() if self.by_words and not any(m in low for m in self.marks) else None)
        known = self.known
        new = list(set().union(*(words for words in split if words)).difference(known))
        fresh = self._new(new) if new else {}
        if len(known) + len(fresh) <= MEMORY:
            known.update((w, i) for w, i in fresh.items() if len(w) <= LONG)
            fresh = {w: i for w, i in fresh.items() if len(w) > LONG}
        get = known.__getitem__ if not fresh else lambda w: known[w] if w in known else fresh[w]
        return [self._whole(text) if words is None else b"".join(map(get, words)) for text, words in zip(texts, split, strict=True)]


_tokenizers: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


def tokenize_pieces(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``max_length`` ids of each row: (id, piece, start, length, ids_crc32[, ids]).

    A row's ids are its whole text's, null as empty, and then ``end_id``; so every row has a piece.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    end = np.array([end_id], dtype="<u4").tobytes()
    kind = slim.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids

    def run(batches):
        words = _word_ids(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows, pieces, starts, lengths, sums, ids = [], [], [], [], [], []
                for row, data in enumerate(words.encode(part.column(1).to_pylist())):
                    data += end
                    for piece, i in enumerate(range(0, len(data), 4 * max_length)):
                        own = data[i : i + 4 * max_length]
                        rows.append(row)
                        pieces.append(piece)
                        starts.append(i // 4)
                        lengths.append(len(own) // 4)
                        sums.append(zlib.crc32(own))
                        if with_ids:
                            ids.append(own)
                out = [part.column(0).take(pa.array(rows)), pa.array(pieces, pa.int32())]
                out += [pa.array(x, pa.int64()) for x in (starts, lengths, sums)] + ([pa.array(ids, pa.binary())] if with_ids else [])
                yield pa.record_batch(out, names=["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return slim.mapInArrow(run, schema)


def pack_pieces(pieces: DataFrame, max_length: int = MAX_LENGTH, open_bins: int = OPEN_BINS, task_pieces: int = TASK_PIECES) -> DataFrame:
    """``pieces`` (stored; with id, piece and length from 1 to max_length) with sequence_id and offset."""
    count = pieces.count()
    tasks = max(1, -(-count // task_pieces))
    windows = max(1, -(-count // (tasks * WINDOW)))
    spread = F.xxhash64("id", "piece", "ids_crc32")
    ordered = (
        pieces.withColumn("_spread", spread)
        .repartition(tasks, "_spread")
        .withColumn("_window", F.pmod(F.shiftrightunsigned("_spread", 20), F.lit(windows)))
        .sortWithinPartitions("_window", F.desc("length"), "_spread", "start")
        .drop("_spread", "_window")
    )
    names = ordered.columns

    def run(batches):
        base = TaskContext.get().partitionId() << 40
        bins = BestFit(max_length, open_bins)
        where = names.index("length")
        for batch in batches:
            placed = [bins.place(n) for n in batch.column(where).to_pylist()]
            at = np.array(placed, dtype=np.int64).reshape(-1, 2)
            yield pa.record_batch([*batch.columns, pa.array(at[:, 0] + base), pa.array(at[:, 1])], names=[*names, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    return ordered.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_length: int = MAX_LENGTH, end_id: int = END_ID,
    open_bins: int = OPEN_BINS, with_ids: bool = False,
) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset[, ids]): where each piece goes.

    Every row of ``docs``, repeated ones and null ids or texts included, gives its own pieces, which
    fill sequences from offset 0 without gaps. ``path``: the tokenizer file, present on every
    executor; end_id follows each document. Other columns are ignored; no rows give no pieces.
    """
    folder = workspace(docs.sparkSession, "packing")
    pieces = stored(tokenize_pieces(docs, path, id_col, text_col, max_length, end_id, with_ids), f"{folder}/pieces")
    return pack_pieces(pieces, max_length, open_bins).withColumnRenamed("id", id_col)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids array<int>, lengths array<int>): the packed sequences of pieces with ids."""
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p"))

    def run(batches):
        for batch in batches:
            ids, lengths = [], []
            for row in batch.column(1).to_pylist():
                ids.append(np.frombuffer(b"".join(p["ids"] for p in row), "<u4").astype(np.int32))
                lengths.append([p["length"] for p in row])
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(lengths, pa.list_(pa.int32()))], names=["sequence_id", "ids", "lengths"])

    return rows.mapInArrow(run, "sequence_id long, ids array<int>, lengths array<int>")
