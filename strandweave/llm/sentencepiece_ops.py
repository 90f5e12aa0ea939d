"""SentencePiece encoding and decoding over a public piece vocabulary.

Encoding takes the best-scoring segmentation: an Aho-Corasick automaton over the pieces reads the
text once, and at each position its output links list every piece ending there; each relaxes the
best score of that position from the position where the piece starts. Where no piece crosses a word
boundary (checked on load) words are independent, so a word's ids are computed once and remembered.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
#: An unknown character scores this much below the worst piece.
UNKNOWN_PENALTY = 10.0
#: Words longer than LONG are not remembered; at most MEMORY words are.
LONG, MEMORY = 64, 400_000
#: Rows of one output batch, so that long texts don't add up.
ROWS = 256


def _normalizer(model: bytes) -> tuple[bytes, bool, bool]:
    """(charsmap, add_dummy_prefix, remove_extra_whitespaces) of a serialized model."""

    def fields(data: bytes):
        at = 0

        def number():
            nonlocal at
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value

        while at < len(data):
            key = number()
            if key & 7 == 0:
                yield key >> 3, number()
            elif key & 7 == 2:
                size = number()
                yield key >> 3, data[at : at + size]
                at += size
            else:
                size = {1: 8, 5: 4}[key & 7]
                yield key >> 3, data[at : at + size]
                at += size

    spec = dict(fields(next((v for k, v in fields(model) if k == 3), b"")))
    return spec.get(2, b""), bool(spec.get(3, 1)), bool(spec.get(4, 1))


class PieceModel:
    """Pieces, scores and normalisation of a model file; encodes and decodes single texts."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            charsmap, self.prefix, self.squeeze = _normalizer(f.read())
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        # a character map is compiled for the library, whose normaliser then does all of it
        self.mapped = sp.normalize if charsmap else None
        n = sp.vocab_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.unknown = sp.unk_id()
        self.bytes = {b: sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)} if any(sp.is_byte(i) for i in range(n)) else None
        self.floor = min(sp.get_score(i) for i in plain) - UNKNOWN_PENALTY
        self.automaton = ahocorasick.Automaton()
        pieces = []
        for i in plain:
            piece = sp.id_to_piece(i)
            pieces.append(piece)
            self.automaton.add_word(piece, (len(piece), sp.get_score(i), i))
        self.automaton.make_automaton()
        words = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        lines = not any("\n" in p for p in pieces if len(p) > 1)
        if words and lines:
            self.split = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+").findall
        elif words:
            self.split = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        else:
            self.split = lambda text: [text]
        self.known: dict[str, bytes] = _Known(self)
        surface = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                surface[i] = bytes([int(sp.id_to_piece(i)[3:-1], 16)])
            elif sp.is_unknown(i):
                surface[i] = " ⁇ ".encode()
            elif not sp.is_control(i):
                surface[i] = sp.id_to_piece(i).replace(SPACE, " ").encode()
        self.surface = surface

    def best(self, text: str) -> list[int]:
        """Ids of the best segmentation of one word (or text, where pieces cross words)."""
        n = len(text)
        score = [0.0] + [None] * n
        back: list[tuple[int, int] | None] = [None] * (n + 1)
        single = [False] * (n + 1)
        done = 0  # ends up to here are final

        def settle(upto):
            nonlocal done
            while done < upto:
                done += 1
                if not single[done]:
                    fall = score[done - 1] + self.floor
                    if score[done] is None or fall > score[done]:
                        score[done], back[done] = fall, (done - 1, -1)

        for end, (length, value, i) in self.automaton.iter(text):
            settle(end)
            end += 1
            total = score[end - length] + value
            single[end] |= length == 1
            if score[end] is None or total > score[end]:
                score[end], back[end] = total, (end - length, i)
        settle(n)
        out, at = [], n
        while at:
            start, i = back[at]
            if i >= 0:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in reversed(text[start:at].encode()))
            elif not (out and out[-1] == self.unknown):
                out.append(self.unknown)
            at = start
        return out[::-1]

    def normalize(self, text: str) -> str:
        if self.mapped is not None:
            return self.mapped(text)
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit numbers."""
        return b"".join(map(self.known.__getitem__, self.split(self.normalize(text))))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<u4").tolist()

    def decode(self, ids) -> str:
        data = b"".join(map(self.surface.__getitem__, ids))
        if (self.prefix or self.squeeze) and data.startswith(b" "):
            data = data[1:]
        return data.decode("utf-8", "replace")


class _Known(dict):
    def __init__(self, model: PieceModel):
        self.model = model

    def __missing__(self, word: str) -> bytes:
        ids = np.array(self.model.best(word), dtype="<u4").tobytes()
        if len(word) <= LONG and len(self) < MEMORY:
            self[word] = ids
        return ids


_models: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def _ids_array(parts: list[bytes | None]) -> pa.Array:
    """A list<int32> array from rows of id bytes; None gives null."""
    ends = np.cumsum([0, *(len(p or b"") // 4 for p in parts)], dtype=np.int32)
    values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(p or b"" for p in parts))])
    mask = pa.array([p is None for p in parts])
    return pa.ListArray.from_arrays(pa.array(ends), values, mask=mask)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids array<int>) of each row. A null text has null ids, an empty one no ids.

    ``path``: the model file, present on every executor. Other columns are ignored.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        m = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                rows = [None if x is None else m.encode_bytes(x) for x in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), _ids_array(rows)], names=["id", "ids"])

    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of each row of ids; null ids give a null text."""
    slim = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches):
        m = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                lists = part.column(1)
                texts = [m.decode(x.values.to_pylist()) if x.is_valid else None for x in lists]
                yield pa.record_batch([part.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    schema = T.StructType([T.StructField("id", slim.schema["id"].dataType), T.StructField("text", T.StringType())])
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def encode_and_verify(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids, n_ids, restored): the ids of each whole text and whether decoding gives it back.

    Null texts: null ids, n_ids and restored. A text with the space symbol itself isn't restored.
    """
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        m = model(path)
        surface = m.surface.__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                texts = part.column(1).to_pylist()
                rows = [None if x is None else m.encode_bytes(x) for x in texts]
                lead = b" " if m.prefix else b""
                back = [
                    None if r is None
                    else b"".join(map(surface, np.frombuffer(r, "<u4").tolist())) == ((lead + t.encode()) if t else b"")
                    for r, t in zip(rows, texts, strict=True)
                ]
                ids = _ids_array(rows)
                yield pa.record_batch(
                    [part.column(0), ids, pa.array([None if r is None else len(r) // 4 for r in rows], pa.int64()), pa.array(back, pa.bool_())],
                    names=["id", "ids", "n_ids", "restored"],
                )

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, ids array<int>, n_ids long, restored boolean").withColumnRenamed("id", id_col)
