import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strandweave.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids(data: bytes):
    return np.frombuffer(data, "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text(st.sampled_from("aZé'st.,!1 \n\x85　İßḱ…<|>")))
def test_words_give_the_whole_texts_ids(text):
    got = packing.WordIds.encode(packing._word_ids(PATH), [text.encode("utf-8", "replace")])
    assert ids(got[0]) == PLAIN.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["", "Don't stop... NOW!!", "<|endoftext|> <|ENDOFTEXT|>", "áb " * 50, "x" * 5000, "$$$, a,%%% b$$$", "hello <|endoftext|> world", "<|startoftext|>a<|endoftext|>", "A<|EndOfText|> b"])
def test_plain_cases(text):
    assert ids(packing._word_ids(PATH).encode([text.encode()])[0]) == PLAIN.encode(text, add_special_tokens=False).ids


def test_best_fit_takes_least_space_and_closes_the_fullest():
    bins = packing.BestFit(10, 2)
    assert [bins.place(n) for n in (6, 3, 4)] == [(0, 0), (0, 6), (1, 0)]
    assert bins.place(6) == (1, 4)  # bin 1 is full and closed
    assert bins.place(8) == (2, 0)  # open: 0 with 1 free, 2 with 2 free
    assert bins.place(5) == (3, 0)  # bin 0, the fullest, closes
    assert bins.place(1) == (2, 8)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=200), st.integers(1, 20))
def test_best_fit_never_overlaps_or_leaves_gaps(lengths, limit):
    bins, used = packing.BestFit(50, limit), defaultdict(int)
    for n in lengths:
        b, at = bins.place(n)
        assert used[b] == at
        used[b] += n
    assert all(v <= 50 for v in used.values())


def test_pack_documents(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["cat", "dog", "unbelievable"]) for _ in range(rng.randrange(60))), "z") for i in range(300)]
    rows += [(None, None, "z"), (7, "cat", "z"), (7, "cat", "z"), (900, "long " * 500, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sequence_id string")
    out = packing.pack_documents(docs, PATH, max_length=64, with_ids=True).collect()
    by = defaultdict(list)
    for r in out:
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
        by[r.sequence_id].append(r)
    for pieces in by.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    long = sorted((r for r in out if r.doc_id == 900), key=lambda r: r.piece)
    assert [r.length for r in long[:-1]] == [64] * (len(long) - 1) and [r.start for r in long] == [64 * r.piece for r in long]
    assert sum((ids(bytes(r.ids)) for r in long), []) == [*PLAIN.encode("long " * 500, add_special_tokens=False).ids, 1]
    assert sum(r.doc_id == 7 for r in out) == 3 and [r.length for r in out if r.doc_id is None] == [1]
    assert len(by) <= 1.02 * sum(r.length for r in out) / 64 + 1
    packed = packing.pack_documents(docs, PATH, max_length=64, with_ids=True)
    assert sum(len(r.ids) for r in packing.sequences(packed).collect()) == sum(r.length for r in out)
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
