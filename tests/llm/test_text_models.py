import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strandweave.llm import quality, toxicity
from strandweave.llm import sentencepiece_ops as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")


def as_unigram(path: str) -> sentencepiece.SentencePieceProcessor:
    """The same pieces and scores as a unigram model, whose Viterbi search the library does itself."""
    data = open(path, "rb").read()
    at, out = 0, b""

    def number(i):
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value, i

    while at < len(data):
        start = at
        key, at = number(at)
        assert key & 7 == 2
        size, at = number(at)
        body = data[at : at + size]
        at += size
        if key >> 3 == 2:  # the trainer's settings: a later field wins, so type 1 (unigram) is added
            body += b"\x18\x01"
            out += bytes([key])
            n = len(body)
            while n > 127:
                out += bytes([n & 127 | 128])
                n >>= 7
            out += bytes([n]) + body
        else:
            out += data[start:at]
    return sentencepiece.SentencePieceProcessor(model_proto=out)


UNIGRAM = as_unigram(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80) | st.text(st.sampled_from("thea n\nßé▁, "), max_size=60))
def test_encoding_is_the_librarys_best_path_and_decoding_its_own(text):
    text = text.encode("utf-8", "replace").decode()
    m = sp.model(PATH)
    ids = m.encode(text)
    assert ids == UNIGRAM.encode(text)
    assert m.decode(ids) == LIBRARY.decode(ids)
    if sp.SPACE not in text:
        assert m.decode(ids) == text


def test_normaliser_of_models_with_a_character_map(monkeypatch):
    m = sp.PieceModel(PATH)
    m.mapped = LIBRARY.normalize
    for text in ("the  quick", " x ", "", "\x00a\tb\n"):
        assert m.normalize(text) == sp.model(PATH).normalize(text)


def test_words_alone_give_the_whole_texts_path():
    m = sp.model(PATH)
    text = "the  quick\n\n brown fox, Ünïcödé 漢字 " * 20
    assert m.encode(text) == m.best(m.normalize(text))


def test_encode_edges(spark):
    rows = [(1, "the cat", "x"), (1, "the cat", "x"), (2, None, None), (None, "", ""), (3, "long " * 60_000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sp.encode_and_verify(docs, PATH).collect()
    assert len(out) == 5 and [r.restored for r in out] == [True, True, None, True, True]
    assert [r.n_ids for r in out][2:4] == [None, 0] and out[0].ids == out[1].ids
    back = {r.doc_id: r.text for r in sp.decode_ids(sp.encode_texts(docs, PATH), PATH).collect()}
    assert back[1] == "the cat" and back[2] is None and back[None] == "" and back[3] == "long " * 60_000
    assert sp.encode_and_verify(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


WORDS = [a + b for a in "ka lo mi su te ra no vi".split() for b in "ren dal tor mis pon ged fur".split()]


def prose(rng, n=120):
    return ". ".join(" ".join(rng.choice(WORDS) for _ in range(8)).capitalize() for _ in range(n // 8)) + "."


def corpus(spark, kind, n=500):
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(n):
        text, bad = prose(rng), rng.random() < 0.25
        if kind == "quality" and bad:
            text = " ".join(w + rng.choice(["$$$", "%%%", "###"]) for w in text.split())
        if kind == "toxic" and bad:
            words = text.split()
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["grumbol", "snarfed", "vilex" + rng.choice(WORDS)])
            text = " ".join(words)
        docs.append((i, text))
        if rng.random() < 0.6:
            labels.append((i, int(not bad) if kind == "quality" else int(bad)))
    names = "quality" if kind == "quality" else "toxic"
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, f"doc_id long, {names} int"), {i: y for i, y in labels}


def held_out_accuracy(rows, truth):
    pairs = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    return sum(a == b for a, b in pairs) / len(pairs)


EDGES = [(None, "some text", "s"), (9_000, None, "s"), (9_001, "", "s"), (9_002, "w " * 100_000, "s"), (9_003, "kadal", "s"), (9_003, "kadal", "s")]


def test_quality(spark):
    docs, labels, truth = corpus(spark, "quality")
    fitted = quality.train_quality(docs, labels)
    assert 0.6 < fitted.prior < 0.9
    rows = quality.score_quality(docs, fitted).collect()
    assert held_out_accuracy(rows, truth) > 0.95
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    # labels of held-out rows, and negative ones, change nothing
    other = labels.selectExpr("doc_id", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 1 - quality else quality end as quality").where("quality = 1 or crc32(cast(cast(doc_id as string) as binary)) % 4 = 2")
    again = quality.train_quality(docs, other)
    assert np.allclose(again.weights, fitted.weights)
    edge = quality.score_quality(spark.createDataFrame(EDGES, "doc_id long, text string, score string"), fitted).collect()
    assert len(edge) == 6 and all(0 <= r.score <= 1 for r in edge)
    assert {r.doc_id: r.predicted for r in edge}[9_001] == 1 and edge[0].held_out
    assert quality.train_quality(docs, labels.where("quality = 5")) is None
    assert [r.score for r in quality.score_quality(docs.limit(1), None).collect()] == [0.5]
    assert quality.score_quality(docs.limit(0), fitted).count() == 0


def test_quality_features_of_whole_texts():
    assert quality.features(b"")[-1] == 0
    a, b = quality.features(b"abc " * 5000 + b"$$$ " * 5000), quality.features(b"abc " * 5000)
    assert np.abs(a - b).max() > 0.1


def brute_marginals(emit, trans):
    from itertools import product

    n = len(emit)
    total, single, pair = 0.0, np.zeros(n), np.zeros(4)
    for path in product((0, 1), repeat=n):
        w = np.exp(sum(e for e, s in zip(emit, path, strict=True) if s) + sum(trans[a, b] for a, b in zip(path, path[1:], strict=False)))
        total += w
        single += w * np.array(path)
        for a, b in zip(path, path[1:], strict=False):
            pair[2 * a + b] += w
    return single / total, pair / total


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    sizes = [5, 1, 8, 3]
    emit, trans = rng.normal(size=sum(sizes)) * 2, rng.normal(size=(2, 2))
    begins = np.cumsum([0, *sizes])[:-1]
    p, steps = toxicity.marginals(emit, begins, trans, True)
    want, total = [], np.zeros(4)
    for b, n in zip(begins, sizes, strict=True):
        single, pair = brute_marginals(emit[b : b + n], trans)
        want.append(single)
        total += pair
    assert np.allclose(p, np.concatenate(want)) and np.allclose(steps, total)


def test_toxicity(spark):
    docs, labels, truth = corpus(spark, "toxic")
    fitted = toxicity.train_toxicity(docs, labels)
    rows = toxicity.score_toxicity(docs, fitted).collect()
    assert held_out_accuracy(rows, truth) > 0.95
    text = dict(docs.collect())
    flagged = [r for r in rows if r.predicted]
    said = {text[r.doc_id][s.start : s.end].strip(".,").lower() for r in flagged for s in r.spans}
    assert {"grumbol", "snarfed"} <= said and all(any(w.startswith(("grumbol", "snarfed", "vilex")) for w in x.split()) for x in said)
    edge = toxicity.score_toxicity(spark.createDataFrame(EDGES, "doc_id long, text string, spans string"), fitted).collect()
    assert len(edge) == 6 and {r.doc_id: r.score for r in edge}[9_001] == 0.0 and {r.doc_id: r.score for r in edge}[9_000] == 0.0
    late = "kadal. " * 40_000 + "grumbol snarfed grumbol grumbol"
    assert toxicity.score_toxicity(spark.createDataFrame([(1, late)], "doc_id long, text string"), fitted).first().spans[0].start == 280_000
    assert toxicity.train_toxicity(docs, labels.where("toxic = 0")) is None
    assert toxicity.score_toxicity(docs.limit(0), fitted).count() == 0


@pytest.mark.parametrize("sizes", [[1], [7], [8], [9], [3, 25, 1, 40, 8, 17], [100]])
def test_long_chains_are_not_cut(monkeypatch, sizes):
    rng = np.random.default_rng(1)
    emit, trans = rng.normal(size=sum(sizes)) * 2, rng.normal(size=(2, 2)) * 2
    begins = np.cumsum([0, *sizes])[:-1]
    whole, steps = toxicity.marginals(emit, begins, trans, True)
    monkeypatch.setattr(toxicity, "CHUNK", 8)
    got, got_steps = toxicity.marginals(emit, begins, trans, True)
    assert np.allclose(got, whole) and np.allclose(got_steps, steps)
    assert toxicity.chains(np.zeros(1000, bool), np.array([0])).tolist() == [0]


def test_chain_tells_what_its_emissions_alone_do_not():
    # a token of its own doubtful is toxic between toxic ones and harmless between harmless ones
    trans = np.array([[2.0, -2.0], [-2.0, 2.0]])
    emit = np.array([4.0, 0.0, 4.0, -4.0, 0.0, -4.0])
    begins = np.array([0, 3])
    chained, alone = toxicity.marginals(emit, begins, trans)[0], toxicity.marginals(emit, begins, np.zeros((2, 2)))[0]
    assert chained[1] > 0.99 and chained[4] < 0.01 and np.allclose(alone[[1, 4]], 0.5)


@pytest.mark.parametrize("keep", [lambda d, y: quality.keep_quality(d, y), lambda d, y: toxicity.drop_toxic(d, y)])
def test_filters_keep_columns_and_take_edges(spark, keep):
    docs, labels, _ = corpus(spark, "toxic")
    labels = labels.withColumn("quality", labels.toxic)
    rows = [(i, "kadal ren lo. " * 30, i, "a") for i in range(3)] * 2 + [(9, None, 1, "a"), (10, "", 1, "a"), (None, "x", 1, None), (11, "long " * 100_000, 1, "a")]
    rows += [(r.doc_id, r.text, 0, "b") for r in docs.collect()]
    table = spark.createDataFrame(rows, "doc_id long, text string, score int, held_out string")
    out = keep(table, labels).collect()
    assert out and set(out[0].asDict()) == set(table.columns) and {tuple(r) for r in out} <= set(rows)
    assert all(sum(r.doc_id == i and r.held_out == "a" for r in out) in (0, 2) for i in range(3))
    assert keep(table.limit(0), labels).count() == 0 and keep(table, labels.limit(0)).count() == len(rows)
