"""Each stage of the corpus pipeline against a plain version on its own input."""

import re
import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from strandweave.llm.common import read_table
from strandweave.llm.quality import train_quality
from strandweave.llm.toxicity import train_toxicity

from .test_dedup import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_equal_plain_versions(spark, tmp_path):
    docs, labels = read_table(spark, SF, "documents"), read_table(spark, SF, "labels")
    columns = docs.columns
    inputs, out = [], docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        inputs.append(out)
        stage(spark, out, SF).write.parquet(str(tmp_path / str(i)))
        out = spark.read.parquet(str(tmp_path / str(i)))
        if i < 4:
            assert out.columns == columns
    after = [*inputs[1:], out]
    rows = lambda df: {r.doc_id: r.text or "" for r in df.collect()}

    fitted = train_quality(docs, labels)
    want = {i for i, t in rows(docs).items() if fitted.score([t.encode()])[0] >= 0.7}
    assert set(rows(after[0])) == want and 0.6 < len(want) / docs.count() < 1
    fitted = train_toxicity(inputs[1], labels)
    want = {i for i, t in rows(inputs[1]).items() if fitted is None or fitted.score([t.encode()])[0] < 0.3}
    assert set(rows(after[1])) == want

    first = {}
    for i, t in sorted(rows(inputs[2]).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), i)
    assert set(rows(after[2])) == set(first.values())

    prints = {i: brute_fingerprint(t) for i, t in rows(inputs[3]).items()}
    ids = sorted(prints)
    links = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = brute_components(ids, links)
    assert set(rows(after[3])) == {i for i in ids if roots[i] == i}

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts, pieces, bins = rows(inputs[4]), defaultdict(dict), defaultdict(list)
    for r in after[4].collect():
        pieces[r.doc_id][r.piece] = r
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, t in texts.items():
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 1], "<u4")
        cut = [ids[k : k + 4096] for k in range(0, len(ids), 4096)]
        assert [(pieces[i][k].start, pieces[i][k].length, pieces[i][k].ids_crc32) for k in range(len(cut))] == [(4096 * k, len(c), zlib.crc32(c.tobytes())) for k, c in enumerate(cut)]
    for spans in bins.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(n for s in bins.values() for _, n in s)
    assert len(bins) <= -(-total // 4096) + 1


def test_run_gives_the_last_stage(spark):
    assert set(corpus_pipeline.run(spark, SF).columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
