import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from strandweave.llm import simhash
from strandweave.llm.common import workspace
from strandweave.llm.components import connected_components
from strandweave.llm.exact_dedup import DigestIndex, dedup_documents, exact_dedup

DOCS = "doc_id long, text string, keep_id string"


def brute_components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_equal_union_find(spark):
    rng = random.Random(7)
    links = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] + [(i, i + 1) for i in range(200, 240)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {x for p in links if p[0] != p[1] for x in p}
    want = brute_components(nodes, [p for p in links if p[0] != p[1]])
    assert got == want


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_exact_dedup_edges(spark):
    rows = [
        (5, "a  b", "x"), (3, "a\t\nb", "y"), (9, "a b", "z"), (1, None, "n"), (2, "", "m"),
        (None, "only null", "q"), (3, "a\t\nb", "y"), (7, "x" * 300_000, None), (None, "a b", "w"),
    ]
    out = exact_dedup(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == len(rows)
    by = defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
    assert by[5][0].keep_id == 3 and not by[5][0].kept and by[5][0].group_size == 4
    assert [r.kept for r in by[3]] == [True, True]
    assert by[9][0].group_size == 1 and by[9][0].kept
    assert by[2][0].keep_id == 1 and by[1][0].group_size == 2
    assert by[7][0].text_sha256 == hashlib.sha256(b"x" * 300_000).hexdigest()
    assert sorted((r.keep_id, r.kept) for r in by[None] if r.group_size > 1) == [(3, False)]
    assert exact_dedup(spark.createDataFrame([], DOCS)).count() == 0


def test_index_outlives_a_batch_and_a_session(spark):
    folder = workspace(spark, "index-test")
    first = spark.createDataFrame([(10, "one"), (11, "two")], "doc_id long, text string")
    exact_dedup(first, DigestIndex(spark, folder, 4)).collect()
    index = DigestIndex(spark, folder, 4)
    spark.sql(f"DROP TABLE {index.table}")
    index = DigestIndex(spark, folder, 4)  # as a new session would open it
    assert index.entries().count() == 2
    out = exact_dedup(spark.createDataFrame([(1, "two"), (2, "three")], "doc_id long, text string"), index)
    assert {r.doc_id: (r.keep_id, r.kept) for r in out.collect()} == {1: (11, False), 2: (2, True)}
    assert index.entries().count() == 3


def test_anti_join_reads_the_index_without_moving_it(spark):
    index = DigestIndex(spark, workspace(spark, "index-plan"), 4)
    groups = spark.createDataFrame([(b"a", 1)], "digest binary, keep_id long")
    index.add(groups)
    plan = groups.repartition(4, "digest").join(index.entries().hint("merge"), "digest", "left_anti")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Bucketed: true" in text and text.count("Exchange") == 1


def test_dedup_documents_keeps_one_of_repeated_rows(spark, tmp_path):
    rows = [(2, "a", "en"), (1, "a ", "en"), (1, "a", "en"), (1, "a", "en"), (None, "b", "fr"), (4, "b", "fr")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    out = dedup_documents(docs)
    assert out.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert len(kept) == 3 and kept.count((4, "b")) == 1 and [k for k in kept if k[0] == 1]


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


TEXTS = ["", None, " \n", "One", "one two", "ONE TWO three Four", "É é ß", "a b c d", "w " * 70_000 + "end"]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_the_plain_definition(text):
    assert simhash.fingerprint(text) == brute_fingerprint(text)


def test_covering_masks_cover_every_pair_of_bits():
    for radius in (1, 2, 3):
        masks = simhash.covering_masks(radius, 24)
        from itertools import combinations

        for changed in combinations(range(24), radius):
            bits = sum(1 << i for i in changed)
            assert any(not m & bits for m in masks)


@pytest.mark.parametrize("limit", [simhash.BUCKET_LIMIT, 3])
def test_links_connect_what_all_pairs_connect(spark, limit):
    rng = random.Random(3)
    fps = []
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(25):
            fps.append(x)
            for b in rng.sample(range(64), rng.choice([0, 1, 2, 3])):
                x ^= 1 << b
    fps = sorted(set(fps))
    rows = [(simhash._signed(f), i) for i, f in enumerate(fps)]
    got = {r.node: r.component for r in connected_components(simhash.fingerprint_links(spark.createDataFrame(rows, "fp long, rep long"), 2, limit)).collect()}
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    want = brute_components(range(len(fps)), links)
    assert {i: got.get(i, i) for i in range(len(fps))} == want


def test_simhash_groups_edges(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(4, base, "f"), (8, base.upper(), "f"), (2, "", "f"), (3, None, "f"), (None, base, "f"), (4, base, "f"), (6, "alone here now", None)]
    out = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")).collect()
    assert len(out) == len(rows)
    got = {(r.doc_id, r.component_id) for r in out}
    assert got == {(4, 4), (8, 4), (2, 2), (3, 2), (None, None), (6, 6)}
    assert {r.fingerprint for r in out if r.doc_id in (2, 3)} == {"0" * 16}
    assert simhash.simhash_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_near_dedup_keeps_least_id(spark, tmp_path):
    base = " ".join(f"w{i}" for i in range(200))
    rows = [(9, base), (5, base.upper()), (5, base), (1, "other text of five words"), (None, base)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    out = simhash.near_dedup_documents(spark.read.parquet(str(tmp_path / "d"))).collect()
    assert sorted(r.doc_id for r in out) == [1, 5]


def test_forest_is_spanning():
    rng = np.random.default_rng(0)
    fps = rng.integers(0, 8, 40).astype(np.uint64) | (rng.integers(0, 4, 40).astype(np.uint64) << np.uint64(40))
    u, v = simhash._forest(fps, np.arange(40), 1)
    links = [(i, j) for i in range(40) for j in range(i) if (int(fps[i]) ^ int(fps[j])).bit_count() <= 1]
    assert brute_components(range(40), list(zip(u, v, strict=True))) == brute_components(range(40), links)


@pytest.mark.parametrize("stage", [dedup_documents, simhash.near_dedup_documents])
def test_rows_survive_other_splits_and_clashing_names(spark, tmp_path, stage):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnop") * 4 for _ in range(30)), i % 7, "p", "q") for i in range(3000)]
    rows += [(None, "same text " * 20, 1, "p", "q")] * 40 + [(i, rows[i - 5000][1], 0, "p", "q") for i in range(5000, 5300)]
    names = "doc_id long, text string, _place int, _row string, _copies string"
    spark.createDataFrame(rows, names).repartition(8).write.parquet(str(tmp_path / "d"))
    keys = ("spark.sql.files.minPartitionNum", "spark.sql.files.openCostInBytes")
    spark.conf.set(keys[0], "4")
    try:
        docs = spark.read.parquet(str(tmp_path / "d"))
        out = stage(docs)
        spark.conf.set(keys[0], "64")
        spark.conf.set(keys[1], "1")
        got = out.collect()
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert out.columns == docs.columns
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == list(range(3000))
    assert sum(r.doc_id is None for r in got) == 1 and all(r._place == r.doc_id % 7 for r in got if r.doc_id is not None)


@pytest.mark.parametrize("stage", [dedup_documents, simhash.near_dedup_documents])
def test_stages_on_nothing(spark, stage):
    assert stage(spark.createDataFrame([], "doc_id long, text string, id string")).collect() == []


@pytest.mark.parametrize("radius", [1, 3, 4])
def test_links_at_any_radius_and_bucket_size(spark, radius):
    rng = random.Random(radius)
    fps = set()
    for _ in range(4):
        x = rng.getrandbits(64)
        for _ in range(60):
            fps.add(x)
            x ^= sum(1 << b for b in rng.sample(range(24), rng.choice([1, radius, radius + 1])))
    fps = sorted(fps)
    rows = [(simhash._signed(f), i) for i, f in enumerate(fps)]
    got = {r.node: r.component for r in connected_components(simhash.fingerprint_links(spark.createDataFrame(rows, "fp long, rep long"), radius, 5)).collect()}
    links = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= radius]
    assert {i: got.get(i, i) for i in range(len(fps))} == brute_components(range(len(fps)), links)
