"""Operators 11 to 13 against brute force."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandweave.llm import periodic_runs as runs
from strandweave.llm import queries
from strandweave.llm.common import read_table
from strandweave.llm.merkle import merkle_manifest
from strandweave.llm.substring_dedup import substring_dedup

SF = "/root/testdata/sf0.001"
LONG_TEXT = " ".join(["x"] * 30_000)


def words_of(text):
    return (text or "").encode().split()


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# substring de-duplication ------------------------------------------------------------------------


def brute_substrings(rows, least):
    """(id, words, words removed, text kept) of (id, text) rows."""
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, text in rows:
        w = words_of(text)
        for k in range(len(w) - least + 1):
            window = tuple(w[k : k + least])
            first[window] = min(first.get(window, key(i)), key(i))
    out = []
    for i, text in rows:
        w = words_of(text)
        gone = [False] * len(w)
        for k in range(len(w) - least + 1):
            if first[tuple(w[k : k + least])] < key(i):
                gone[k : k + least] = [True] * least
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def removed(df, *args, **more):
    got = substring_dedup(df, *args, **more).collect()
    for r in got:
        assert sum(s.length for s in r.spans) == r.n_removed and all(a.start + a.length < b.start for a, b in zip(r.spans, r.spans[1:], strict=False))
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed, r.kept) for r in got)


def wanted(rows, least):
    return sorted((i is None, i or 0, *rest) for i, *rest in brute_substrings(rows, least))


@pytest.mark.parametrize(("least", "most"), [(50, 256), (50, 3), (3, 2)])
def test_substrings_equal_brute_force(spark, least, most):
    rnd = random.Random(least * 1000 + most)
    pool = [[rnd.choice("abcdefghijkl"[: rnd.choice([1, 2, 12])]) for _ in range(rnd.randrange(1, 3 * least))] for _ in range(12)]
    rows = []
    for i in range(90):
        words = []
        for _ in range(rnd.randrange(6)):
            words += rnd.choice(pool) if rnd.random() < 0.6 else [f"{rnd.choice('mnopq')}{rnd.randrange(9)}" for _ in range(rnd.randrange(2 * least))]
        rows.append((rnd.choice([i, i, i, None, 7, -3]), rnd.choice([" ", "\t", "  \n", "\x0b\x0c"]).join(words) if rnd.random() < 0.95 else None))
    rows += rows[:5] + [(500, ""), (501, " "), (502, "\u00a0".join("abc")), (503, None)]
    df = spark.createDataFrame([(i, t, "c", "p") for i, t in rows], "doc_id long, text string, d string, place string").repartition(3)
    assert removed(df, least, most=most) == wanted(rows, least)


def test_substrings_of_documents_equal_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    got = removed(docs)
    assert got == wanted([(r.doc_id, r.text) for r in docs.collect()], 50) and sum(r[3] for r in got) > 1000


def test_substrings_of_one_frequent_passage(spark):
    """A passage in a third of all documents between texts of their own: its prefix is lengthened."""
    passage = " ".join(f"p{k}" for k in range(70))
    rows = [(i, f"a{i} " * 5 + (passage if i % 3 == 0 else f"u{i} " * 70) + f" z{i}" * 60) for i in range(300)]
    got = removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), most=8)
    assert got == wanted(rows, 50)
    assert sum(r[3] for r in got) == 99 * 70 + 0


def test_substrings_of_long_and_no_texts(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup(none).collect() == []
    rows = [(2, LONG_TEXT), (1, LONG_TEXT + " y"), (3, "x " * 49), (4, "x " * 50)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2] == (30_000, 30_000, "") and got[1][1] == 0 and got[3] == (49, 0, " ".join("x" * 49)) and got[4] == (50, 50, "")


# runs ----------------------------------------------------------------------------------------------


def brute_runs(w, ratio=4, least=6):
    n, out = len(w), []
    for q in range(1, n // ratio + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, ratio * q) and not any(all(w[i + k] == w[i + k + r] for k in range(size - r)) for r in range(1, q)):
                out.append((i, size, q))
            i = max(j, i) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(w, found):
    gone = {i for start, size, q in found for i in range(start + q, start + size)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def random_words(rnd):
    letters, n = "abcd"[: rnd.choice([1, 2, 2, 3, 4])], rnd.choice([0, 1, 3, 7, 12, 30, 60, 120])
    w = [rnd.choice(letters) for _ in range(n)]
    if rnd.random() < 0.5 and n > 8:
        a, p = rnd.randrange(n), 1 + rnd.randrange(6)
        for i in range(a + p, n):
            w[i] = w[i - p]
    return w


@pytest.mark.parametrize(("ratio", "least"), [(4, 6), (3, 3), (5, 2)])
def test_runs_equal_brute_force(spark, ratio, least):
    rnd = random.Random(ratio)
    many = [random_words(rnd) for _ in range(400)]
    rows = [(i if i % 7 else None, "  ".join(w) if w else rnd.choice([None, "", "\t"]), "x") for i, w in enumerate(many)]
    df = spark.createDataFrame(rows + rows[:3], "doc_id long, text string, runs string").repartition(4)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(df, ratio=ratio, least=least).collect())
    all_rows = [(row[0], w) for row, w in zip(rows + rows[:3], many + many[:3], strict=True)]
    want = sorted((i is None, i or 0, len(w), f := brute_runs(w, ratio, least), collapsed(w, f)) for i, w in all_rows)
    assert got == want and sum(len(r[3]) for r in want) > 100


def test_run_kernels_equal_brute_force():
    rnd = np.random.default_rng(5)
    for _ in range(60):
        values = rnd.integers(0, 9, rnd.integers(1, 80))
        n = len(values)
        assert runs.next_smaller(values).tolist() == [next((j for j in range(i + 1, n) if values[j] < values[i]), n) for i in range(n)]
        low = runs.RangeMin(values)
        a, b = np.sort(rnd.integers(0, n, (2, 50)), axis=0)
        assert low(a, b).tolist() == [values[x : y + 1].min() for x, y in zip(a, b, strict=True)]
        words = rnd.integers(0, 2, n)
        rank = runs.inverse_suffix_array(words, np.zeros(n, np.int64), np.full(n, n))
        order = sorted(range(n), key=lambda i: words[i:].tolist())
        assert [order.index(i) for i in range(n)] == rank.tolist()


def test_runs_of_long_and_no_texts(spark):
    assert runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = [(1, LONG_TEXT), (2, " ".join(f"w{k % 5000}" for k in range(20_001))), (3, "\x1c \u00a0 " * 9)]
    got = {r.doc_id: ([tuple(x) for x in r.runs], r.collapsed) for r in runs.periodic_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == ([(0, 30_000, 1)], "x") and got[2] == ([(0, 20_001, 5000)], " ".join(f"w{k}" for k in range(5000)))
    assert got[3] == ([(0, 18, 2)], "\x1c \u00a0")
    with pytest.raises(ValueError):
        runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string"), ratio=2)


def test_run_query_equals_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    want = set()
    for r in docs.collect():
        w = [x.decode() for x in words_of(r.text)]
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n < 1500:
            found = brute_runs(w)
            best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None,) * 3
            lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
            want.add((r.doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(lines), sha(collapsed(w, found))))
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = queries.op12_periodic_runs(spark, SF)
    assert got.columns == list(columns) and {t for c, t in got.dtypes[:6]} == {"bigint"}
    got = {tuple(r) for r in got.collect()}
    assert want <= got and len(got) == docs.count() and any(r[1] for r in want) and len(want) > 0.9 * len(got)


# Merkle manifest ----------------------------------------------------------------------------------


def brute_manifest(rows):
    def part(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha(*map(part, (r[0], r[1], r[2], r[3], text)))

    def tree(nodes):
        levels = [nodes]
        while len(nodes) > 1:
            nodes = [sha(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
            levels.append(nodes)
        return levels

    def siblings(levels, i):
        out = []
        for nodes in levels[:-1]:
            first = i // 16 * 16
            out.append((nodes[first:i], nodes[i + 1 : first + 16]))
            i //= 16
        return out

    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    trees = {s: tree([leaf(r, r[4]) for r in by[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, r in enumerate(by[s]):
            path, text = siblings(trees[s], i) + siblings(top, k), r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            found = leaf(r, text)
            for a, b in path:
                found = sha(*a, found, *b)
            out.append((r[0], leaf(r, r[4]), trees[s][-1][0], top[-1][0], sha(*("".join(a + b) for a, b in path)), found, found == top[-1][0]))
    return sorted(map(repr, out))


def manifest(df):
    return sorted(repr(tuple(r)) for r in merkle_manifest(df, tampered=F.crc32(F.col("doc_id").cast("string")) % 5 == 0).collect())


MANIFEST = "doc_id long, source string, lang string, n_chars long, text string, tree string, row string, root string"


def test_manifest_equals_brute_force(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(700):
        source = rnd.choice([None, "hot", "hot", "hot", "", "r", "s", "\u00e9", *(f"g{k}" for k in range(40))])
        text = rnd.choice([None, "", "Ab " * rnd.randrange(5), "\u00c4A" * 3, "plain"])
        rows.append((rnd.choice([i, i, i, None, 5]), source, rnd.choice([None, "de"]), rnd.choice([None, i]), text, "t", "w", "o"))
    rows += rows[:20]
    got = manifest(spark.createDataFrame(rows, MANIFEST).repartition(4))
    assert got == brute_manifest(rows) and any("True" in r for r in got) and any("False" in r for r in got)


@pytest.mark.parametrize("n", [0, 1, 257])
def test_manifest_of_few_rows(spark, n):
    rows = [(i, "one", None, 3, "A b", "", "", "") for i in range(n)]
    assert manifest(spark.createDataFrame(rows, MANIFEST)) == brute_manifest(rows)
    rows = [(i, f"s{i}", None, 3, "A b", "", "", "") for i in range(n)]
    assert manifest(spark.createDataFrame(rows, MANIFEST)) == brute_manifest(rows)


@pytest.mark.parametrize("name", ["op11_substring_dedup", "op13_merkle_manifest"])
def test_sql_gives_the_same_rows(spark, name):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS FROM read_parquet('{SF}/documents.parquet')")
    want = db.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_words_are_parted_at_ascii_white_space_only():
    from strandweave.llm.words import split_words

    flat, offsets = split_words(pa.array(["zero", " a\tb\nc\x0bd\x0ce\rf ", None, "", "\x1c\x1f\u00a0\u2003 g", "\t"]).slice(1))
    assert flat.to_pylist() == ["a", "b", "c", "d", "e", "f", "\x1c\x1f\u00a0\u2003", "g"] and offsets.tolist() == [0, 6, 6, 6, 8, 8]
