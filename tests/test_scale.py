"""Clusters by leaders, the seed index, merged insertions and interval look-ups against plain versions."""

import dataclasses
import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandweave.operators import align, cluster, conserve, contrast, inclusivity, insertions, match, ranges, seed_index
from strandweave.plans.config import ConservationConfig, InclusivityConfig, SpecificityConfig
from strandweave.plans.storage import shared_folder

COMPLEMENT = str.maketrans("ACGT", "TGCA")


def mutated(rnd, text, n, letters="ACGT"):
    out = list(text)
    for _ in range(n):
        i = rnd.randrange(len(out))
        out[i] = rnd.choice([rnd.choice(letters), "", out[i] + rnd.choice(letters)])
    return "".join(out)


# clusters -----------------------------------------------------------------------------------------


def one_pass(rows, least):
    """(leader, identity) of each id in one pass in order, longest first; None of leaders."""
    order = sorted(rows, key=lambda r: (-len(r[2]), r[0]))
    leaders, home = [], {}
    for _, name, s in order:
        near = [(-cluster.identity(s, t), k) for k, (_, t) in enumerate(leaders)]
        near = [x for x in near if -x[0] >= least]
        home[name] = (leaders[min(near)[1]][0], -min(near)[0]) if near else (name, None)
        leaders += [] if near else [(name, s)]
    return home


def families(rnd, n, size, length):
    out = []
    for _ in range(n):
        base = "".join(rnd.choice("ACGT") for _ in range(length + rnd.randrange(30)))
        out += [mutated(rnd, base, rnd.randrange(length // 4), "ACGTN") for _ in range(size)]
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize(("least", "letters", "rows"), [(0.9, 250_000, 1_000), (0.8, 700, 1_000), (0.95, 250_000, 7), (1.0, 250_000, 1_000)])
def test_clusters_and_their_members_equal_one_pass(spark, monkeypatch, least, letters, rows):
    monkeypatch.setattr(cluster, "ROUND_LETTERS", letters)
    monkeypatch.setattr(cluster, "ROUND_ROWS", rows)
    rnd = random.Random(int(100 * least))
    seqs = families(rnd, 6, 12, 60) + ["", "A", "A" * 70, "ACGT" * 20]
    table = [(i, f"s{i}", s) for i, s in enumerate(seqs)]
    got = cluster.clusters(spark.createDataFrame(table, "ordinal long, sequence_id string, sequence string").repartition(3), least).collect()
    assert {r.sequence_id: (r.representative_id, r.identity) for r in got} == one_pass(table, least) and len(got) == len(table)
    first = {}
    for r in got:
        first[r.cluster_id] = min(first.get(r.cluster_id, r.ordinal), r.ordinal)
    assert [c for c, _ in sorted(first.items(), key=lambda x: x[1])] == [f"cluster-{k:05d}" for k in range(len(first))]


def test_scattered_insertions_lose_no_pair(spark):
    rnd = random.Random(9)
    table = []
    for k in range(200):
        s = "".join(rnd.choice("ACGT") for _ in range(100))
        longer = "".join(s[i : i + 4] + rnd.choice("ACGT") for i in range(0, 100, 4))
        table += [(2 * k, f"long{k}", longer), (2 * k + 1, f"short{k}", s)]
    got = cluster.clusters(spark.createDataFrame(table, "ordinal long, sequence_id string, sequence string"), 0.9).collect()
    assert sum(r.sequence_id.startswith("short") and r.representative_id == "long" + r.sequence_id[5:] and r.identity == 1.0 for r in got) == 200


def test_side_by_side_gives_identities():
    rnd = random.Random(4)
    seqs = families(rnd, 3, 10, 40) + ["", "A"]
    packed = cluster.SideBySide(seqs)
    for longer in ("", "ACGT", "".join(rnd.choice("ACGTN") for _ in range(90))):
        assert packed.identities(longer).tolist() == [cluster.identity(s, longer) for s in seqs]


def test_many_short_sequences_are_compared_in_words():
    rnd = random.Random(12)
    base = "".join(rnd.choice("ACGT") for _ in range(240))
    seqs = ["".join(rnd.choice("ACGTN") if rnd.random() < 0.1 else c for c in base)[: rnd.choice([62, 63, 64, 126, 127, 189, 240])] for _ in range(cluster.MANY)] + ["", "A" * 252]
    packed = cluster.SideBySide(seqs)
    assert packed.short and not cluster.SideBySide(seqs[:5]).short and not cluster.SideBySide([*seqs, "A" * 505]).short
    for longer in ("", "ACGT", base, base[::-1], base * 3, "é" + base, "A" * 300):
        assert packed.identities(longer).tolist() == [cluster.identity(s, longer) for s in seqs]


# seed index ---------------------------------------------------------------------------------------


def panel(rnd, seqs):
    out = []
    for i in range(40):
        s, k = rnd.choice(seqs), rnd.choice([15, 17, 18, 20, 22, 25, 30, 70])
        at = rnd.choice([0, len(s) - k, seed_index.PART - k // 2, seed_index.PART - 1]) if i % 5 == 0 else rnd.randrange(len(s) - k + 1)
        at = max(0, min(at, len(s) - k))
        o = s[at : at + k]
        o = o.translate(COMPLEMENT)[::-1] if rnd.random() < 0.5 else o
        for _ in range(rnd.randrange(3)):
            j = rnd.randrange(k)
            o = o[:j] + rnd.choice("ACGTRYNSW") + o[j + 1 :]
        out.append((f"a{i}", rnd.choice(match.ROLES), o))
    return [*out, ("n", "PROBE", "N" * 22), ("aa", "FORWARD", "A" * 20)]


@pytest.mark.parametrize("changed", [{}, {"reject_primer_3_prime_mismatch": False}, {"max_primer_mismatches": 0, "max_probe_mismatches": 0}, {"max_primer_mismatches": 4}])
def test_index_gives_what_the_scan_gives(spark, changed):
    config = dataclasses.replace(SpecificityConfig(), **changed)
    rnd = random.Random(4)
    seqs = ["".join(rnd.choice("ACGT") for _ in range(n)) for n in (300, 2000, 40_000, 17_000, 100)]
    oligos = panel(rnd, seqs)
    seqs += [mutated(rnd, s, len(s) // 50, "ACGTRYN") for s in seqs] + ["ACG", "N" * 300 + "A" * 40 + "N" * 9 + "ACGTTGCA" * 5]
    df = spark.createDataFrame([(i, f"s{i}", s) for i, s in enumerate(seqs)], "ordinal long, sequence_id string, sequence string").repartition(3)
    table = spark.createDataFrame(oligos, "assay_id string, role string, sequence string")
    want = sorted(map(repr, map(tuple, match.scan_compatible(df, [match.Oligo(*o) for o in oligos], config, ["ordinal", "sequence_id"]).collect())))
    got = sorted(map(repr, map(tuple, seed_index.search_once(df, table, config, ["ordinal", "sequence_id"]).collect())))
    assert got == want and len(want) > 20


@pytest.mark.parametrize("changed", [{}, {"reject_primer_3_prime_mismatch": False}, {"max_primer_mismatches": 0, "max_probe_mismatches": 0}])
def test_blocks_and_packs_give_what_the_scan_gives(spark, monkeypatch, changed):
    for name, value in (("CROWD", -1), ("BLOCK", 3_000), ("PACK", 60)):
        monkeypatch.setattr(seed_index, name, value)
    test_index_gives_what_the_scan_gives(spark, changed)


def test_sites_of_a_family_are_not_listed(spark):
    """Oligos of a family's members are in most of its members: a list of the sites, or of the hits, is its square."""
    rnd = random.Random(8)
    base = "".join(rnd.choice("ACGT") for _ in range(200))
    seqs = [mutated(rnd, base, 4, "ACGT") for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(seqs)), "ordinal long, sequence string")
    oligos = [(f"a{i}", "FORWARD", s[50:70]) for i, s in enumerate(seqs)]
    found = seed_index.search_once(df, spark.createDataFrame(oligos, "assay_id string, role string, sequence string"), SpecificityConfig(), ["ordinal"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan
    want = match.scan_compatible(df, [match.Oligo(*o) for o in oligos], SpecificityConfig(), ["ordinal"]).collect()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, want))) and len(want) > 1000


def test_equal_oligos_and_sites_are_compared_once(monkeypatch):
    """A task gives lists of assays and sites, short enough that no row stands for many hits."""
    for name, value in (("ALIKE", 5), ("EXPANDED", 20), ("SENT", 16), ("CHECKED", 50)):
        monkeypatch.setattr(seed_index, name, value)
    config, rnd = SpecificityConfig(), random.Random(3)
    base = "".join(rnd.choice("ACGT") for _ in range(90))
    kinds = [base, base[:33] + "N" + base[34:], base.translate(COMPLEMENT)[::-1], mutated(rnd, base, 5, "ACGTRN")]
    seqs = [kinds[i % 4] for i in range(60)] + ["ACG", base[:25], base[30:] * 3]
    texts = [(role, s[at : at + k]) for role, at, k in (("FORWARD", 20, 20), ("PROBE", 30, 22), ("PROBE", 8, 40), ("REVERSE", 50, 20)) for s in dict.fromkeys(kinds[:2] + kinds[3:])]
    texts = [(r, t.translate(str.maketrans("ACGTRN", "TGCAYN"))[::-1] if r == "REVERSE" else t) for r, t in texts]
    pack = []
    for n, (role, text) in enumerate(texts):
        seeds = [{"key": int(key), "flipped": flipped, "first": first} for keys, flipped, first in seed_index.oligo_seeds(match.Oligo("", role, text), config) for key in keys]
        pack.append({"role": role, "sequence": text, "seeds": seeds, "assays": [f"a{n}-{i}" for i in range(1 + n % 5)]})
    parts = [{"ordinal": i, "spot": (i + 1) << 24, "length": len(s), "letters": s} for i, s in enumerate(seqs)]
    rows = pa.Table.from_pylist([{"oligos": pack, "parts": None}, {"oligos": None, "parts": parts}])
    sent = [r for batch in seed_index._block_checker(config, ["ordinal"])(iter(rows.combine_chunks().to_batches())) for r in batch.to_pylist()]
    got = [
        (s["ordinal"], a, r["role"], r["orientation"], s["oriented_start"], s["source_start"], r["_last"], tuple(h["mismatch_positions"]), h["mismatch_count"], h["three_prime_mismatch"])
        for r in sent for a in r["_assays"] for h in r["_hits"] for s in h["_sites"]
    ]
    want = []
    for (role, text), own in zip(texts, pack, strict=True):
        pattern, k = match.Oligo("", role, text).pattern, len(text)
        cap, protected = (1, 0) if role == "PROBE" else (2, 5)
        for i, s in enumerate(seqs):
            for flip, way in enumerate(match.ORIENTATIONS):
                target = match.reverse_masks(match.to_masks(s)) if flip else match.to_masks(s)
                starts = match.compatible_starts(target, pattern, role, cap, protected)
                for at, bad in zip(starts.tolist(), match.mismatch_rows(target, starts, pattern, role), strict=True):
                    places = tuple((np.flatnonzero(bad) + 1).tolist())
                    tail = role != "PROBE" and any(p > k - 5 for p in places)
                    want += [(i, a, role, way, at + 1, (len(s) - at - k if flip else at) + 1, k - 1, places, len(places), tail) for a in own["assays"]]
    assert sorted(got) == sorted(want) and len(want) > 1000 and len(sent) < len(want) / 3
    assert max(len(r["_assays"]) * sum(len(h["_sites"]) for h in r["_hits"]) for r in sent) <= 20 + 5 * 5


def test_a_crowded_search_writes_no_seeds(spark, monkeypatch):
    monkeypatch.setattr(seed_index, "ASSAYS", 50)
    monkeypatch.setattr(seed_index, "ALIKE", 20)
    monkeypatch.setattr(seed_index.SeedIndex, "_add_seeds", lambda *_: pytest.fail("seeds are written"))
    rnd = random.Random(10)
    base = "".join(rnd.choice("ACGT") for _ in range(200))
    kinds = [mutated(rnd, base, 4, "ACGT") for _ in range(4)]
    seqs = [kinds[i % 4] for i in range(200)]
    df = spark.createDataFrame(list(enumerate(seqs)), "ordinal long, sequence string")
    oligos = [(f"a{i}", role, s[50:72]) for i, s in enumerate(seqs) for role in match.ROLES]
    found = seed_index.search_once(df, spark.createDataFrame(oligos, "assay_id string, role string, sequence string"), SpecificityConfig(), ["ordinal"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "explode(_assays" in plan and "inline(_sites" in plan
    want = match.scan_compatible(df, [match.Oligo(*o) for o in oligos], SpecificityConfig(), ["ordinal"]).collect()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, want))) and len(want) > 20_000


@pytest.mark.parametrize("crowd", [-1, 10**9])
def test_words_are_counted_without_an_index_and_hits_have_derived_columns(spark, monkeypatch, crowd):
    monkeypatch.setattr(seed_index, "CROWD", crowd)
    rnd = random.Random(11)
    seqs = ["".join(rnd.choice("ACGTN") for _ in range(n)) for n in (40_000, 300, 17_000, 5)]
    df = spark.createDataFrame(list(enumerate(seqs)), "ordinal long, sequence string")
    index = seed_index.SeedIndex(spark, shared_folder(spark, "index-test"), "ordinal long", 4)
    parts = index._add_parts(df)
    index._add_seeds(parts)
    counted = parts.select("spot", "letters").mapInArrow(seed_index._seed_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    assert dict(counted.collect()) == dict(spark.table(index.seeds).groupBy("key").count().collect())
    index.forget()
    oligos = [("a", "FORWARD", seqs[0][50:70]), ("b", "PROBE", seqs[1][9:31]), ("short", "PROBE", seqs[2][9:19])]
    table = spark.createDataFrame(oligos, "assay_id string, role string, sequence string")
    found = seed_index.search_once(df, table, SpecificityConfig(), ["ordinal"], {"places": F.array_join("mismatch_positions", ",")}).collect()
    assert {r.assay_id for r in found} == {"a", "b", "short"} and all(r.places == ",".join(map(str, r.mismatch_positions)) for r in found)


def test_index_is_opened_again_and_grows(spark):
    config, rnd = SpecificityConfig(), random.Random(6)
    folder, keys = shared_folder(spark, "index-test"), "ordinal long"
    seqs = ["".join(rnd.choice("ACGT") for _ in range(400)) for _ in range(6)]
    df = spark.createDataFrame(list(enumerate(seqs)), "ordinal long, sequence string")
    oligos = spark.createDataFrame([(f"a{i}", "FORWARD", s[50:70]) for i, s in enumerate(seqs)], "assay_id string, role string, sequence string")
    index = seed_index.SeedIndex(spark, folder, keys, 4)
    index.add(df.where("ordinal < 2"))
    index.add(df.where("ordinal >= 2"))
    index.forget()
    again = seed_index.SeedIndex(spark, folder, keys, 4)
    found = again.search(oligos, config)
    assert sorted((r.ordinal, r.assay_id, r.source_start) for r in found.collect()) == [(i, f"a{i}", 51) for i in range(6)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert again.spark.table(again.seeds).where("spot is null").count() == 0
    again.forget()


def test_seeds_are_exact_letters():
    """Whatever letters differ, as many as may, one seed of an oligo is untouched."""
    from itertools import combinations

    for k, cap, protected, left in ((20, 2, 5, True), (20, 2, 5, False), (17, 2, 5, False), (22, 1, 0, False), (18, 1, 0, True), (30, 2, 0, False)):
        free = [i for i in range(k) if not protected or (i >= protected if left else i < k - protected)]
        seeds = [{first + i for i in seed_index.SHAPES[shape]} for choices in seed_index.seed_places(k, cap, protected, left) for shape, first in choices[:1]]
        assert all(max(s) < k and min(s) >= 0 for s in seeds)
        assert all(any(not s & set(bad) for s in seeds) for bad in combinations(free, cap))
    assert seed_index.seed_places(16, 2, 5, True) is None and seed_index.seed_places(17, 1, 0, True) is None


# insertions ---------------------------------------------------------------------------------------


def best_of_three(a, b, c):
    """Exact sum of pairs of three texts."""
    pair = lambda x, y: 0.0 if x == y == "-" else -insertions.GAP if "-" in (x, y) else insertions.MATCH if x == y else insertions.MISMATCH

    @lru_cache(None)
    def best(i, j, k):
        if not i and not j and not k:
            return 0.0
        out = -1e9
        for m in range(1, 8):
            di, dj, dk = m & 1, m >> 1 & 1, m >> 2 & 1
            if di <= i and dj <= j and dk <= k:
                x, y, z = a[i - 1] if di else "-", b[j - 1] if dj else "-", c[k - 1] if dk else "-"
                out = max(out, best(i - di, j - dj, k - dk) + pair(x, y) + pair(x, z) + pair(y, z))
        return out

    return best(len(a), len(b), len(c))


def aligned_texts(texts):
    columns, whole = insertions.merge_all([insertions.profile_of(t) for t in texts])
    return [insertions._place(t, c, len(whole)) for t, c in zip(texts, columns, strict=True)]


def test_merged_texts_against_exact_alignments():
    rnd = random.Random(3)
    exact, all_ = 0, 0
    for _ in range(60):
        base = "".join(rnd.choice("ACGT") for _ in range(rnd.randrange(3, 8)))
        texts = sorted({t for t in (mutated(rnd, base, rnd.randrange(3)) for _ in range(3)) if t}, key=lambda t: (-len(t), t))
        rows = aligned_texts(texts)
        assert [r.replace("-", "") for r in rows] == texts and len({len(r) for r in rows}) == 1
        assert not any(all(r[i] == "-" for r in rows) for i in range(len(rows[0])))
        if len(texts) == 3:
            got, want = insertions.pair_score(rows), best_of_three(*texts)
            assert got <= want + 1e-9
            exact, all_ = exact + (got >= want - 1e-9), all_ + 1
        if len(texts) == 2:
            assert insertions.pair_score(rows) >= best_of_three(*texts, "") + insertions.GAP * 0 - 1e-9 or len(texts[1]) == 0
    assert all_ > 20 and exact >= 0.9 * all_


@pytest.mark.parametrize("group", [256, 4])
def test_insertions_of_places_are_aligned(spark, group):
    rnd = random.Random(group)
    base = "".join(rnd.choice("ACGT") for _ in range(14))
    texts = {5: sorted({base} | {t for t in (mutated(rnd, base, rnd.randrange(4)) for _ in range(30)) if t}), 9: ["G"], 0: ["AC", "ACGTACGT", "GT"]}
    table = [(p, t, 1 + rnd.randrange(3)) for p, ts in texts.items() for t in ts]
    got = insertions.align_insertions(spark.createDataFrame(table, "place int, text string, n long").repartition(3), group).collect()
    by = {p: {r.text: r.aligned for r in got if r.place == p} for p in texts}
    assert {p: sorted(x) for p, x in by.items()} == {p: sorted(ts) for p, ts in texts.items()} and by[9] == {"G": "G"}
    for p, rows in by.items():
        assert len({len(a) for a in rows.values()}) == 1 and all(a.replace("-", "") == t for t, a in rows.items())
        width = max(map(len, rows))
        if p == 5:
            padded = insertions.pair_score([t.ljust(width, "-") for t in rows])
            assert insertions.pair_score(list(rows.values())) > padded
    assert by[0]["AC"] in ("AC------", "----AC--") and by[0]["GT"] in ("--GT----", "------GT")


def test_star_alignment_aligns_inserted_letters(spark):
    rnd = random.Random(8)
    ref = "".join(rnd.choice("ACGT") for _ in range(120))
    extra = "GATTACAGATTACA"
    seqs = [ref, ref[:60] + extra + ref[60:], ref[:60] + extra[2:] + ref[60:], ref[:60] + extra[:4] + extra[6:] + ref[60:], ref[:60] + extra + ref[60:]]
    df = spark.createDataFrame([(i, f"s{i}", s) for i, s in enumerate(seqs)], "ordinal long, sequence_id string, sequence string")
    out = align.align_all(df, "s0")
    rows = {r.sequence_id: r.aligned_sequence for r in out.collect()}
    assert align.problems(out, df, "s0").count() == 0
    assert rows["s1"] == rows["s4"]
    inner = [rows[f"s{i}"] for i in (1, 2, 3)]
    padded = [t.ljust(len(extra), "-") for t in (extra, extra[2:], extra[:4] + extra[6:])]
    assert len(rows["s0"]) == 120 + len(extra)
    assert insertions.pair_score(inner) - 3 * 120 >= insertions.pair_score(padded) + 10


# intervals ----------------------------------------------------------------------------------------


def test_interval_look_ups_equal_sums(spark):
    rng = np.random.default_rng(1)
    points = {int(p): (float(rng.integers(0, 100)), float(rng.random())) for p in range(3, 260) if p % 17}
    spans = sorted({(int(a), int(a + n - 1)) for a, n in zip(rng.integers(1, 250, 200), rng.choice([1, 2, 3, 4, 7, 8, 9, 31, 32, 33, 64, 100, 300], 200), strict=True)})
    df = spark.createDataFrame([(p, *v) for p, v in points.items()] + [(None, 5.0, 0.0)], "p int, x double, y double")
    table = spark.createDataFrame(spans, "reference_start int, reference_end int").repartition(3)
    got = ranges.interval_aggregates(table, df, "p", {"n": F.lit(1), "total": F.col("x")}, {"low": F.col("y")})
    want = []
    for a, b in spans:
        own = [points[p] for p in range(a, b + 1) if p in points]
        want.append((a, b, len(own), sum(x for x, _ in own), min((y for _, y in own), default=None)))
    assert sorted(map(tuple, got.collect())) == want
    assert ranges.interval_aggregates(table.limit(0), df, "p", {"n": F.lit(1)}, {}).count() == 0


def test_long_windows_take_rows_in_proportion(spark):
    n, w = 200_000, 20_000
    pos = spark.range(1, n + 1).select(F.col("id").cast("int").alias("reference_position"), (F.col("id") % 7 / 7).alias("major_allele_frequency"), F.lit(1.0).alias("coverage"), F.lit(0.0).alias("gap_frequency"), (F.col("id") % 3 / 1.0).alias("entropy_bits"))
    got = conserve.windows(pos, n, ConservationConfig(True, w, 1))
    x, e = np.arange(1, n + 1) % 7 / 7, np.arange(1, n + 1) % 3 / 1.0
    sums = np.concatenate([[0], np.cumsum(x)])
    r = got.agg(F.count(F.lit(1)).alias("n"), F.sum("mean_conservation").alias("m"), F.max("minimum_conservation").alias("low"), F.min("position_count").alias("c"), F.sum("mean_entropy_bits").alias("e")).first()
    ends = np.concatenate([[0], np.cumsum(e)])
    assert (r.n, r.low, r.c) == (n - w + 1, 0.0, w)
    assert abs(r.m - ((sums[w:] - sums[:-w]) / w).sum()) < 1e-5 and abs(r.e - ((ends[w:] - ends[:-w]) / w).sum()) < 1e-5


# similarity ---------------------------------------------------------------------------------------


def naive_best(queries, subjects):
    out = []
    for q in queries:
        both = [(q, False), (align.reverse_text(q), True)]
        found = [(-contrast.similarities([x], s)[0], name, flip) for name, s in subjects for x, flip in both]
        score, name, flip = min(found)
        out.append((-score, name, flip))
    return out


def test_pruned_similarities_equal_all_of_them():
    rnd = random.Random(12)
    subjects = [(f"s{i}", s) for i, s in enumerate(families(rnd, 3, 8, 80))]
    subjects += [("copy", subjects[3][1]), ("turned", align.reverse_text(subjects[5][1])), ("short", "ACG")]
    base = [s for _, s in subjects[:20]]
    queries = [mutated(rnd, s[a : a + 30], rnd.randrange(6), "ACGTRN") for s in base for a in (0, 20)] + ["ACGT", "A", "N" * 12, "TTTTTTTTTTTTTTTT"]
    assert contrast.block_best(queries, subjects) == naive_best(queries, subjects)
    bounds = contrast.upper_bounds(queries, [s for _, s in subjects])
    for row, (_, s) in enumerate(subjects):
        assert (np.array(contrast.similarities(queries, s)) <= bounds[row] + 1e-12).all()


def test_similarities_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(contrast, "WINDOWS", 3)
    monkeypatch.setattr(contrast, "LETTERS", 300)
    rnd = random.Random(13)
    seqs = [(f"d{i % 2}", f"s{i:02d}", s) for i, s in enumerate([*families(rnd, 2, 8, 60), ""])]
    queries = [(i, i + 24, seqs[i][2][5:30]) for i in range(10)]
    windows = spark.createDataFrame(queries, "reference_start int, reference_end int, query string")
    got = contrast.best_matches(windows, spark.createDataFrame(seqs, "dataset string, sequence_id string, sequence string")).collect()
    want = {}
    for d in ("d0", "d1"):
        for (a, b, _), (score, name, flip) in zip(queries, naive_best([q for _, _, q in queries], [(n, s) for x, n, s in seqs if x == d and s]), strict=True):
            want[a, b, d] = (score, name, "REVERSE_COMPLEMENT" if flip else "FORWARD")
    assert {(r.reference_start, r.reference_end, r.dataset): (r.similarity, r.sequence_id, r.orientation) for r in got} == want


def test_votes_of_rows_equal_votes_of_cells(spark):
    rnd = random.Random(2)
    rows = [(i, f"s{i}", "".join(rnd.choice(insertions.SYMBOLS + "ax?") for _ in range(30 + i % 3))) for i in range(50)]
    df = spark.createDataFrame(rows, "ordinal long, sequence_id string, aligned_sequence string").repartition(4)
    columns = ("alignment_position", "depth", "n", "votes_A", "votes_C", "votes_G", "votes_T", "support")
    got, want = conserve.aligned_votes(df).select(*columns), conserve.column_votes(conserve.cells(df)).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert conserve.aligned_votes(df.limit(0)).count() == 0


def test_many_designs_bind_as_few_do(spark, monkeypatch):
    rnd = random.Random(21)
    base = "".join(rnd.choice("ACGT") for _ in range(260))
    seqs = [(i, f"s{i}", mutated(rnd, base, rnd.randrange(12)) if i % 4 else align.reverse_text(base)) for i in range(9)]
    spot = lambda a, n, flip: (align.reverse_text(base[a - 1 : a - 1 + n]) if flip else base[a - 1 : a - 1 + n], a, a + n - 1)
    assays = [(f"a{k}", 110, spot(10 + k, 20, False), spot(50 + k, 22, False), spot(100 + k, 20, True)) for k in range(5)]
    oligo = "struct<sequence:string,reference_start:int,reference_end:int>"
    table = spark.createDataFrame(assays, f"assay_id string, product_size int, forward {oligo}, probe {oligo}, reverse {oligo}")
    df = spark.createDataFrame(seqs, "ordinal long, sequence_id string, sequence string")
    run = lambda: sorted(map(repr, inclusivity.bindings(df, table, InclusivityConfig()).collect()))
    want = run()
    monkeypatch.setattr(inclusivity, "DESIGNS", 2)
    monkeypatch.setattr(inclusivity, "LETTERS", 600)
    assert run() == want and len(want) == 45
