"""Queries that SQL can't express, or only too slowly, against plain versions on the smallest tables."""

from strandweave.operators import cluster
from strandweave.operators.align import reverse_text
from strandweave.plans import queries as own

from .test_operators import naive_local

SF = "/root/testdata/sf0.001"


def test_similarity_of_all_windows_equals_naive(spark):
    names = {r.n_nationkey: r.n_name for r in own.table(spark, SF, "nation").collect()}
    home = {r.s_suppkey: names[r.s_nationkey] for r in own.table(spark, SF, "supplier").collect()}
    sequences = [(home[r.ordinal], r.sequence_id, r.sequence) for r in own._evaluation(spark, SF).collect()]
    want = {}
    for w in own._window_queries(spark, SF).select("reference_start", "reference_end", "query").collect():
        for dataset, name, s in sequences:
            for flip, q in ((False, w.query), (True, reverse_text(w.query))):
                score = round(min(1.0, naive_local(q, s) / len(q)), 6)
                key = (w.reference_start, w.reference_end, dataset)
                want[key] = min(want.get(key, (0, "~", True)), (-score, name, flip))
    got = {(r.reference_start, r.reference_end, r.dataset): (-r.similarity, r.sequence_id, r.orientation != "FORWARD") for r in own.QUERIES["q27_similarity_local"](spark, SF).collect()}
    assert got == want and len(got) > 100


def test_clusters_of_all_sequences_equal_one_pass(spark):
    sf = "/root/testdata/sf0.01"
    rows = sorted(((-len(r.sequence), r.ordinal, r.sequence_id, r.sequence) for r in own._evaluation(spark, sf).collect()))
    leaders, home = [], {}
    for i, (_, _, name, s) in enumerate(rows):
        near = [(-cluster.identity(s, rows[k][3]), k) for k in leaders]
        near = [x for x in near if -x[0] >= 0.90]
        home[name] = rows[min(near)[1]][2] if near else name
        leaders += [] if near else [i]
    got = {r.sequence_id: r.representative_id for r in own.QUERIES["q40_cluster_greedy"](spark, sf).collect()}
    assert got == home and len(got) == len(rows) and len(set(got.values())) < len(got)
