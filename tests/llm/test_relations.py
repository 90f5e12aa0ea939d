import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandweave.llm import chat, embedding_dedup, lm_score, warc
from strandweave.llm.common import workspace

from .test_dedup import brute_components


def vectors(rng, centers, copies, dims, spread):
    out = []
    for _ in range(centers):
        c = rng.normal(size=dims)
        for _ in range(copies):
            out.append((c + rng.normal(size=dims) * spread).astype(np.float32).astype(float).tolist())
    return out


@pytest.mark.parametrize("block,base", [(1024, 256), (16, 4)])
def test_embedding_links_equal_brute_force(spark, monkeypatch, block, base):
    monkeypatch.setattr(embedding_dedup, "BASE", base)
    rng = np.random.default_rng(2)
    vs = vectors(rng, 20, 8, 12, 0.09)
    rows = [(i, v, i % 3) for i, v in enumerate(vs)]
    rows += [(1000 + i, vs[5], 5 % 3) for i in range(30)]  # copies
    rows += [(2000, None, 1), (2001, [0.0] * 12, 1), (2002, [float("nan")] + [1.0] * 11, 1), (2003, vs[0], None), (2004, vs[0][:5], 0), (2005, [], 0), (2006, [None] * 12, 0), (2007, [2 * x for x in vs[0]], 0), (2001, vs[3], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {}
    for r in embedding_dedup.embedding_groups(df, block=block).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    fine = [(i, np.array(v), y) for i, v, y in rows if y is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = []
    for a in range(len(fine)):
        for b in range(a):
            (i, u, x), (j, w, y) = fine[a], fine[b]
            if x == y and len(u) == len(w) and u @ w / np.sqrt(u @ u) / np.sqrt(w @ w) >= 0.98:
                links.append((a, b))
    ids = [i for i, _, _ in fine]
    roots = brute_components(range(len(fine)), links)
    least = {}
    for n in range(len(fine)):
        least[roots[n]] = min(least.get(roots[n], ids[n]), ids[n])
    want = {}
    for n, i in enumerate(ids):
        c = least[roots[n]]
        want.setdefault(i, []).append((sum(n in p for p in links), c, i == c))
    for i in (r[0] for r in rows if r[0] not in want):
        want[i] = [(0, i, True)]
    want[2001].append((0, 2001, True))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()} and len(links) > 200


def test_embedding_without_usable_vectors(spark):
    df = spark.createDataFrame([(1, None, 0), (None, [1.0], 0)], "vec_id long, embedding array<float>, label int")
    assert {(r.vec_id, r.component_id, r.kept) for r in embedding_dedup.embedding_groups(df).collect()} == {(1, 1, True), (None, None, False)}
    assert embedding_dedup.embedding_groups(df.limit(0)).count() == 0


def brute_lm(texts, order, alpha, asked=None):
    docs = [(t or "").encode().lower().split() for t in texts]
    grams, n = {}, 0
    for words in docs:
        n += len(words)
        for k in range(1, order + 1):
            for i in range(len(words) - k + 1):
                g = tuple(words[i : i + k])
                grams[g] = grams.get(g, 0) + 1

    def s(history, w):
        g = (*history, w)
        if len(g) == 1:
            return np.log(grams[g] / n) if g in grams else 0.0
        if g in grams:
            return np.log(grams[g] / grams[g[:-1]])
        return np.log(alpha) + s(history[1:], w)

    docs = docs if asked is None else [(t or "").encode().lower().split() for t in asked]
    return [sum(s(tuple(words[max(0, i - order + 1) : i]), words[i]) for i in range(len(words))) for words in docs]


def lm_cases(rng, n):
    words = ["aa", "b", "Cé", "dd", "e", "f", "gg"]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(0, 40))) for _ in range(n)] + ["", None, "one", "never seen twice", "\x85 x"]


@pytest.mark.parametrize("order,often,hold", [(1, 256, 1000), (1, 3, 50), (2, 256, 50), (2, 2, 1000), (3, 256, 1000), (3, 2, 50), (4, 3, 1000), (5, 256, 90)])
def test_language_model_equals_brute_force(spark, tmp_path, monkeypatch, order, often, hold):
    monkeypatch.setattr(lm_score, "OFTEN", often)
    monkeypatch.setattr(lm_score, "HOLD", hold)
    texts = lm_cases(random.Random(4), 40)
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(3, texts[3], "s"), (3, texts[3], "s"), (None, "aa b", "s"), (None, "aa b", "s"), (3, "gg", "s")]
    spark.createDataFrame(rows, "doc_id long, text string, n_tokens string").repartition(3).write.parquet(str(tmp_path / "d"))
    out = lm_score.lm_scores(spark.read.parquet(str(tmp_path / "d")), order=order).collect()
    want = {}
    for (i, _, _), s in zip(rows, brute_lm([t for _, t, _ in rows], order, lm_score.ALPHA), strict=True):
        want.setdefault(i, []).append(s)
    got = {}
    for r in out:
        got.setdefault(r.doc_id, []).append(r.log_score)
        assert (r.mean_log_score is None) == (r.n_tokens == 0)
    assert set(got) == set(want)
    for i in want:
        assert sorted(got[i]) == pytest.approx(sorted(want[i]))


@pytest.mark.parametrize("order,hot", [(2, 65_536), (3, 65_536), (3, 8), (4, 20)])
def test_language_model_backs_off_on_other_texts(spark, monkeypatch, order, hot):
    monkeypatch.setattr(lm_score, "HOT", hot)
    shape = "doc_id long, text string"
    known = lm_cases(random.Random(5), 12)
    other = [*lm_cases(random.Random(6), 30), "unheard of words", "aa unheard b dd e", "gg gg gg gg gg"]
    model = lm_score.train(spark.createDataFrame(list(enumerate(known)), shape), order=order)
    got = {r.doc_id: r.log_score for r in lm_score.score(spark.createDataFrame(list(enumerate(other)), shape), model).collect()}
    want = brute_lm(known, order, lm_score.ALPHA, other)
    assert [got[i] for i in range(len(other))] == pytest.approx(want)
    rows = model.ngrams().collect()
    assert sum(r.n for r in rows if r.k == 1) == model.tokens == sum(len((t or "").encode().split()) for t in known)
    assert all(0 < r.n <= r.of for r in rows) and len({(r.k, r.key) for r in rows}) == len(rows)


@pytest.mark.parametrize("order,turns,hold", [(1, 2, 50), (2, 3, 50), (3, 1, 1000), (3, 2, 70), (4, 2, 90)])
def test_language_model_of_known_rows_scores_all_rows(spark, monkeypatch, order, turns, hold):
    monkeypatch.setattr(lm_score, "HOLD", hold)
    texts = [*lm_cases(random.Random(7), 40), "unheard of words", "aa unheard b dd e", "gg " * 700]
    rows = [(i, t, None if i % 7 == 6 else i % 4 != 2) for i, t in enumerate(texts)] + [(3, texts[3], True), (3, "gg", False), (None, "aa b", True), (None, "aa b", False)]
    out = lm_score.split_scores(spark.createDataFrame(rows, "doc_id long, text string, own boolean").repartition(3), F.col("own"), order=order, turns=turns).collect()
    known = [t for _, t, own in rows if own]
    want = sorted((-1 if i is None else i, s) for (i, _, _), s in zip(rows, brute_lm(known, order, lm_score.ALPHA, [t for _, t, _ in rows]), strict=True))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.log_score) for r in out)
    assert [i for i, _ in got] == [i for i, _ in want] and [s for _, s in got] == pytest.approx([s for _, s in want])
    assert sum(r.n_tokens for r in out) == sum(len((t or "").encode().split()) for _, t, _ in rows)


def test_language_model_without_known_rows(spark):
    rows = spark.createDataFrame([(1, "a b c d"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_tokens, r.log_score, r.mean_log_score) for r in lm_score.split_scores(rows, F.lit(False)).collect()}
    assert got[1][:2] == (4, pytest.approx(5 * np.log(lm_score.ALPHA))) and got[2] == (0, 0.0, None)
    assert lm_score.split_scores(rows.limit(0), F.lit(True)).count() == 0


def test_language_model_query_stores_little(spark, tmp_path, monkeypatch):
    """Its n-grams go out once, without tables of all of them: what it stores is under seven bytes a token."""
    from strandweave.llm import queries

    monkeypatch.setattr(lm_score, "workspace", lambda spark, name: f"file://{tmp_path}/{name}")
    queries.QUERIES["op6_lm_scoring"](spark, "/root/testdata/sf0.01").count()
    stored = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    tokens = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").agg(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0]
    assert stored < 7 * tokens


def test_counts_are_packed_whole():
    for n in ([], [0, 1, 254], [255, 3, 256, 1 << 40, 0]):
        assert lm_score._unpack_counts(lm_score._pack_counts(np.array(n, np.int64))).tolist() == n


def test_language_model_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    assert lm_score.lm_scores(spark.read.parquet(str(tmp_path / "d"))).count() == 0


PAYLOADS = ["", None, "x" * 99, "x" * 99, "y" * 100, "y" * 100, "\r\n\r\n" * 40, "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "z" * 90, "é" * 50, "é" * 50, "\n", "\r\n\r\n", "end\r\n\r\n", "\r", "q" * 300_000]


def test_archives_round_trip(spark):
    rows = [(i, f"http://e.org/{i}", p, "t") for i, p in enumerate(PAYLOADS)] + [(100, None, "y" * 100, "t"), (None, "u\r\nX: y", "y" * 100, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string").repartition(3)
    got = {r.page_id: r for r in warc.round_trip(pages).collect()}
    assert len(got) == len(rows)
    first = {}
    for i, _, p, _ in rows:
        data = (p or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha256(data).hexdigest()), i
        if i is not None and len(data) >= 100:
            first.setdefault(data, i)
        other = first.get(data) if i is not None and len(data) >= 100 else None
        assert (r.record_type, r.refers_to) == (("revisit", other) if other not in (None, i) else ("response", None)), i
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_assembled_captures_hold_payloads_and_their_records(spark):
    pages = spark.createDataFrame([(i, f"http://e.org/{i}", p) for i, p in enumerate(PAYLOADS)], "page_id long, url string, html string")
    path = workspace(spark, "warc-test")
    warc.write_captures(pages, path)
    rows = warc.assemble(warc.read_warc(spark, path)).collect()
    assert len(rows) == len(PAYLOADS)
    for r in rows:
        key = int(bytes(r.metadata.payload).split(b": ")[1])
        assert bytes(r.request.payload).startswith(b"") and r.request.target_uri == r.capture.target_uri == f"http://e.org/{key}"
        if r.capture.record_type == "response":
            assert bytes(r.capture.payload).decode() == (PAYLOADS[key] or "") and r.capture.http_status == 200
        else:
            assert r.capture.refers_to == warc.record_id("capture", str(PAYLOADS.index(PAYLOADS[key])))
    import glob
    import gzip

    raw = b"".join(gzip.open(f).read() for f in sorted(glob.glob(path.removeprefix("file:") + "/*.gz")))
    assert raw.count(b"WARC/1.1\r\nWARC-Type: request\r\n") == len(PAYLOADS)


def test_torn_and_foreign_records():
    one = warc._record("response", [("WARC-Record-ID", "<a>"), ("Content-Type", "application/http;msgtype=response")], b"HTTP/1.1 404 No\r\nX: y\r\n\r\nbody")
    empty = warc._record("metadata", [("WARC-Record-ID", "<b>"), ("WARC-Concurrent-To", "<a>")], b"")
    torn = warc._record("resource", [("WARC-Record-ID", "<c>")], b"x" * 50)[:-20]
    data = b"\r\n\r\n".join([one, empty, torn])
    out = list(warc._parse((("f", p) for p in data.split(b"\r\n\r\n")), True))
    assert [(r["record_id"], r["truncated"]) for r in out] == [("<a>", False), ("<b>", False), ("<c>", True)]
    assert out[0]["http_status"] == 404 and out[0]["payload"] == b"body" and out[2]["payload"] == b"x" * 30


def turns(*pairs):
    return [{"role": r, "text": t} for r, t in pairs]


SHAPE = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt string"


def test_preference_pairs(spark):
    a = turns(("system", "Be"), ("user", "hi"), ("assistant", "good"), ("user", "so?"))
    b = turns(("system", "Be"), ("user", "hi"), ("assistant", "bad <|im_end|>"))
    rows = [(1, a, b, "z"), (2, a, a, "z"), (3, None, b, "z"), (4, a[:2], a, "z"), (None, [], [], "z"), (1, a, b, "z")]
    got = chat.format_preferences(spark.createDataFrame(rows, SHAPE)).collect()
    assert [r.n_prompt_turns for r in got] == [2, 4, 0, 2, 0, 2]
    r = got[0]
    assert r.prompt == "<|im_start|>system\nBe<|im_end|>\n<|im_start|>user\nhi<|im_end|>\n"
    assert r.chosen == "<|im_start|>assistant\ngood<|im_end|>\n<|im_start|>user\nso?<|im_end|>\n"
    assert [r.chosen[s.start : s.end] for s in r.chosen_loss] == ["good<|im_end|>"]
    assert [r.rejected[s.start : s.end] for s in r.rejected_loss] == ["bad <\\|im_end|><|im_end|>"]
    assert (got[1].chosen, got[1].rejected, got[1].chosen_loss) == ("", "", []) and got[3].chosen == ""
    assert got[2].chosen == "" and got[2].prompt == "" and got[4].prompt == ""
    assert chat.format_preferences(spark.createDataFrame([], SHAPE)).count() == 0


def test_spliced_pairs(spark):
    rows = [(0, 0, "user", "q", 1), (0, 1, "assistant", "a0", 1), (0, 2, "user", "thanks", 1), (1, 1, "assistant", "a1", 1), (1, 0, "user", "p", 1), (2, 0, "user", None, 1), (None, 0, "user", "x", 1), (3, 0, "assistant", "a3", 1), (3, 1, "assistant", "b3", 1), (6, 0, "assistant", "z", 1)]
    rows += [(8, i, "user" if i % 2 else "assistant", f"same {i}", 1) for i in range(5)] + [(9, i, "user" if i % 2 else "assistant", f"same {i}" if i < 4 else "other", 1) for i in range(7)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, chosen int")
    got = {r.pair_id: r for r in chat.spliced_pairs(table).collect()}
    said = lambda side: None if side is None else [t.text for t in side]
    assert said(got[0].chosen) == ["q", "a0", "thanks"] and said(got[0].rejected) == ["q", "a1"]
    assert said(got[1].rejected) == ["p", "a0", "thanks"] and said(got[2].rejected) == ["", "b3"] and said(got[3].rejected) == ["a3", ""]
    assert got[6].rejected is None and set(got) == {0, 1, 2, 3, 6, 8, 9}
    # 8 parts at its last reply (8 mod 3 = 2), 9 at its second (9 mod 4 = 1)
    assert said(got[8].rejected) == [f"same {i}" for i in range(4)] + ["same 2", "same 3", "other", "other", "other"]
    assert said(got[9].rejected) == ["same 0", "same 1", "same 4"]
    shown = {r.pair_id: r for r in chat.format_preferences(chat.spliced_pairs(table)).collect()}
    assert (shown[8].n_prompt_turns, shown[9].n_prompt_turns, shown[6].n_prompt_turns) == (4, 2, 0)
    plan = chat.format_preferences(chat.spliced_pairs(table))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
    assert chat.spliced_pairs(table.limit(0)).count() == 0


def test_archive_of_null_and_repeated_ids(spark):
    long = "x" * 200
    rows = [(None, "u", long), (None, "v", long), (None, "u", long), (None, "", None), (7, "u", long), (7, "w", "y" * 150), (3, "u", long), (9, None, "")]
    pages = spark.createDataFrame([(*r, "c", "r") for r in rows], "page_id long, url string, html string, capture string, record_id string").repartition(3)
    got = warc.round_trip(pages).collect()
    assert sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to or 0) for r in got) == sorted(
        [(0, 200, "response", 0)] * 3 + [(0, 0, "response", 0), (3, 200, "response", 0), (7, 200, "revisit", 3), (7, 150, "response", 0), (9, 0, "response", 0)]
    )
    path = workspace(spark, "warc-nulls")
    warc.write_captures(pages, path)
    ids = [r.record_id for r in warc.read_warc(spark, path).where("record_type <> 'metadata' and record_type <> 'request'").collect()]
    assert len(ids) == 8 and len(set(ids)) == 6  # one row is repeated whole, and one id has two rows


def test_reader_takes_time_in_proportion_to_the_payload():
    import time

    body = b"a\r\n\r\n" * 1_000_000
    record = warc._record("response", [("WARC-Record-ID", "<a>"), ("Content-Type", "application/http;msgtype=response")], b"HTTP/1.1 200 OK\r\n\r\n" + body)
    pieces = (record + b"\r\n\r\n").split(b"\r\n\r\n")
    began = time.process_time()
    (found,) = warc._parse((("f", p) for p in pieces), True)
    assert time.process_time() - began < 2
    assert found["payload"] == body and not found["truncated"]
