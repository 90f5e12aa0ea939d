"""Toxic spans by a linear-chain conditional random field.

Token labels come from labelled documents by distant supervision: in toxic training documents the
word forms and beginnings that occur there far more often than chance allows mark the toxic tokens;
every other token is not toxic. A two-state chain over each sentence (two transition weights and sparse word
features) is fitted by exact forward-backward gradients, and the marginals of the fitted chain give
each document a score and the offsets of its offending spans.
"""

from __future__ import annotations

import re
from array import array
from dataclasses import dataclass, field
from math import lgamma, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import fitted_in_task
from strandweave.llm.quality import _drawn, fold, keep_scored

#: Bounds of the training sample, in labelled rows, whatever the length of their texts.
TOXIC, CLEAN = 1000, 2000
THRESHOLD, SPAN = 0.3, 0.5
#: Marginals up to FAINT don't count towards a document's score; RIDGE bounds the score's weights.
FAINT, RIDGE = 0.05, 0.3
#: A chain is a whole sentence; longer ones are worked through in chunks that hand on their messages.
CHUNK = 256
STEPS, RATE, DECAY = 60, 0.5, 2e-3
#: Chance of calling any harmless trait toxic, over all traits tested in a round.
SIGNIFICANCE = 0.05
#: A trait must be so many times as usual in toxic as in clean documents, which no language of the corpus is.
RATIO = 50
PREFIXES = (3, 4, 5, 6)
MEMORY, LONG = 400_000, 64
_STRIP = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_END_MARK = 1024.0


def form(token: bytes) -> str:
    return token.strip(_STRIP).decode("utf-8", "replace").lower()


def traits(word: str) -> list[str]:
    """What a token may be toxic by: its form and its first three to six letters."""
    return ["w=" + word] + [f"{k}={word[:k]}" for k in PREFIXES if len(word) >= k]


def token_features(word: str) -> list[str]:
    """Names of a token's features: its traits, its last three letters and whether it is short."""
    return [*traits(word), "s=" + word[-3:], "n" if len(word) < 3 else "m"]


def chains(ends: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Starts of chains among tokens: documents start at ``starts``, sentences after ``ends``."""
    n = len(ends)
    cut = np.zeros(n, bool)
    cut[1:] = ends[:-1]
    cut[starts[starts < n]] = True
    return np.flatnonzero(cut)


def _runs(first: np.ndarray, lengths: np.ndarray):
    """Order, longest first, of runs of tokens, and how many are still running at each step."""
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    return order, first[order], lengths, np.searchsorted(-lengths, -np.arange(1, steps + 1), side="right")


def _messages(odds: np.ndarray, a: np.ndarray, first: np.ndarray, lengths: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For chunks of chains: the forward message that enters each from the chunk before, and the
    backward message at each one's last token. Chunks that begin a chain get (1, 0) forward.

    A chunk acts on messages as one 2x2 matrix, the product over its tokens; those of all chunks are
    found together, and only the products over chunks run one after the other.
    """
    n = len(first)
    act = np.tile(np.eye(2), (n, 1, 1))
    order, at0, _, alive = _runs(first, lengths)
    for t in range(len(alive)):
        own, at = order[: alive[t]], at0[: alive[t]] + t
        step = act[own] @ a
        step[:, :, 1] *= odds[at][:, None]
        act[own] = step / step.sum(axis=(1, 2), keepdims=True)
    enter, leave = np.zeros((n, 2)), np.ones((n, 2))
    enter[:, 0] = 1.0
    begin = np.zeros(n, bool)
    begin[np.searchsorted(first, begins)] = True
    # the first chunk's own forward message starts without a step between states
    for c in np.flatnonzero(~begin).tolist():
        if begin[c - 1]:
            f = _first_chunk(odds[first[c - 1] : first[c - 1] + lengths[c - 1]], a)
        else:
            f = enter[c - 1] @ act[c - 1]
        enter[c] = f / f.sum()
    for c in np.flatnonzero(~begin)[::-1].tolist():
        g = act[c] @ leave[c]
        leave[c - 1] = g / g.sum()
    return enter, leave


def _first_chunk(odds: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Forward message at the last token of a chain's first chunk."""
    f0, f1 = 1.0, float(odds[0])
    (p, q), (r, s) = a.tolist()
    for o in odds[1:].tolist():
        f0, f1 = f0 * p + f1 * r, (f0 * q + f1 * s) * o
        total = f0 + f1
        f0, f1 = f0 / total, f1 / total
    return np.array([f0, f1])


def marginals(emit: np.ndarray, begins: np.ndarray, trans: np.ndarray, steps_too: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """P(token toxic) and, if asked, the expected steps between states, of exact forward-backward.

    ``emit``: toxic minus other potential of each token; ``trans``: 2x2 log potentials. Chains of any
    length are cut into chunks, which advance together, longest first, so that those still running
    are always a leading block; the messages between chunks of a chain are found before.
    """
    n = len(emit)
    a = np.exp(trans)
    odds = np.exp(np.clip(emit, -30, 30))
    first, lengths = begins, np.diff(np.append(begins, n))
    enter = leave = None
    if len(lengths) and lengths.max() > CHUNK:
        counts = -(-lengths // CHUNK)
        first = np.repeat(begins, counts) + CHUNK * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
        lengths = np.diff(np.append(first, n))
        enter, leave = _messages(odds, a, first, lengths, begins)
    order, first, lengths, alive = _runs(first, lengths)
    begin = np.ones(len(first), bool)
    if enter is not None:
        enter, leave = enter[order], leave[order]
        begin = np.isin(first, begins)
    forward, backward = np.empty((n, 2)), np.empty((n, 2))
    for t in range(len(alive)):
        at = first[: alive[t]] + t
        if t:
            before = forward[at - 1]
        elif enter is not None:
            before = enter
        if t or enter is not None:
            f0 = before[:, 0] * a[0, 0] + before[:, 1] * a[1, 0]
            f1 = (before[:, 0] * a[0, 1] + before[:, 1] * a[1, 1]) * odds[at]
            if not t:
                f0, f1 = np.where(begin, 1.0, f0), np.where(begin, odds[at], f1)
        else:
            f0, f1 = np.ones(len(at)), odds[at]
        total = f0 + f1
        forward[at, 0], forward[at, 1] = f0 / total, f1 / total
    last = first + lengths - 1
    for t in range(len(alive)):
        at = last[: alive[t]] - t
        if t:
            after0, after1 = backward[at + 1, 0], backward[at + 1, 1] * odds[at + 1]
            b0, b1 = a[0, 0] * after0 + a[0, 1] * after1, a[1, 0] * after0 + a[1, 1] * after1
        else:
            b0, b1 = (np.ones(len(at)), np.ones(len(at))) if leave is None else leave.T
        total = b0 + b1
        backward[at, 0], backward[at, 1] = b0 / total, b1 / total
    joint = forward * backward
    p = joint[:, 1] / joint.sum(1)
    if not steps_too:
        return p, None
    inner = np.ones(n, bool)
    inner[begins] = False
    i = np.flatnonzero(inner)
    pair = [forward[i - 1, s] * a[s, t] * (odds[i] if t else 1.0) * backward[i, t] for s in (0, 1) for t in (0, 1)]
    total = sum(pair)
    return p, np.array([(x / total).sum() for x in pair])


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float
    trans: np.ndarray
    head: np.ndarray = field(default_factory=lambda: np.zeros(4))
    known: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "trans": self.trans, "head": self.head, "known": {}}

    def _value(self, token: bytes) -> float:
        """A token's potential; _END_MARK is added where it ends a sentence."""
        word = form(token)
        value = self.bias + sum(self.weights.get(f, 0.0) for f in token_features(word))
        value = max(-30.0, min(30.0, value))
        value += _END_MARK * token.endswith((b".", b"!", b"?"))
        if len(token) <= LONG and len(self.known) < MEMORY:
            self.known[token] = value
        return value

    def tag(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Marginals of all tokens of all texts, and where each text's tokens start (and end)."""
        values, bounds = [], [0]
        get = self.known.get
        for text in texts:
            words = text.split()
            got = list(map(get, words))
            if None in got:
                got = [self._value(w) if v is None else v for w, v in zip(words, got, strict=True)]
            values.append(np.array(got, dtype=np.float64))
            bounds.append(bounds[-1] + len(words))
        bounds = np.array(bounds)
        flat = np.concatenate([np.empty(0), *values])
        ends = flat > _END_MARK / 2
        emit = flat - _END_MARK * ends
        begins = chains(ends, np.unique(bounds[:-1]))
        return (marginals(emit, begins, self.trans)[0] if len(flat) else flat), bounds

    def aggregate(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Each document's log expected number and percentage of toxic tokens, its most toxic token's
        marginal and a constant; FAINT marginals count nothing."""
        n = np.diff(bounds)
        full = np.flatnonzero(n)
        expected, most = np.zeros(len(n)), np.zeros(len(n))
        if len(full):
            at = bounds[:-1][full]
            expected[full] = np.add.reduceat(np.where(p > FAINT, p, 0.0), at)
            most[full] = np.maximum.reduceat(p, at)
        return np.stack([np.log1p(expected), np.minimum(100 * expected / (n + 20), 4.0), most, np.ones(len(n))], axis=1)

    def document_scores(self, p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        scores = 1 / (1 + np.exp(-np.clip(self.aggregate(p, bounds) @ self.head, -30, 30)))
        return np.where(np.diff(bounds) > 0, scores, 0.0)

    def score(self, texts: list[bytes]) -> np.ndarray:
        """Probability that each text is toxic, from its tokens' marginals; 0 without tokens."""
        return self.document_scores(*self.tag(texts))

    def spans(self, text: str, p: np.ndarray, least: float = SPAN) -> list[tuple[int, int, float]]:
        """(start, end, largest marginal) in characters of each run of tokens with at least ``least``."""
        if not (p >= least).any():
            return []
        out: list[list] = []
        last = -2
        for i, m in enumerate(_TOKEN.finditer(text)):
            if p[i] >= least:
                if i == last + 1:
                    out[-1][1], out[-1][2] = m.end(), max(out[-1][2], float(p[i]))
                else:
                    out.append([m.start(), m.end(), float(p[i])])
                last = i
        return [tuple(x) for x in out]


def toxic_traits(toxic: list[np.ndarray], clean: list[np.ndarray], n_traits: int) -> np.ndarray:
    """Which traits are in so many more toxic than clean documents that chance gives one of them under
    SIGNIFICANCE. Documents are arrays of distinct trait numbers.

    Each round looks only at the toxic documents that no trait found so far explains.
    """
    count = lambda docs: np.bincount(np.concatenate([np.empty(0, np.int64), *docs]), minlength=n_traits)
    df0 = count(clean)
    out = np.zeros(n_traits, bool)
    rest = toxic
    while rest and clean:
        df1 = count(rest)
        n1, n0 = len(rest), len(clean)
        share = n1 / (n1 + n0)
        tested = np.flatnonzero((df1 > 2) & (df1 / n1 > RATIO * df0 / n0))
        bar = log(SIGNIFICANCE / max(1, int((df1 > 0).sum()) // 8, len(tested)))
        new = np.zeros(n_traits, bool)
        for w in tested.tolist():
            k, n = int(df1[w]), int(df1[w] + df0[w])
            tail = [lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * log(share) + (n - i) * log(1 - share) for i in range(k, n + 1)]
            new[w] = np.logaddexp.reduce(tail) < bar
        if not new.any():
            break
        out |= new
        rest = [doc for doc in rest if not new[doc].any()]
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + RIDGE * w
        move = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + RIDGE * np.eye(len(w)), grad)
        w -= move * min(1.0, 5 / (np.abs(move).max() + 1e-12))
    return w


def fit(toxic: list[bytes], clean: list[bytes], share: float | None = None) -> ToxicityModel | None:
    """A chain fitted to labelled documents, ``share`` of whose population is toxic; None where no
    trait stands out."""
    toxic, clean = list(dict.fromkeys(toxic)), list(dict.fromkeys(clean))
    index: dict[bytes, int] = {}
    docs = [[index.setdefault(w, len(index)) for w in doc.split()] for doc in [*toxic, *clean]]
    docs = [np.array(doc, dtype=np.int64) for doc in docs]
    forms = [form(w) for w in index]
    of_word, of_trait, numbers = array("q"), array("q"), {}
    for i, f in enumerate(forms):
        for x in traits(f) if len(f) > 1 else ():
            of_word.append(i)
            of_trait.append(numbers.setdefault(x, len(numbers)))
    of_word, of_trait = np.frombuffer(of_word, np.int64), np.frombuffer(of_trait, np.int64)
    first = np.searchsorted(of_word, np.arange(len(forms) + 1))
    sets = [np.unique(np.concatenate([np.empty(0, np.int64), *(of_trait[first[w] : first[w + 1]] for w in np.unique(doc))])) for doc in docs]
    bad = toxic_traits(sets[: len(toxic)], sets[len(toxic) :], len(numbers))
    if not bad.any():
        return None
    is_bad = np.bincount(of_word, bad[of_trait], len(forms)) > 0
    del sets, of_word, of_trait, numbers
    closes = np.array([w.endswith((b".", b"!", b"?")) for w in index])
    names: dict[str, int] = {}
    of_word, of_name = array("q"), array("q")
    for i, f in enumerate(forms):
        for x in token_features(f):
            of_word.append(i)
            of_name.append(names.setdefault(x, len(names)))
    of_word, of_name = np.frombuffer(of_word, np.int64), np.frombuffer(of_name, np.int64)
    flat = np.concatenate(docs)
    sizes = [len(doc) for doc in docs]
    starts = np.cumsum([0, *sizes])[:-1]
    y = np.zeros(len(flat))
    labelled = sum(sizes[: len(toxic)])
    y[:labelled] = is_bad[flat[:labelled]]
    begins = chains(closes[flat], np.unique(starts))
    inner = np.ones(len(y), bool)
    inner[begins] = False
    i = np.flatnonzero(inner)
    seen = np.bincount((y[i - 1] * 2 + y[i]).astype(np.int64), minlength=4).astype(np.float64)
    n, v_words = len(names), len(forms)
    theta = np.zeros(n + 5)
    theta[n] = log((y.sum() + 1) / (len(y) - y.sum() + 1))
    # a feature's gradient is taken for each of its occurrences' square root, so rare ones learn too
    often = np.bincount(of_name, np.bincount(flat, minlength=v_words)[of_word], n)
    scale = np.sqrt(np.concatenate([often + 1, np.full(5, len(y) + 1.0)]))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        potential = np.bincount(of_word, theta[of_name], v_words) + theta[n]
        p, pair = marginals(potential[flat], begins, theta[-4:].reshape(2, 2), True)
        wrong = np.bincount(flat, p - y, v_words)
        grad = np.concatenate([np.bincount(of_name, wrong[of_word], n), [wrong.sum()], pair - seen]) / scale + DECAY * theta
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 0.01)
    weights = {x: float(theta[k]) for x, k in names.items() if abs(theta[k]) > 1e-3}
    model = ToxicityModel(weights, float(theta[n]), theta[-4:].reshape(2, 2).copy())
    texts = [*toxic, *clean]
    parts = [model.aggregate(*model.tag(texts[i : i + 256])) for i in range(0, len(texts), 256)]
    model.head = _logistic(np.concatenate(parts), np.arange(len(texts)) < len(toxic))
    if share:  # the sample's mix of toxic and clean documents is not the labels' mix
        model.head[-1] += log(share / (1 - share)) - log(len(toxic) / len(clean))
    return model


def train_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    toxic: int = TOXIC, clean: int = CLEAN,
) -> ToxicityModel | None:
    """Fit on at most ``toxic`` and ``clean`` labelled rows of ``docs``, none of them held out.

    They are drawn by least hash among the labelled rows that ``docs`` has, so rows that an earlier
    stage dropped cost the sample nothing. Null ids and marks aren't drawn; a null text is empty; an
    id that is labelled both ways counts as either. None where there is no toxic row or no trait stands out.
    """
    train = F.col("id").isNotNull() & (fold("id") != 2)
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text")).where(train)
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(train & F.col("y").isin(0, 1)).distinct()
    marks = base.select("id").distinct().join(marks, "id")
    chosen = _drawn(marks.where("y = 1"), toxic, 3).unionByName(_drawn(marks.where("y = 0"), clean, 4))
    got = base.join(F.broadcast(chosen), "id").select("text", "y", F.xxhash64("id", "y").alias("order"))
    share = marks.agg(F.avg("y")).first()[0]

    def run(rows):
        rows = sorted(((order, text, y) for text, y, order in rows), key=lambda r: r[:2])
        return fit([t for _, t, y in rows if y == 1][:toxic], [t for _, t, y in rows if y == 0][:clean], share)

    return fitted_in_task(got, run)


def score_toxicity(
    docs: DataFrame, fitted: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, with_spans: bool = True
) -> DataFrame:
    """(id_col, held_out, score, predicted[, spans]) of each row's whole text.

    spans: array of (start, end, probability) in characters. Null texts count as empty: score 0 and
    no spans; so do all texts where nothing could be learnt. A null id is held out. Other columns
    are ignored; repeated rows are scored alike; no rows give no rows.
    """
    slim = docs.select(
        F.col(id_col).alias("id"), F.coalesce(fold(id_col) == 2, F.lit(True)).alias("held_out"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
    )
    kind = slim.schema["id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))
    names = ["id", "held_out", "score", "predicted"] + ["spans"] * with_spans

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(2).to_pylist()
                scores, found = np.zeros(len(texts)), [[] for _ in texts]
                if fitted is not None:
                    p, bounds = fitted.tag(texts)
                    scores = fitted.document_scores(p, bounds)
                    for i in np.unique(np.searchsorted(bounds, np.flatnonzero(p >= SPAN), side="right") - 1) if with_spans else ():
                        spans = fitted.spans(texts[i].decode("utf-8", "replace"), p[bounds[i] : bounds[i + 1]])
                        found[i] = [dict(zip(("start", "end", "probability"), s, strict=True)) for s in spans]
                out = [part.column(0), part.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))]
                yield pa.record_batch(out + ([pa.array(found, span)] if with_spans else []), names=names)

    schema = f"id {kind}, held_out boolean, score double, predicted int"
    schema += ", spans array<struct<start: int, end: int, probability: double>>" * with_spans
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, columns as they are, whose text scores under ``threshold``; all of them where
    nothing could be learnt. Null and empty texts score 0 and stay; repeated rows are scored alike
    and stay or go together; other columns may have any names; an empty table gives no rows.
    """
    fitted = train_toxicity(docs, labels, id_col, text_col)
    if fitted is None:
        return docs
    return keep_scored(docs, fitted.score, text_col, lambda s: s < threshold)
