"""Quality classifier by positive-unlabelled learning with the non-negative risk (Kiryo et al., 2017).

Trusted positives and unlabelled web text train a linear model on the text's character make-up; no
negative label is ever read. The class prior comes from the best-bin estimate of Garg et al. (2021):
the least ratio of unlabelled to positive mass above a threshold of a held-back half.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandweave.llm.common import fitted_in_task

#: Bounds of the training sample, in rows, whatever the length of their texts. The risk is a mean over
#: the sample: at 12,000 unlabelled rows its standard error is under 1/100 of the loss's spread at
#: any size of the corpus, and the prior's slack, which the estimate allows for, is 0.012.
POSITIVES, UNLABELLED = 4000, 12_000
STEPS, RATE, DECAY = 400, 0.05, 1e-3
THRESHOLD = 0.7

# Classes of bytes: every ASCII sign its own, letters and digits by kind, all of UTF-8's high bytes one.
_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[ord("a") : ord("z") + 1] = 1
_CLASS[ord("A") : ord("Z") + 1] = 2
_CLASS[ord("0") : ord("9") + 1] = 3
_CLASS[128:] = 4
_CLASS[32] = 5
_CLASS[10] = 6
for _i, _b in enumerate(_SIGNS):
    _CLASS[_b] = 7 + _i
_KINDS = 7 + len(_SIGNS)
WIDTH = _KINDS * _KINDS + _KINDS + 5
#: Bytes whose classes are looked up at once; bounds the memory of very long texts.
CHUNK = 1 << 20
#: A text of so many characters is trusted half; a shorter one is taken nearer to the prior.
PSEUDO = 24.0


def features(text: bytes) -> np.ndarray:
    """Square roots of class-pair and class frequencies, word length, repetition of words and lines;
    last how far the text is to be trusted (0 for an empty text)."""
    out = np.zeros(WIDTH + 1, dtype=np.float32)
    if not text:
        return out
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    pairs = _KINDS * _KINDS
    for i in range(0, n, CHUNK):  # with one byte of the chunk before, so that no pair is lost
        kinds = _CLASS[data[max(0, i - 1) : i + CHUNK]]
        out[:pairs] += np.bincount(kinds[:-1] * _KINDS + kinds[1:], minlength=pairs)
    out[pairs : pairs + _KINDS] = np.bincount(_CLASS, np.bincount(data, minlength=256), _KINDS)
    np.sqrt(out / n, out=out)
    lines = [x for x in text.split(b"\n") if x]
    words = text.split()
    spaces = n - sum(map(len, words))
    out[-6:] = (
        min(4.0, (n - spaces) / (len(words) + 1) / 8),
        1 - len(set(lines)) / len(lines) if lines else 0,
        min(1.0, max(map(len, lines), default=0) / 2000),
        spaces / n,
        4 * sum(map(eq, words, words[1:])) / (len(words) + 1),
        n / (n + PSEUDO),
    )
    return out


@dataclass
class QualityModel:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    prior: float

    def score(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        x = np.stack([features(t) for t in texts])
        trust = x[:, -1]
        # the less a text has to tell by, the nearer it is to what is known without reading it
        return _sigmoid(_toward(x, self.mean) @ self.weights + trust * self.bias + (1 - trust) * np.log(self.prior / (1 - self.prior)))


def _toward(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Differences from the average text, shrunk by each text's trust."""
    return (x[:, :-1] - mean) * x[:, -1:]


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _train(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Adam on the non-negative risk with logistic loss; inputs, centred, are scaled by their spread.

    Risk: prior*E_p[l(+)] + max(0, E_u[l(-)] - prior*E_p[l(-)]); where the second part would turn
    negative its gradient is reversed, as the method asks.
    """
    n = len(pos) + len(unl)
    center = (pos.sum(0, dtype=np.float64) + unl.sum(0, dtype=np.float64)) / n
    square = np.einsum("ij,ij->j", pos, pos, dtype=np.float64) + np.einsum("ij,ij->j", unl, unl, dtype=np.float64)
    spread = np.sqrt(np.maximum(square / n - center**2, 0)) + 0.02
    w = np.zeros(pos.shape[1])
    b = float(np.log(prior / (1 - prior)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    # weights are scaled instead of the rows, which are many
    over = lambda rows: rows @ (w / spread).astype(rows.dtype) + b
    for step in range(1, steps + 1):
        zp, zu = over(pos).astype(np.float64), over(unl).astype(np.float64)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp_plus = (_sigmoid(zp) - 1) * prior / len(pos)
        gp_minus, gu_minus = -prior * _sigmoid(zp) / len(pos), _sigmoid(zu) / len(unl)
        if negative >= 0:
            gp, gu = gp_plus + gp_minus, gu_minus
        else:
            gp, gu = -gp_minus, -gu_minus
        slope = gp.astype(pos.dtype) @ pos + gu.astype(unl.dtype) @ unl
        grad = np.append(slope / spread + DECAY * w, gp.sum() + gu.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w / spread, float(b)


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """Share of positives among the unlabelled, by the best bin of a held-back half's scores."""
    w, b = _train(pos[::2], unl[::2], 0.5, 150)
    sp, su = np.sort(pos[1::2] @ w + b), np.sort(unl[1::2] @ w + b)
    if not len(sp) or not len(su):
        return 0.5
    cuts = sp[: max(1, len(sp) * 9 // 10)]
    above_p = 1 - np.searchsorted(sp, cuts) / len(sp)
    above_u = 1 - np.searchsorted(su, cuts) / len(su)
    slack = np.sqrt(np.log(40) / 2 / len(sp)) + np.sqrt(np.log(40) / 2 / len(su))
    best = np.argmin((above_u + slack) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.97))


def fold(id_col: str = "doc_id"):
    """crc32 of the id's text modulo 4; rows with 2 are held out of training."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def _drawn(ids: DataFrame, rows: int, seed: int) -> DataFrame:
    """A bounded sample that is the same however the rows are laid out: the least hashes."""
    return ids.orderBy(F.xxhash64(F.col("id"), F.lit(seed)), "id").limit(rows)


def train_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> QualityModel | None:
    """Fit on at most ``positives`` trusted rows and ``unlabelled`` others, none of them held out.

    None where there is no trusted positive or no other text; scores are then 0.5.
    """
    train = F.col("id").isNotNull() & (fold("id") != 2)
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text")).where(train)
    trusted = labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("id")).where(train).distinct()
    trusted = base.select("id").distinct().join(trusted, "id")  # rows that an earlier stage dropped cost the sample nothing
    # both samples are at most some thousand ids, so they may be broadcast
    chosen = _drawn(trusted, positives, 1).withColumn("kind", F.lit(1)).unionByName(
        _drawn(base.select("id"), unlabelled, 2).withColumn("kind", F.lit(0))
    )

    def run(batches):
        for batch in batches:
            rows = [features(x).tobytes() for x in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(rows, pa.binary()), batch.column(1), batch.column(2)], names=["x", "kind", "order"])

    joined = base.join(F.broadcast(chosen), "id").select("text", "kind", F.xxhash64("id", "kind").alias("order"))
    return fitted_in_task(joined.mapInArrow(run, "x binary, kind int, order long"), lambda rows: fit(rows, positives, unlabelled))


def fit(rows: list[tuple[bytes, int, int]], positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> QualityModel | None:
    """The model of rows of (features, 1 for trusted or 0, order)."""
    rows = sorted(((order, x, kind) for x, kind, order in rows), key=lambda r: r[:2])
    kind = np.array([r[2] for r in rows], np.int64)
    x = np.empty((len(rows), WIDTH + 1), np.float32)
    for i, r in enumerate(rows):
        x[i] = np.frombuffer(r[1], np.float32)
    del rows
    trust = x[:, -1:].copy()
    mean = np.average(x[:, :-1], axis=0, weights=trust[:, 0].astype(np.float64) + 1e-9)
    x = x[:, :-1]
    x -= mean.astype(np.float32)
    x *= trust
    pos, unl = x[kind == 1][:positives], x[kind == 0][:unlabelled]
    del x
    if len(pos) < 2 or len(unl) < 2:
        return None
    prior = estimate_prior(pos, unl)
    weights, bias = _train(pos, unl, prior)
    return QualityModel(weights, bias, mean, prior)


def score_quality(docs: DataFrame, fitted: QualityModel | None, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id_col, held_out, score, predicted) of each row's whole text; null counts as empty.

    An empty text scores the class prior, short ones near it. A null id is held out (null fold).
    Other columns are ignored; repeated rows are scored alike; no rows give no rows.
    """
    slim = docs.select(
        F.col(id_col).alias("id"), F.coalesce(fold(id_col) == 2, F.lit(True)).alias("held_out"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"),
    )

    def run(batches):
        for batch in batches:
            texts = batch.column(2).to_pylist()
            scores = [np.full(len(texts), 0.5)] if fitted is None else [fitted.score(texts[i : i + 256]) for i in range(0, len(texts), 256)]
            scores = np.concatenate([np.empty(0), *scores])
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))],
                names=["id", "held_out", "score", "predicted"],
            )

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int").withColumnRenamed("id", id_col)


def keep_scored(docs: DataFrame, score, text_col: str, keep) -> DataFrame:
    """Rows of ``docs``, columns as they are, for whose text ``keep(score(texts))`` is true."""
    where = docs.columns.index(text_col)
    schema = T.StructType(docs.schema.fields)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [(x or "").encode() for x in part.column(where).to_pylist()]
                yield part.filter(pa.array(keep(np.asarray(score(texts)))))

    return docs.mapInArrow(run, schema)


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, columns as they are, whose text scores at least ``threshold``; all of them
    where nothing can be learnt. Null counts as empty, which scores the class prior; repeated rows
    are scored alike and stay or go together; other columns may have any names; no rows give no rows.
    """
    fitted = train_quality(docs, labels, id_col, text_col)
    if fitted is None:
        return docs
    return keep_scored(docs, fitted.score, text_col, lambda s: s >= threshold)
