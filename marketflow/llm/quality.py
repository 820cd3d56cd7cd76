"""Quality scores by positive-unlabelled learning with the non-negative risk."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from marketflow.llm.common import crc_of_id

SHAPES = 192
#: Characters whose words are counted at once.
CHUNK = 1 << 20

# Byte classes: a letter (or any byte beyond ASCII), a capital, a digit, otherwise the byte itself.
_CLASS = bytes(
    ord("a") if 97 <= b <= 122 or b >= 128 else ord("A") if 65 <= b <= 90 else ord("0") if 48 <= b <= 57 else b for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)
_LETTER, _CAPITAL, _DIGIT = (bytes(b for b in range(256) if _CLASS[b] == ord(c)) for c in "aA0")
_BLANK = b" \t\n\r\x0b\x0c"


@lru_cache(maxsize=100_000)
def _shape_bin(shape: bytes) -> int:
    return zlib.crc32(shape) % SHAPES


def features(text: str) -> np.ndarray:
    """Numbers that describe a whole text: shares of character classes, repetition, lengths, word shapes.

    A word's shape is its sequence of character classes without repeats, so that
    ``Word,`` is ``Aa,``. Shapes are hashed to SHAPES bins.
    """
    shapes = np.zeros(SHAPES)
    words: Counter = Counter()
    n_words = repeated = length = 0
    raw = text.encode("utf-8", "surrogatepass")
    at, last = 0, b""
    while at < len(raw):
        end = min(len(raw), at + CHUNK)
        while end < len(raw) and raw[end] not in _BLANK:
            end += 1
        part = raw[at:end]
        own = part.split()
        n_words += len(own)
        length += sum(map(len, own))
        words.update(own)
        repeated += sum(map(bytes.__eq__, own, [last, *own[:-1]]))
        last = own[-1] if own else last
        for shape, k in Counter(_RUN.sub(rb"\1", part.translate(_CLASS)).split()).items():
            shapes[_shape_bin(shape[:32])] += k
        at = end
    n, w = max(len(raw), 1), max(n_words, 1)
    letters, capitals, digits = (len(raw) - len(raw.translate(None, x)) for x in (_LETTER, _CAPITAL, _DIGIT))
    blanks = len(raw) - len(raw.translate(None, _BLANK))
    lines = raw.split(b"\n")
    most = max(words.values(), default=0)
    basic = [
        np.log1p(len(raw)),
        np.log1p(n_words),
        (letters + capitals) / n,
        capitals / max(letters + capitals, 1),
        digits / n,
        blanks / n,
        (len(raw) - letters - capitals - digits - blanks) / n,
        length / w,
        len(words) / w,
        np.log1p(len(words)) / np.log1p(w),
        most / w,
        repeated / w,
        np.log1p(len(lines)),
        len(set(lines)) / len(lines),
        np.log1p(w / len(lines)),
        (raw.count(b".") + raw.count(b"?") + raw.count(b"!")) / w,
        raw.count(b",") / w,
        float(n_words == 0),
    ]
    return np.concatenate([basic, np.sqrt(shapes / w)]).astype(np.float32)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    prior: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.raw(x).astype(np.float64) + self.shift)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 600, rate: float = 0.03, decay: float = 1e-3) -> Model:
    """A linear scorer of least non-negative risk, with the logistic loss.

    The risk is prior * P+ + max(0, U- - prior * P-): the losses of positives
    taken as such, and of unlabelled rows taken as negative, less what the
    positives among them add. Where the second part is below 0, only it is raised
    again, which keeps the scorer from fitting the positives by heart.
    """
    both = np.concatenate([positive, unlabelled])
    mean, scale = both.mean(0), both.std(0) + 1e-3
    p, u = (np.clip((x - mean) / scale, -8, 8).astype(np.float64) for x in (positive, unlabelled))
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        zp, zu = p @ w + b, u @ w + b
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp, gu = prior * _sigmoid(zp) / len(p), _sigmoid(zu) / len(u)  # of the negative part
        gpos = -prior * _sigmoid(-zp) / len(p)
        if negative >= 0:
            dp, du = gpos - gp, gu
        else:
            dp, du = gp, -gu
        grad = np.append(p.T @ dp + u.T @ du + decay * w, dp.sum() + du.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(mean, scale, w.astype(np.float32), float(b), 1.0, 0.0, prior)


def calibrate(model: Model, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Model:
    """Slope and shift that make the scores fit the trusted labels; unchanged without both kinds of them."""
    if len(set(y.tolist())) < 2:
        return model
    z = model.raw(x).astype(np.float64)
    size = z.std() + 1e-9
    a, c = 1.0 / size, 0.0
    for _ in range(100):  # Newton's steps, with a slight pull to 0
        q = _sigmoid(a * z + c)
        e, d = weight * (q - y), weight * q * (1 - q)
        g = np.array([(e * z).sum() + 1e-6 * a * size**2, e.sum()])
        h = np.array([[(d * z * z).sum() + 1e-6 * size**2, (d * z).sum()], [(d * z).sum(), d.sum()]]) + 1e-9 * np.eye(2)
        step = np.linalg.solve(h, g)
        k = max(1.0, float(np.abs(step * [size, 1]).max()))
        a, c = a - step[0] / k, c - step[1] / k
    if a > 0:
        model.slope, model.shift = float(a), float(c)
    return model


def held_out() -> Column:
    """Whether a row's label is kept from learning: crc32 of its id mod 5 is 0. Not so for a null id."""
    return F.coalesce(F.pmod(crc_of_id("doc_id"), F.lit(5)) == 0, F.lit(False))


def _measured(texts: DataFrame) -> list:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([features(t.as_py() or "").tobytes() for t in batch.column(1)], pa.binary())], names=["kind", "x"]
            )

    return texts.select(F.col("kind").cast("int"), "text").mapInArrow(run, "kind int, x binary").collect()


def train(docs: DataFrame, labels: DataFrame, usable: Column, sample: int = 4000) -> Model | None:
    """Fit on at most ``sample`` positives, as many negatives and twice as many unlabelled rows.

    All are the rows of least id hash among those where ``usable`` holds; only
    their features (about 1 KB a row) come to the driver. The class prior is the
    share of label 1 among trusted labels, smoothed by one row of each kind; if
    all are positive, one half. The positives and the unlabelled rows make the
    scorer. The labels of both kinds only set the prior and the scale of the
    scores. Ids with contradicting labels count as unlabelled. None without
    positives.
    """
    known = labels.filter("quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("r")).filter("q = r").select("doc_id", "q")
    known = known.filter(usable)
    counts = {r["q"]: r["n"] for r in known.groupBy("q").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(1):
        return None
    prior = (counts[1] + 1) / (counts[1] + counts[0] + 2) if counts.get(0) else 0.5
    by_hash = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    free = by_hash(docs.select("doc_id").filter(usable), 2 * sample)
    chosen = by_hash(known.filter("q = 1"), sample).select("doc_id", F.lit(1).alias("kind")).union(by_hash(known.filter("q = 0"), sample).select("doc_id", F.lit(0).alias("kind"))).union(free.select("doc_id", F.lit(2).alias("kind")).distinct())
    rows = _measured(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))  # at most 4 * sample rows of ids
    rows = sorted((r["kind"], bytes(r["x"])) for r in rows)  # the same sums in every run
    by_kind = {k: np.array([np.frombuffer(x, np.float32) for kind, x in rows if kind == k][: 2 * sample]) for k in (0, 1, 2)}
    if not len(by_kind[1]) or not len(by_kind[2]):
        return None
    model = fit(by_kind[1], by_kind[2], prior)
    if len(by_kind[0]):
        x = np.concatenate([by_kind[1], by_kind[0]])
        y = np.repeat([1.0, 0.0], [len(by_kind[1]), len(by_kind[0])])
        # both kinds in their true proportion
        model = calibrate(model, x, y, np.where(y == 1, prior / len(by_kind[1]), (1 - prior) / len(by_kind[0])))
    return model


def score(docs: DataFrame, model: Model | None, keep: list[Column], text: str = "text") -> DataFrame:
    """``keep`` and the quality score of each whole text; 0.5 if there was nothing to learn from. Null text: empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*keep, F.col(text).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                if m is None:
                    got = np.full(part.num_rows, 0.5)
                else:
                    got = m.scores(np.array([features(t.as_py() or "") for t in part.column(part.num_columns - 1)])).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(got, pa.float64())], names=[*part.schema.names[:-1], "score"])

    return source.mapInArrow(run, StructType([*source.schema.fields[:-1], StructField("score", DoubleType())]))


def quality(docs: DataFrame, labels: DataFrame, sample: int = 4000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Learns from labels of documents that aren't held out (nor have a null id).
    Repeated rows come out as often as they came in; an empty table gives no rows.
    """
    model = train(docs, labels, F.col("doc_id").isNotNull() & ~held_out(), sample)
    found = score(docs, model, [F.col("doc_id")])
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
