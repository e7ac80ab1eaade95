"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts become counts of hashed character 1- to 3-grams, weighted by log(1 + tf) and
the inverse document frequency over all training documents, at unit length. The
weights are trained with follow-the-regularised-leader and elastic-net penalties,
which leaves most of them zero; a temperature fitted on rows that took no part in
training calibrates the scores.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; without
training rows every text is; rows without a language don't train; repeated rows are
predicted alike, one row each; whole texts are read, however long.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hubcast.llm import common

BITS = 16
DIM = 1 << BITS
NOT_LETTERS = re.compile(r"[\W\d_]+")
MIX = np.uint32(0x9E3779B1)
PIECE = 1 << 16  # characters looked at in one go; longer texts are counted piece by piece


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """Counts (DIM) of the hashed 1- to 3-grams of the lower-cased letters of a text."""
    counts = np.zeros(DIM, np.int64)
    letters = " " + NOT_LETTERS.sub(" ", text.lower()).strip() + " "
    for at in range(0, max(1, len(letters) - 2), PIECE):
        # a piece overlaps the next by two characters; the grams that start in it are counted
        c = np.frombuffer(letters[at:at + PIECE + 2].encode("utf-32-le"), np.uint32)
        h = np.zeros(len(c), np.uint32)
        for n in range(3):
            own = min(PIECE, len(c) - n)
            if own <= 0:
                break
            h = (h[:len(c) - n] ^ c[n:]) * MIX
            h ^= h >> np.uint32(15)
            counts += np.bincount(h[:own] >> np.uint32(32 - BITS), minlength=DIM)
    return counts


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each hashed n-gram, and their number, over all of ``docs``.

    A task sends one sum per n-gram class; the result has DIM rows at any size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(DIM + 1, np.int64)
        for b in batches:
            for t in b.column(0).to_pylist():
                if has_letter(t):
                    df[:DIM] += gram_counts(t) > 0
                    df[DIM] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["gram", "n"])

    got = docs.select("text").mapInArrow(run, "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(DIM + 1, np.int64)
    df[got["gram"].to_numpy(int)] = got["n"].to_numpy(np.int64)
    return df[:DIM], int(df[DIM])


class LanguageModel:
    """Weights (DIM x languages), bias, idf and temperature."""

    def __init__(self, langs: list[str], idf: np.ndarray):
        self.langs, self.idf = langs, idf
        self.weights = np.zeros((DIM, len(langs)))
        self.bias = np.zeros(len(langs))
        self.temperature = 1.0

    def features(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(counts)
        v = np.log1p(counts[at]) * self.idf[at]
        return at, v / max(float(np.sqrt(v @ v)), 1e-12)

    def logits(self, text: str) -> np.ndarray:
        at, v = self.features(gram_counts(text))
        return v @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not has_letter(text):
            return "und", 0.0
        p = softmax(self.logits(text) / self.temperature)
        best = int(np.argmax(p))
        return self.langs[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], model: LanguageModel, epochs: int = 4, alpha: float = 1.0,
          beta: float = 1.0, l1: float = 0.02, l2: float = 0.01) -> None:
    """FTRL-proximal with per-coordinate rates; ``rows`` are (n-grams, values, language number)."""
    k = len(model.langs)
    z, n, one_hot = np.zeros((DIM + 1, k)), np.zeros((DIM + 1, k)), np.eye(k)

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        small = np.abs(zs) <= l1
        w = -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(small, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, v, y = rows[i]
            at, v = np.append(at, DIM), np.append(v, 1.0)  # the last coordinate is the bias
            w = weights(at)
            g = v[:, None] * (softmax(v @ w) - one_hot[y])
            grown = n[at] + g * g
            z[at] += g - (np.sqrt(grown) - np.sqrt(n[at])) / alpha * w
            n[at] = grown
    full = weights(np.arange(DIM + 1))
    model.weights, model.bias = full[:DIM], full[DIM]


def calibrate(rows: list[tuple[np.ndarray, np.ndarray, int]], model: LanguageModel) -> None:
    """The temperature with the least log loss on ``rows``, by golden-section search on its logarithm."""
    if not rows:
        return
    z = np.array([v @ model.weights[at] + model.bias for at, v, _ in rows])
    y = np.array([r[2] for r in rows])

    def loss(t: float) -> float:
        return -float(np.log(softmax(z / np.exp(t))[np.arange(len(y)), y] + 1e-12).mean())

    lo, hi, g = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    model.temperature = float(np.exp((lo + hi) / 2))


def fit(docs: DataFrame, max_rows: int = 4000, **settings) -> LanguageModel:
    """Fits on ``docs`` (doc_id, text, lang): document frequencies from all rows, weights
    from the ``max_rows`` rows with the lowest hash of doc_id, every fifth of which is
    left out of the training and used for the temperature."""
    docs = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    df, total = document_frequency(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, t, lang in zip(*(b.column(c).to_pylist() for c in ("h", "text", "lang"))):
                if has_letter(t):
                    counts = gram_counts(t)
                    at = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([h]), pa.array([lang]), pa.array([at.astype("<u2").tobytes()]),
                         pa.array([np.minimum(counts[at], 65535).astype("<u2").tobytes()])],
                        names=["h", "lang", "grams", "counts"])

    hashed = docs.withColumn("h", F.xxhash64("doc_id"))
    chosen = hashed.select("h", "doc_id").distinct().orderBy("h", "doc_id").limit(max_rows)  # a bounded table
    sample = hashed.join(F.broadcast(chosen.select(F.col("h").alias("of"))), F.col("h") == F.col("of"), "left_semi")
    rows = sorted(sample.select("h", "text", "lang").mapInArrow(run, "h bigint, lang string, grams binary, counts binary")
                  .collect())[:max_rows]
    model = LanguageModel(sorted({r["lang"] for r in rows}), np.log((1 + total) / (1 + df)) + 1.0)
    if not rows:
        return model
    made = []
    for r in rows:
        counts = np.zeros(DIM, np.int64)
        counts[np.frombuffer(r["grams"], "<u2")] = np.frombuffer(r["counts"], "<u2")
        made.append((*model.features(counts), model.langs.index(r["lang"])))
    train([x for i, x in enumerate(made) if i % 5], model, **settings)
    calibrate(made[::5], model)
    return model


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score for every row of ``docs``; the sparse model (under 4 MB) goes with the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            got = [m.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, lang_pred string, score double")
