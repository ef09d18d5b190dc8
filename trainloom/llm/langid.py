"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Weights are trained with follow-the-regularised-leader (FTRL-proximal) under an
elastic-net penalty; a temperature fitted on rows kept out of training calibrates
the probabilities.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, ORDERS = 1 << 16, (1, 2, 3)
_ALPHA: list[np.ndarray] = []
_SPACE = np.uint32(32)


def _letters() -> np.ndarray:
    """Flag by code point: is it a letter?"""
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _ALPHA[0]


def counts(text: str | None) -> np.ndarray | None:
    """Hashed character n-gram counts of the whole text in lower case; None without a letter.

    Everything but letters is one space between words.
    """
    if not text:
        return None
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, _SPACE)
    codes = codes[letter | np.concatenate(([True], letter[:-1]))]
    codes = np.concatenate(([_SPACE], codes, [_SPACE]))
    out = np.zeros(BUCKETS, np.int64)
    for n in ORDERS:
        h = np.full(max(0, len(codes) - n + 1), np.uint32(0x9E3779B1 * n & 0xFFFFFFFF), np.uint32)
        for i in range(n):
            h = (h ^ codes[i:len(codes) - n + 1 + i].astype(np.uint32)) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(15)
        out += np.bincount(h >> np.uint32(16), minlength=BUCKETS)
    return out


def weigh(buckets: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit-length TF-IDF values with logarithmic term frequency."""
    x = (1.0 + np.log(n)) * idf[buckets]
    return x / np.sqrt((x * x).sum())


class Ftrl:
    """Multinomial logistic regression; a weight is zero until its gradients pass ``l1``."""

    def __init__(self, classes: int, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 1e-3):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((BUCKETS, classes)), np.zeros((BUCKETS, classes))
        self.bias_z, self.bias_n = np.zeros(classes), np.zeros(classes)

    def _weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def step(self, buckets: np.ndarray, x: np.ndarray, label: int) -> None:
        z, n = self.z[buckets], self.n[buckets]
        w, b = self._weights(z, n), self._weights(self.bias_z, self.bias_n)
        g = softmax(x @ w + b)
        g[label] -= 1.0
        self.z[buckets], self.n[buckets] = self._moved(z, n, w, x[:, None] * g)
        self.bias_z, self.bias_n = self._moved(self.bias_z, self.bias_n, b, g)

    def _moved(self, z, n, w, g):
        after = n + g * g
        return z + g - (np.sqrt(after) - np.sqrt(n)) / self.alpha * w, after

    def weights(self) -> tuple[np.ndarray, np.ndarray]:
        return self._weights(self.z, self.n), self._weights(self.bias_z, self.bias_n)


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least negative log-likelihood on calibration rows."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.02), np.log(20.0), 200))
    rows = np.arange(len(labels))
    loss = [-np.log(np.maximum(softmax(scores / t)[rows, labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        c = counts(text) if self.languages else None
        if c is None:
            return "und", 0.0
        buckets = np.flatnonzero(c)
        p = softmax((weigh(buckets, c[buckets], self.idf) @ self.weights[buckets] + self.bias) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per bucket and task: documents of the task that hold the bucket."""
    df, docs = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column(0):
            c = counts(text.as_py())
            if c is not None:
                df += c > 0
                docs += 1
    held = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(held, -1), pa.int32()), pa.array(np.append(df[held], docs), pa.int64())], ["bucket", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, buckets, numbers = [], [], []
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            c = counts(text.as_py())
            if c is not None:
                held = np.flatnonzero(c)
                langs.append(lang)
                buckets.append(held.astype(np.int32))
                numbers.append(c[held].astype(np.int32))
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(buckets, pa.list_(pa.int32())), pa.array(numbers, pa.list_(pa.int32()))],
                                         ["lang", "buckets", "n"])


def train(df: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", max_rows: int = 2_400, epochs: int = 4,
          seed: int = 11) -> Model:
    """Fit on the rows of ``df`` with a language.

    Document frequencies cover all of them (summed per task, then per bucket).
    The weights are fitted on a sample of about ``max_rows`` rows, the same
    number of each language, chosen by a hash of the id; a fifth of it fits the
    temperature.
    """
    labelled = df.where(df[lang_col].isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    share = max(20, max_rows // len(languages))
    rate = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, share / n))) for k, n in sizes.items()])
    draw = (F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(1 << 20)) + 0.5) / float(1 << 20)
    sample = labelled.where(draw < rate).select("lang", "text").mapInArrow(_features, "lang string, buckets array<int>, n array<int>").toArrow()
    sums = labelled.select("text").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows
    frequency = np.zeros(BUCKETS)
    held = sums["bucket"].to_numpy()
    frequency[held[held >= 0]] = sums["n"].to_numpy()[held >= 0]
    docs = max(1, int(sums["n"].to_numpy()[held < 0].sum()))
    idf = np.log((1.0 + docs) / (1.0 + frequency)) + 1.0
    labels = np.array([languages.index(k) for k in sample["lang"].to_pylist()], np.int64)
    rows = [(b.values.to_numpy(), n.values.to_numpy()) for b, n in zip(sample["buckets"], sample["n"])]
    rows = [(b, weigh(b, n, idf)) for b, n in rows]
    # Sorted by content first: the order of arrival differs from run to run.
    by_content = sorted(range(len(rows)), key=lambda i: (labels[i], len(rows[i][0]), rows[i][0].tobytes(), rows[i][1].tobytes()))
    order = np.array(by_content, np.int64)[np.random.default_rng(seed).permutation(len(rows))] if rows else np.empty(0, np.int64)
    kept, fit = order[:len(order) // 5], order[len(order) // 5:]
    learner = Ftrl(len(languages))
    for epoch in range(epochs):
        for i in np.random.default_rng(seed + epoch).permutation(fit):
            learner.step(*rows[i], labels[i])
    weights, bias = learner.weights()
    scores = np.array([rows[i][1] @ weights[rows[i][0]] + bias for i in kept]).reshape(len(kept), len(languages))
    return Model(languages, idf, weights.astype(np.float32), bias, temperature(scores, labels[kept]))


def _predict(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        guesses = [model.predict(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g[0] for g in guesses], pa.string()),
                                          pa.array([g[1] for g in guesses], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])


def predict(df: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, lang_pred, score (calibrated probability) for every row.

    Only the text is an input. A null, empty or letterless text gives ``und``
    with score 0, and so does every text if no language was learned. Repeated
    rows and null ids give one row each; other columns are not read. The model
    is broadcast; its size is fixed by ``BUCKETS`` and the number of languages.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(df[id_col].cast("long").alias("doc_id"), held_out.alias("held_out"), df[text_col].cast("string").alias("text"))
    return rows.mapInArrow(partial(_predict, shared=shared), "doc_id long, held_out boolean, lang_pred string, score double")
