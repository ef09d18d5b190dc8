"""Toxicity by non-negative positive-unlabelled (nnPU) learning.

Classifiers are trained in numpy from confirmed toxic examples and unlabelled
text. With class prior p, the risk is ``p * R_pos(+) + max(0, R_unl(-) - p * R_pos(-))``:
the unlabelled risk is corrected by the prior, and when the corrected part falls
below zero the step goes the other way, which keeps it from being overfitted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainloom.llm.common import remainder

_WORD = re.compile(r"[^\W\d_]+")
THRESHOLD = 0.3
STEMS = (4, 6)


def words(text: str | None) -> set[str]:
    """Features of the whole text: distinct words (runs of letters in lower case) and their first
    ``STEMS`` letters, marked by ``^``, which inflected forms have in common."""
    found = set(_WORD.findall((text or "").lower()))
    return found.union(*[{"^" + w[:n] for w in found if len(w) > n} for n in STEMS])


def sigmoid(x):
    return 0.5 * (1.0 + np.tanh(0.5 * np.asarray(x, float)))


def hashed(features: set[str]) -> np.ndarray:
    return np.sort(np.fromiter(map(xxhash.xxh64_intdigest, features), np.uint64, len(features)))


def _compared(positive: list[np.ndarray], unlabelled: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features seen ``least`` times, toxic examples that hold each, and by how many deviations its share there is larger."""
    n, m = max(1, len(positive)), max(1, len(unlabelled))
    names, counts = np.unique(np.concatenate([*positive, *unlabelled]), return_counts=True)
    names = names[counts >= least]
    p, u = (np.zeros(len(names)), np.zeros(len(names)))
    for rows, into in ((positive, p), (unlabelled, u)):
        found, number = np.unique(np.concatenate(rows), return_counts=True)
        common = np.isin(found, names, assume_unique=True)
        into[np.searchsorted(names, found[common])] = number[common]
    pool = (p + u) / (n + m)
    return names, p, (p / n - u / m) / np.sqrt(pool * (1 - pool) * (1 / n + 1 / m) + 1e-12)


def vocabulary(positive: list[np.ndarray], unlabelled: list[np.ndarray], least: int, z: float, most: int) -> np.ndarray:
    """Sorted hashes of the features whose share among toxic examples differs from that in unlabelled text by ``z`` deviations.

    Rows without any feature that tells toxic text are then compared among themselves,
    round by round, so that a kind of toxicity with few examples (a rare language, say)
    is not measured against all the others; features of these rounds are in ``least`` toxic examples.
    """
    names, p, score = _compared(positive, unlabelled, least)
    telling = np.flatnonzero(np.abs(score) >= z)
    chosen = names[telling[np.lexsort((names[telling], -np.abs(score[telling])))]]
    toxic = names[score >= z]
    while len(toxic) and len(chosen) < most:
        positive, unlabelled = ([s for s in rows if not np.isin(s, toxic).any()] for rows in (positive, unlabelled))
        if len(positive) < least or not unlabelled:
            break
        names, p, score = _compared(positive, unlabelled, least)
        telling = np.flatnonzero((score >= z) & (p >= least))
        toxic = names[telling[np.lexsort((names[telling], -score[telling]))]]
        chosen = np.concatenate([chosen, toxic[~np.isin(toxic, chosen)]])
    return np.sort(chosen[:most])


def nnpu(x_pos: np.ndarray, x_unl: np.ndarray, prior: float, seed: int, steps: int = 1_500, batch: int = 512, rate: float = 0.05,
         l1: float = 1e-3, keep: float = 0.4) -> tuple[np.ndarray, float]:
    """Linear classifier under the logistic loss, by Adam on mini-batches.

    Each step sees a random share ``keep`` of the features of every row, so that
    one telling word alone comes to decide.
    """
    rng = np.random.default_rng(seed)
    w = np.zeros(x_pos.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)

    def drawn(x: np.ndarray) -> np.ndarray:
        rows = x[rng.integers(len(x), size=min(batch, len(x)))]
        return np.column_stack([rows * (rng.random(rows.shape) < keep), np.ones(len(rows))])

    for t in range(1, steps + 1):
        a, b = drawn(x_pos), drawn(x_unl)
        sa, sb = a @ w, b @ w
        negative = np.logaddexp(0, sb).mean() - prior * np.logaddexp(0, sa).mean()
        corrected = b.T @ sigmoid(sb) / len(b) - prior * (a.T @ sigmoid(sa)) / len(a)
        # Below zero only the corrected part counts, with its sign turned.
        g = -prior * (a.T @ sigmoid(-sa)) / len(a) + corrected if negative >= 0 else -corrected
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        now = rate * (1.0 if t < steps * 0.6 else 0.2)
        w = w - now * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w[:-1] = np.sign(w[:-1]) * np.maximum(0.0, np.abs(w[:-1]) - now * l1)
    return w[:-1], float(w[-1])


@dataclass
class Model:
    weights: dict[str, list[float]]  # word -> its weight in each classifier
    biases: list[float]

    def score(self, text: str | None) -> float:
        """Mean probability of the classifiers."""
        found = words(text) & self.weights.keys()
        logits = np.array(self.biases)
        for w in sorted(found):
            logits = logits + self.weights[w]
        return float(sigmoid(logits).mean())


def _hashed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [hashed(words(t.as_py())).tobytes() for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["positive", "features"])


def _names(batches: Iterator[pa.RecordBatch], chosen: frozenset[int]) -> Iterator[pa.RecordBatch]:
    """Features whose hash is chosen, once per task."""
    seen: set[str] = set()
    for batch in batches:
        for t in batch.column(1):
            seen.update(w for w in words(t.as_py()) - seen if xxhash.xxh64_intdigest(w) in chosen)
    yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.string())], ["name"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          max_positive: int = 1_500, max_unlabelled: int = 4_500, least: int = 5, z: float = 7.0, most: int = 5_000,
          classifiers: int = 3, seed: int = 5) -> Model:
    """Fit on toxic examples and unlabelled text of ``docs``; ``labels`` holds the training labels only.

    The prior is the share of toxic rows among all training labels. At most about
    ``max_positive`` toxic and ``max_unlabelled`` other documents (any, whatever
    their label) are gathered, chosen by a hash of the id, as sets of hashed features.
    Without a toxic label, or the text of one, every text scores the same low value.
    """
    clean = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), (F.col(label_col) == 1).alias("toxic")).groupBy("id").agg(F.max("toxic").alias("toxic"))
    total = clean.agg(F.count("*").alias("n"), F.count(F.when(F.col("toxic"), 1)).alias("p")).first()
    if not total["p"] or total["p"] == total["n"]:
        level = (total["p"] + 0.01) / (total["n"] + 1.0)
        return Model({}, [float(np.log(level / (1 - level)))])
    prior = total["p"] / total["n"]
    n_docs = docs.count()

    def drawn(column: str, most: int, there: int, salt: int) -> Column:
        return (F.pmod(F.xxhash64(F.col(column), F.lit(seed + salt)), F.lit(1 << 20)) + 0.5) / float(1 << 20) < most / max(1, there)

    # About max_positive ids: bounded, so their broadcast is too.
    chosen = clean.where(F.col("toxic") & drawn("id", max_positive, total["p"], 0)).select("id")
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].cast("string").alias("text"))
    positive = rows.join(F.broadcast(chosen), "id").select(F.lit(True).alias("positive"), "text")
    unlabelled = rows.where(drawn("id", max_unlabelled, n_docs, 1)).select(F.lit(False).alias("positive"), "text")
    sample = positive.unionByName(unlabelled)
    table = sample.mapInArrow(_hashed_rows, "positive boolean, features binary").toArrow()
    # Copies count once, else the words of a much-copied toxic text would look telling.
    rows = sorted(set(zip(table["positive"].to_pylist(), table["features"].to_pylist())))
    del table
    pos, unl = ([np.frombuffer(f, np.uint64) for p, f in rows if p == kind] for kind in (True, False))
    if not pos or not unl:  # no toxic text to learn from: nothing can be told apart
        level = 0.01 / (total["n"] + 1.0)
        return Model({}, [float(np.log(level / (1 - level)))])
    names = vocabulary(pos, unl, least, z, most)

    def matrix(sets: list[np.ndarray]) -> np.ndarray:
        x = np.zeros((len(sets), len(names)), np.float32)
        for i, s in enumerate(sets):
            x[i, np.searchsorted(names, s[np.isin(s, names)])] = 1.0
        return x

    x_pos, x_unl = matrix(pos), matrix(unl)
    del pos, unl, rows
    fitted = [nnpu(x_pos, x_unl, prior, seed + i) for i in range(classifiers)]
    kept = {int(h): [float(f[0][i]) for f in fitted] for i, h in enumerate(names) if any(f[0][i] for f in fitted)}
    found = sample.mapInArrow(partial(_names, chosen=frozenset(kept)), "name string").distinct().toArrow()  # at most ``most`` names
    return Model({w: kept[xxhash.xxh64_intdigest(w)] for w in found["name"].to_pylist()}, [f[1] for f in fitted])


def fit_outside_fold(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", fold: int = 2, **options) -> Model:
    """``train`` on labels and documents whose crc32(id) mod 4 is not ``fold``."""
    return train(docs.where(remainder(id_col) != fold), labels.where(remainder(id_col) != fold), id_col, **options)


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        scores = [model.score(t.as_py()) for t in batch.column(batch.num_columns - 1)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], [*batch.schema.names[:-1], "score"])


def score(df: DataFrame, model: Model, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row; only the text is an input.

    Null text counts as empty; empty texts score what a text without any telling
    word scores. Repeated rows and null ids give one row each; an empty table
    gives none; other columns are not read.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    rows = df.select(df[id_col].cast("long").alias("doc_id"), held_out.alias("held_out"), df[text_col].cast("string").alias("text"))
    out = rows.mapInArrow(partial(_score, shared=shared), "doc_id long, held_out boolean, score double")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _clean(batches: Iterator[pa.RecordBatch], shared, text_at: int) -> Iterator[pa.RecordBatch]:
    model = shared.value
    for batch in batches:
        mask = [model.score(t.as_py()) < THRESHOLD for t in batch.column(text_at)]
        yield batch.filter(pa.array(mask, pa.bool_()))


def drop_toxic(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``df`` without the rows that score ``THRESHOLD`` or more.

    Null text counts as empty. Ids are not looked at, so null and repeated ones and repeated
    rows are judged one by one; all columns are returned, whatever their names; an empty
    table gives no row.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    return df.mapInArrow(partial(_clean, shared=shared, text_at=df.columns.index(text_col)), df.schema)
