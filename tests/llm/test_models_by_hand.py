"""Language and toxicity models recomputed from their weights in plain Python, and one training step of each."""

import collections
import math

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SF
from trainloom.llm import langid, toxicity
from trainloom.llm.queries import held_out

MASK = 0xFFFFFFFF


def ngrams(text):
    """Hashed 1- to 3-grams of a text's letters, words parted by one space."""
    letters = [c if c.isalpha() else " " for c in text.lower()]
    kept = [c for i, c in enumerate(letters) if c != " " or i == 0 or letters[i - 1] != " "]
    padded = [" ", *kept, " "]
    out = collections.Counter()
    for n in (1, 2, 3):
        for i in range(len(padded) - n + 1):
            h = 0x9E3779B1 * n & MASK
            for c in padded[i:i + n]:
                h = (h ^ ord(c)) * 0x85EBCA6B & MASK
                h ^= h >> 15
            out[h >> 16] += 1
    return out


def guess(model, text):
    if not text or not any(c.isalpha() for c in text) or not model.languages:
        return "und", 0.0
    values = {b: (1 + math.log(n)) * float(model.idf[b]) for b, n in ngrams(text).items()}
    size = math.sqrt(sum(v * v for v in values.values()))
    logits = [(sum(v / size * float(model.weights[b, k]) for b, v in values.items()) + float(model.bias[k])) / model.temperature for k in range(len(model.languages))]
    top = max(logits)
    p = [math.exp(x - top) for x in logits]
    best = max(range(len(p)), key=p.__getitem__)
    return model.languages[best], p[best] / sum(p)


def test_language_scores_by_hand(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.train(docs.where(~held_out()))
    odd = spark.createDataFrame([(-1, None), (-2, "12 !?"), (-3, "  É日本 x--y  "), (-4, "a"), (-5, "")], "doc_id long, text string")
    rows = docs.select("doc_id", "text").limit(60).unionByName(odd)
    texts = {r.doc_id: r.text for r in rows.collect()}
    for r in langid.predict(rows, model, F.lit(False)).collect():
        lang, p = guess(model, texts[r.doc_id])
        assert r.lang_pred == lang and abs(r.score - p) < 1e-5


def test_ftrl_step_by_hand():
    rng = np.random.default_rng(1)
    learner, a, beta, l1, l2 = langid.Ftrl(3), 0.3, 1.0, 0.02, 1e-3
    z, n = collections.defaultdict(float), collections.defaultdict(float)

    def weight(key):
        return 0.0 if abs(z[key]) <= l1 else (math.copysign(l1, z[key]) - z[key]) / ((beta + math.sqrt(n[key])) / a + l2)

    for _ in range(30):
        buckets = np.sort(rng.choice(12, 5, replace=False))
        x, label = rng.random(5), int(rng.integers(3))
        learner.step(buckets, x, label)
        inputs = [*zip(buckets.tolist(), x.tolist()), ("bias", 1.0)]
        logits = [sum(v * weight((b, k)) for b, v in inputs) for k in range(3)]
        total = sum(map(math.exp, logits))
        old = {(b, k): weight((b, k)) for b, _ in inputs for k in range(3)}
        for b, v in inputs:
            for k in range(3):
                g = v * (math.exp(logits[k]) / total - (k == label))
                step = (math.sqrt(n[b, k] + g * g) - math.sqrt(n[b, k])) / a
                z[b, k] += g - step * old[b, k]
                n[b, k] += g * g
    weights, bias = learner.weights()
    for b in range(12):
        for k in range(3):
            assert abs(weights[b, k] - weight((b, k))) < 1e-12
    assert all(abs(bias[k] - weight(("bias", k))) < 1e-12 for k in range(3))


def test_toxicity_scores_by_hand(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_outside_fold(docs, labels)
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, " ".join(w.strip("^") for w in list(model.weights)[:40]).upper())], "doc_id long, text string")
    rows = docs.select("doc_id", "text").unionByName(odd)
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in toxicity.score(rows, model, F.lit(False)).collect():
        plain = "".join(c if c.isalnum() and not c.isdecimal() else " " for c in texts[r.doc_id].lower()).split()
        found = {w for word in plain for w in (word, *("^" + word[:n] for n in (4, 6) if len(word) > n))}
        logits = [b + sum(model.weights[w][i] for w in sorted(found) if w in model.weights) for i, b in enumerate(model.biases)]
        want = sum(1 / (1 + math.exp(-x)) for x in logits) / len(logits)
        assert abs(r.score - want) < 1e-9 and r.predicted == (want >= 0.3)


def test_nnpu_step_by_hand():
    # One step on all-equal rows: the sample does not matter, only the risk estimate.
    prior, rate = 0.2, 0.05
    for x_pos, x_unl in (([[1.0, 0.0]], [[0.0, 1.0]]), ([[1.0, 1.0]], [[0.0, 0.0]])):
        w, bias = toxicity.nnpu(np.array(x_pos), np.array(x_unl), prior, seed=1, steps=1, keep=1.0, l1=0.0)
        start = math.log(prior / (1 - prior))
        p = 1 / (1 + math.exp(-start))
        loss = math.log(1 + math.exp(start))
        corrected = [p * u - prior * p * x for x, u in zip([*x_pos[0], 1.0], [*x_unl[0], 1.0])]
        gradient = [-prior * (1 - p) * x + c for x, c in zip([*x_pos[0], 1.0], corrected)] if loss - prior * loss >= 0 else [-c for c in corrected]
        # The first step of Adam moves each weight by the rate (a fifth at the end of training), against its gradient.
        want = [-rate * 0.2 * (g > 0) + rate * 0.2 * (g < 0) for g in gradient]
        # The bias starts at the prior, where its gradient is zero.
        assert np.allclose(w, want[:2], atol=1e-6) and abs(gradient[2]) < 1e-12 and abs(bias - start) < 1e-6
