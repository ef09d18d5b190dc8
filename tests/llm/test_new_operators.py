"""Hard negatives, decontamination and the source audit against brute force and on awkward rows."""

import collections
import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trainloom.llm import contamination, divergence, negatives

LONG = " ".join(f"word{i % 977} is" for i in range(6_000))
PASSAGE = "the quick brown fox jumps over one lazy dog and then it sleeps"
# Some columns are named like the operators' own.
TEXTS = "doc_id long, text string, lang string, source string, rid long, n long, term string, docs int, spans int"


@pytest.fixture(scope="module")
def awkward(spark):
    texts = [None, "", " \n\t", "a", "a a a", "A É é Ⅷ ß İ 日本語 x1y2", LONG, LONG, PASSAGE, PASSAGE.upper(), f"intro {PASSAGE} {PASSAGE} outro",
             "the quick brown fox jumps over one lazy", "fox " * 300, "short item here", "\x1cshort\x7fitem`here{", "x" * 50_000, "der die das und"]
    rows = [(i, t, (None, "en", "de")[i % 3], (None, "s1", "s2", "s3")[i % 4], 1, 2, "q", 3, 4) for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[8], rows[4], (None, PASSAGE, "en", "s1", 1, 2, "q", 3, 4), (None,) * 9], TEXTS)


@pytest.fixture(scope="module")
def bench(spark):
    rows = [("b1", PASSAGE), ("b2", "short item here"), ("b10", "a"), ("b3", None), ("b4", "..."), (None, "fox fox"), ("b5", " ".join(["fox"] * 12)),
            ("b1", "das und"), ("b6", PASSAGE + " again"), ("b7", LONG[:2_000]), ("b8", "ITEM HERE")]
    return spark.createDataFrame(rows, "item_id string, text string")


def table(df):
    return [r.asDict() for r in df.collect()]


# -- 11 hard negatives ------------------------------------------------------------------

def brute_negatives(rows, positives=5, negatives_=10, low=30, high=90):
    use = [(i, r) for i, r in enumerate(rows) if None not in (r[0], r[1], r[2]) and None not in r[2] and sum(x * x for x in r[2]) < 1 << 62]
    out = []
    for i, (a, label, v, is_anchor) in use:
        if not is_anchor:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), b, j, other) for j, (b, other, w, _) in use if j != i)
        for s, p, _, _ in [x for x in scored if x[3] == label][:positives]:
            fit = [x for x in scored if x[3] != label and -low * s <= -100 * x[0] <= -high * s][:negatives_]
            out += [(a, p, k, x[1], -s, -x[0]) for k, x in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<long>, is_anchor boolean").withColumn("rid", F.lit(1)).withColumn("strip", F.lit("x"))
    return sorted(tuple(r) for r in negatives.mine(df, F.col("is_anchor"), **options).collect())


def test_residue_products_are_exact():
    rng = np.random.default_rng(5)
    for size, dims in ((1 << 26, 40), (300, 2_500), (1, 3)):
        a, b = rng.integers(-size, size + 1, (6, dims)), rng.integers(-size, size + 1, (5, dims))
        bound = max(sum(int(x) ** 2 for x in v) for v in [*a, *b])
        got = negatives.residue_product(a, b, negatives.primes_for(bound))
        assert got.tolist() == (a.astype(object) @ b.T.astype(object)).tolist()
    assert negatives.primes_for(1 << 17) == [251, 241, 239]


def test_negatives_match_brute_force(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i) // 2 if i % 50 == 0 else int(i), int(rng.integers(0, 3)), rng.integers(-3, 12, 6).tolist(), bool(i % 9 == 0)) for i in range(240)]
    rows += [rows[9], rows[9], (500, 1, [], True), (501, 1, [0] * 6, True), (502, 2, [5, 5], True), (503, None, [1] * 6, True), (504, 1, None, True),
             (505, 1, [1, None, 1, 1, 1, 1], True), (None, 1, [1] * 6, True), (506, 1, [1 << 40] * 6, True), (507, 2, [1 << 30] * 6, None)]
    want = brute_negatives(rows)
    # Repeated ids are told apart by the order of reading, which results do not show.
    assert mined(spark, rows, strip_rows=64, block_rows=8) == want
    assert mined(spark, rows) == want
    assert mined(spark, rows[:1]) == [] and mined(spark, []) == []


# -- 12 decontamination -----------------------------------------------------------------

def brute_leaks(rows, items, width=10):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - width + 1)) if w and item is not None else ():
            windows[tuple(w[i:i + width])].add(item)
    out = []
    for doc, text in rows:
        w = words(text)
        hit, found = set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if (own := windows.get(tuple(w[i:i + m]))) is not None:
                    hit |= set(range(i, i + m))
                    found |= own
        found = sorted(found)
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), bool(hit), sorted(hit), found))
    return sorted(out, key=repr)


@pytest.mark.parametrize("options", [{}, {"shard_words": 60, "block_windows": 7, "rate": 3}])
def test_leaks_match_brute_force(awkward, bench, options):
    got = []
    for r in contamination.find_leaks(awkward, bench, **options).collect():
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))
        got.append((*r[:6], [i for s in r.spans for i in range(s.start, s.stop)], r["items"]))
    want = brute_leaks([(r.doc_id, r.text) for r in awkward.collect()], [tuple(r) for r in bench.collect()])
    assert sorted(got, key=repr) == want
    assert sum(x[5] for x in want) > 8


def test_leaks_of_empty_tables(awkward, bench):
    assert contamination.find_leaks(awkward.limit(0), bench).collect() == []
    clean = contamination.find_leaks(awkward, bench.limit(0)).collect()
    assert len(clean) == awkward.count() and not any(r.contaminated or r.spans for r in clean)


def test_index_finds_and_locates():
    rng = np.random.default_rng(3)
    for n_words, lengths in ((2, [400, 1, 90]), (1, [70]), (30, [5, 5, 300, 300])):
        texts = [rng.integers(1, n_words + 1, n) for n in lengths]
        texts += [texts[-1].copy()]
        lengths = np.array([len(t) for t in texts])
        index = contamination.Index.load(contamination.Index.build(np.concatenate(texts), lengths, n_words, 4))
        for pattern in ([1], [1, 1], [n_words, 1, n_words], texts[0][3:12].tolist()):
            low, high = index.search(np.array([pattern]), np.array([len(pattern)]))
            at = index.locate(np.arange(low[0], high[0]))
            t = np.searchsorted(index.starts, at, "right") - 1
            got = sorted(zip(t.tolist(), (at - index.starts[t]).tolist()))
            assert got == [(i, j) for i, x in enumerate(texts) for j in range(len(x)) if x[j:j + len(pattern)].tolist() == pattern]


# -- 13 source divergence ---------------------------------------------------------------

def brute_audit(rows, min_docs=3, k=200):
    rows = [tuple(x or "" for x in r) for r in rows]
    terms = lambda t: re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    groups, docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        groups[lang, source].update(terms(text))
        docs[lang].update(set(terms(text)))
    out = []
    for lang in {x for x, _ in groups}:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        own = {s: c for (x, s), c in groups.items() if x == lang}

        def rates(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}
        q, p = rates(sum(own.values(), collections.Counter())), {s: rates(c) for s, c in own.items()}
        f = lambda a, b: (a - b) ** 2 // b
        for s in own:
            parts = {"pair": [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in own if o != s],
                     "term": [(f(p[s][t], q[t]), t) for t in kept if own[s][t] and p[s][t] > q[t]]}
            for part, values in parts.items():
                ranked = sorted(values, key=lambda x: (-x[0], x[1].encode()))[:k if part == "term" else None]
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ranked, 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"min_docs": 1, "k": 3, "salts": 2}])
def test_audit_matches_brute_force(awkward, options):
    got = sorted(tuple(r) for r in divergence.audit(awkward, **options).collect())
    want = brute_audit([(r.text, r.lang, r.source) for r in awkward.collect()], **{k: v for k, v in options.items() if k != "salts"})
    assert got == want and "pair" in {r[2] for r in got} and ("term" in {r[2] for r in got} or not options)


def test_audit_of_many_ties(spark):
    rng = np.random.default_rng(11)
    rows = [(" ".join(f"{'äbcd'[int(x) % 4]}{'xyz'[int(x) % 3] * (int(x) % 40)}" for x in rng.integers(0, 400, 30)), "en", f"s{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(7)
    assert sorted(tuple(r) for r in divergence.audit(df, k=10).collect()) == brute_audit(rows, k=10)


def test_audit_of_empty_table_and_of_no_terms(awkward, spark):
    assert divergence.audit(awkward.limit(0)).collect() == []
    bare = spark.createDataFrame([("1 2", "en", "a"), (None, "en", "b"), (None, None, None)], "text string, lang string, source string")
    assert sorted(tuple(r) for r in divergence.audit(bare).collect()) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_skyband_is_exact():
    rng = np.random.default_rng(2)
    for n, k in ((0, 3), (1, 1), (400, 5), (3_000, 20)):
        group, place = rng.integers(0, 30, n), rng.permutation(n)
        lang = group + rng.integers(0, 90, n)
        above = ((group >= group[:, None]) & (lang <= lang[:, None]) & (place < place[:, None])).sum(1)
        assert sorted(divergence.skyband(group, lang, place, k, block=64, cells=16).tolist()) == np.flatnonzero(above < k).tolist()
