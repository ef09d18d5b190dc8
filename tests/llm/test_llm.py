"""Text operators against brute-force versions, on given tables and on awkward rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from trainloom.llm import ann, edits, exact, langid, minhash, packing, pieces, queries, sharding, substring, toxicity, wordbpe
from trainloom.llm.common import components, remainder

LONG = " ".join(f"word{i % 977} is" for i in range(12_000))
TEXTS = [None, "", "   \n\t", "a", "a", "a b\n c", "abc", "!!! ???", "İstanbul ŞÃÑ x² ½ ﬁ 日本語", "<|endoftext|> hi <s> ▁x ▁▁ y", "  two  spaces  ",
         "\x1c sep \x1d\x85 nbsp x", LONG, LONG, "mail me.x@a.example.org now 10.0.0.1 or 1234567890123.", "der die das und ist nicht " * 5]
SCHEMA = "key string, digest int, text string, doc_id long, start int, shard string, lang string, bands int, vslot int"


@pytest.fixture(scope="module")
def awkward(spark):
    """Null, empty, long and repeated rows, null ids, and columns named like the operators' own."""
    rows = [("k", 1, t, i, 2, "s", "en", 3, 4) for i, t in enumerate(TEXTS)]
    rows += [rows[6], (None, None, "null id", None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def pairs_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


# -- 1 packing ------------------------------------------------------------------------

def check_packing(df, out, max_tokens):
    table = wordbpe.load(P.path("word_bpe_49k.json"))
    ids = collections.defaultdict(list)
    for d, t in pairs_of(df):
        ids[d].append(np.array([*table.tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4"))
    held = collections.defaultdict(list)
    for r in out:
        assert 0 < r["length"] <= max_tokens
        held[r["sequence_id"]].append((r["offset"], r["length"]))
        assert any(len(x) == r["doc_tokens"] and zlib.crc32(x[r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for x in ids[r["doc_id"]])
    assert sum(r["length"] for r in out) == sum(len(x) for v in ids.values() for x in v)
    padding = 0
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        padding += 0 if at & (at - 1) == 0 else max_tokens - at
    assert padding <= 0.01 * sum(r["length"] for r in out)


def test_packing(docs, awkward, empty):
    path = P.path("word_bpe_49k.json")
    check_packing(docs, rows_of(queries.op1_packing(docs.sparkSession, SF)), 4096)
    check_packing(awkward, rows_of(packing.pack(awkward, path, max_tokens=64, block_tokens=500)), 64)
    assert rows_of(packing.pack(empty, path)) == []


def test_packing_balances_cost_and_keeps_small_pieces_whole():
    lengths = np.array([60, 50, 40, 30, 20, 10, 5, 41])
    sequences = packing.assign(lengths, 64, 1.0, 1.0)
    assert sorted(p for s in sequences for p, _, _ in s for _ in [0]) and sum(n for s in sequences for _, _, n in s) == lengths.sum()
    assert all(sum(n for _, _, n in s) == 64 for s in sequences[:lengths.sum() // 64])
    assert [(0, 0, 60)] == [x for s in sequences for x in s if x[0] == 0]  # the longest is never cut


def test_word_table_equals_library():
    table = wordbpe.load(P.path("word_bpe_49k.json"))
    for t in TEXTS:
        assert table.encode(t or "") == table._library(t or "")


def test_words_with_a_mark_need_no_pattern(monkeypatch):
    table = wordbpe.ChunkIds(P.path("word_bpe_49k.json"))
    plain = ["Ciónasbo.", "areonndlyor", "ÜBER,", "(x", "a)", "Ʒª!", "don'", "."]
    others = ["it's", "'s", "a1", "x--y", "İ.", "a..", "<|", "a²", "Ⱥ;", "e\u0301.", "ÿ\x7f", "\x01"]
    for t in plain + others:
        assert table.encode(t) == table._library(t)
    fresh = wordbpe.ChunkIds(P.path("word_bpe_49k.json"))
    monkeypatch.setattr(wordbpe, "_PIECES", None)
    for t in ("Ciónasbo.", "areonndlyor", "ÜBER,", "a)"):
        assert fresh.encode(t) == table.encode(t)


# -- 2 language ----------------------------------------------------------------------

def test_language(spark, docs, awkward, empty):
    out = rows_of(queries.op2_language_id(spark, SF))
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in out if r["held_out"]]
    assert len(out) == len(lang) and {r["doc_id"] for r in held} == {d for d in lang if zlib.crc32(str(d).encode()) % 4 == 2}
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in out)
    model = langid.train(docs)
    got = langid.predict(awkward, model, F.lit(False)).collect()
    assert len(got) == awkward.count()
    assert {r["lang_pred"] for r in got if r["doc_id"] in (0, 1, 2, 7)} == {"und"}
    assert langid.predict(empty, model, F.lit(False)).count() == 0
    assert langid.predict(awkward, langid.train(empty), F.lit(False)).where("lang_pred <> 'und'").count() == 0


def test_temperature_and_penalty():
    assert langid.temperature(np.array([[4.0, 0.0]] * 6 + [[0.0, 4.0]] * 4), np.array([0] * 10)) > 1  # too sure: softened
    strict = langid.Ftrl(2, l1=5.0)
    strict.step(np.array([3]), np.array([1.0]), 0)
    assert not strict.weights()[0].any()


# -- 3 exact -------------------------------------------------------------------------

def brute_copies(df):
    groups = collections.defaultdict(list)
    for d, t in pairs_of(df):
        groups[re.sub("[\x20\x09-\x0d]", "", t)].append((-len(t), d is None, d or 0))
    return {k: (None if min(v)[1] else min(v)[2], len(v)) for k, v in groups.items()}


@pytest.mark.parametrize("options", [{}, {"key_bits": 2, "bucket_bytes": 200}])
def test_exact(spark, docs, awkward, empty, options):
    for df in (docs, awkward):
        want = brute_copies(df)
        by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
        out = rows_of(exact.find_copies(df, **options))
        assert len(out) == df.count() and sum(r["kept"] for r in out) == len(want)
        assert all((r["keep_id"], r["group_size"]) == by_sha[r["text_sha256"]] for r in out)
        kept = exact.drop_copies(df, **options)
        assert kept.columns == df.columns and kept.count() == len(want)
        assert sorted(map(str, kept.collect())) == sorted(set(map(str, kept.collect())))
    assert exact.find_copies(empty, **options).count() == 0


def test_directory_splits_until_buckets_fit():
    sizes = {0b0000: 50, 0b0001: 50, 0b0011: 10, 0b1000: 5, 0b1111: 500}
    d = exact.Directory(sizes, 4, 60)
    assert len(d.cells) == 1 << d.depth
    load = collections.Counter()
    for p, n in sizes.items():
        load[d.cells[p >> (4 - d.depth)]] += n
    assert d.depth == 4 and max(n for b, n in load.items() if n != 500) <= 60
    assert exact.Directory({}, 4, 60).cells == [0]


# -- 4 pieces ------------------------------------------------------------------------

def test_pieces(spark, docs, awkward, empty):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for df in (docs, awkward):
        want = collections.Counter()
        for d, t in pairs_of(df):
            ids = model.encode(t)
            want[d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((model.decode(ids) if ids else "").encode()).hexdigest()] += 1
        assert collections.Counter(map(tuple, pieces.encode_decode(df, path, full=False).collect())) == want
    full = pieces.encode_decode(awkward, path).where("doc_id = 10").first()
    assert full["ids"] == model.encode(TEXTS[10]) and full["decoded"] == model.decode(full["ids"])
    assert pieces.encode_decode(empty, path).count() == 0


# -- 5 toxicity ----------------------------------------------------------------------

def test_toxicity(spark, awkward, empty):
    rng = np.random.default_rng(3)
    names = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows, labels = [], []
    for i in range(1_200):
        words = list(rng.choice(names, 40))
        bad = i % 8 == 0
        rows.append((i, " ".join([*words, *(rng.choice(["grimword", "foulword"], 2) if bad else [])])))
        if (i // 8) % 2 == 0:
            labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit_outside_fold(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = toxicity.score(docs, model, remainder("doc_id") == 2).collect()
    held = [r for r in out if r["held_out"]]
    assert len(out) == len(rows) and held
    assert np.mean([r["predicted"] == int(r["doc_id"] % 8 == 0) for r in held]) >= 0.98
    assert toxicity.score(awkward, model, F.lit(False)).where("score between 0 and 1").count() == awkward.count()
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] == 0 for r in out)
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(awkward, toxicity.fit_outside_fold(awkward, no_labels), F.lit(False)).where("predicted = 1").count() == 0
    assert toxicity.score(empty, model, F.lit(False)).count() == 0


def test_telling_words_of_a_rare_language_are_features():
    rng = np.random.default_rng(10)
    common = [[f"{lang}{i}" for i in range(60)] for lang in ("a", "b")]

    def row(lang, *more):
        return toxicity.hashed({*rng.choice(common[lang], 20), *more})

    positive = [row(0, "foul") for _ in range(297)] + [row(1, *["rare"][:i < 20]) for i in range(22)]
    unlabelled = [row(0, *["foul"][:i < 300]) for i in range(3_900)] + [row(1, *["rare"][:i < 55]) for i in range(440)]
    names = set(toxicity.vocabulary(positive, unlabelled, 5, 7.0, 5_000).tolist())
    assert names >= set(toxicity.hashed({"foul", "rare"}).tolist())
    assert len(toxicity.vocabulary(positive, unlabelled, 5, 7.0, 1)) == 1


# -- 6 repeated passages ---------------------------------------------------------------

def brute_repeats(pairs, width=13):
    low = {}
    for d, t in pairs:
        w = re.findall("[^\x20\x09-\x0d]+", t)
        for k in range(len(w) - width + 1):
            if d is not None:
                g = tuple(w[k:k + width])
                low[g] = min(low.get(g, d), d)
    out = collections.Counter()
    for d, t in pairs:
        w = re.findall("[^\x20\x09-\x0d]+", t)
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - width + 1):
            if d is not None and low[tuple(w[k:k + width])] < d:
                gone[k:k + width] = True
        out[d, len(w), int(gone.sum()), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("group_rows", [4_000, 3])
def test_repeats(spark, docs, awkward, empty, group_rows):
    rng = np.random.default_rng(1)
    shared = " ".join(rng.choice(list("abcdefgh"), 40))
    made = []
    for i in range(60):
        own = " ".join(rng.choice(["x", "y", "z", "q"], 30))
        cut = int(rng.integers(0, 40))
        made.append((i, f"{own} {shared[cut:]} {own[:20]} {shared}" if i % 3 else own + " " + own))
    tables = [spark.createDataFrame(made, "doc_id long, text string"), awkward]
    for df in tables if group_rows == 3 else [docs, *tables]:
        out = substring.remove_repeats(df, group_rows=group_rows).collect()
        assert collections.Counter(map(tuple, out)) == brute_repeats(pairs_of(df))
    assert substring.remove_repeats(empty).count() == 0


def test_cut_repeats_keeps_rows_and_columns(awkward):
    out = substring.cut_repeats(awkward, length_col=None)
    assert out.dtypes == awkward.dtypes and out.count() == awkward.count()
    assert {r["doc_id"]: r["text"] for r in out.collect()}[13] == ""  # the second long text
    assert {r["doc_id"]: r["text"] for r in out.collect()}[12] == LONG


# -- 7 edits -------------------------------------------------------------------------

def test_edit_counts(spark, docs, awkward, empty):
    ranks = P.path("byte_bpe_50k.tiktoken")
    counts = edits.load(ranks)
    rng = np.random.default_rng(2)
    alphabet = ["a", " ", "\n", "é", "1", "'s", "  ", " x", "\t", "word", "!"]
    for _ in range(300):
        text = "".join(rng.choice(alphabet, int(rng.integers(0, 60))))
        cuts = sorted(rng.choice(len(text) + 1, size=min(len(text) + 1, 6), replace=False).tolist())
        changes = [(a, b, "".join(rng.choice(alphabet, int(rng.integers(0, 4))))) for a, b in zip(cuts[::2], cuts[1::2])]
        leaves = edits.chunks_of(text)
        tree = edits.SegmentTree([len(c) for c in leaves], [counts[c] for c in leaves], fanout=2)
        assert tree.tokens == len(counts.encoding.encode_ordinary(text))
        edited, _ = edits.apply_edits(text, tree, changes, counts)
        for a, b, r in reversed(changes):
            text = text[:a] + r + text[b:]
        assert edited == text and tree.tokens == len(counts.encoding.encode_ordinary(text)) and tree.sums[1][0] == len(text)
    for df in (docs, awkward):
        out = edits.count_after_edits(edits.build_trees(edits.with_redactions(df), ranks), ranks)
        for r in out.collect():
            assert r["tokens_after"] == len(counts.encoding.encode_ordinary(r["text"]))
        assert out.count() == df.count()
    assert edits.count_after_edits(edits.build_trees(edits.with_redactions(empty), ranks), ranks).count() == 0


# -- 8 near duplicates -----------------------------------------------------------------

def brute_classes(pairs):
    sets = {t: set(minhash.units(t).tolist()) for _, t in pairs}
    parent = {t: t for t in sets}

    def root(t):
        while parent[t] != t:
            t = parent[t]
        return t
    texts = list(sets)
    for i, a in enumerate(texts):
        for b in texts[:i]:
            common = len(sets[a] & sets[b])
            if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                parent[root(a)] = root(b)
    groups = collections.defaultdict(list)
    for d, t in pairs:
        groups[root(t)].append(d)
    return {t: (min([d for d in groups[root(t)] if d is not None], default=None), len(groups[root(t)])) for t in texts}


def test_near_duplicates(spark, awkward, empty):
    rng = np.random.default_rng(4)
    base = [f"t{i}" for i in range(120)]
    made = []
    for i in range(40):
        words = list(base)
        for k in rng.choice(120, int(rng.integers(0, 5)), replace=False):
            words[k] = f"n{i}x{k}"
        made.append((i, " ".join(words)))
    made += [(100 + i, " ".join(rng.choice([f"u{j}" for j in range(400)], 60))) for i in range(20)]
    for df in (spark.createDataFrame(made, "doc_id long, text string"), awkward):
        want = brute_classes(pairs_of(df))
        text = {d: t for d, t in pairs_of(df)}
        out = minhash.near_duplicates(df).collect()
        assert len(out) == df.count()
        assert all((r["class_id"], r["class_size"]) == want[text[r["doc_id"]]] for r in out if r["doc_id"] is not None)
        kept = minhash.drop_near_duplicates(df)
        assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} >= {v[0] for v in want.values()}
    assert minhash.near_duplicates(empty).count() == 0


def test_darts_estimate_weighted_similarity():
    a, b = "one two three four five six " * 6 + "p q r s t u v w", "one two three four five six " * 4 + "p q r s t u v w x"
    x, y = minhash.units(a), minhash.units(b)
    truth = len(np.intersect1d(x, y)) / len(np.union1d(x, y))
    s = minhash.darts([x, y], 2_000)
    assert abs((s[0] == s[1]).mean() - truth) < 0.05


def test_cross_links_finds_what_pivots_missed():
    import pyarrow as pa
    sets = [np.arange(0, 50), np.arange(4, 54), np.arange(500, 540)]
    group = pa.table({"digest": pa.array([b"a", b"b", b"c"], pa.binary()), "label": pa.array([b"a", b"b", b"c"], pa.binary()),
                      "units": pa.array([s.tolist() for s in sets], pa.list_(pa.int64()))})
    links = minhash._cross(group, 0.8).to_pylist()
    assert {(r["a"], r["b"]) for r in links} == {(b"a", b"b")}


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (7, 6), (9, 9), (5, 3), (8, 7)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(2, 1), (3, 1), (5, 1), (7, 6), (8, 6)}


# -- 9 shards ------------------------------------------------------------------------

def test_merged_classes(spark):
    labels = spark.createDataFrame([(b"b", b"a"), (b"c", b"a"), (b"e", b"d"), (b"y", b"x")], "node binary, label binary")
    links = spark.createDataFrame([(b"c", b"e"), (b"b", b"c"), (b"f", b"y")], "a binary, b binary")
    got = {(bytes(r.node), bytes(r.label)) for r in minhash._merged(labels, links).collect()}
    assert got == {(b"b", b"a"), (b"c", b"a"), (b"d", b"a"), (b"e", b"a"), (b"x", b"f"), (b"y", b"f")}


def test_shards(spark, docs, awkward, empty):
    for df, n in ((docs, 40), (awkward, 3)):
        out = rows_of(sharding.shard(df, n))
        assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == collections.Counter(
            (d, len(t.encode()) + 16, zlib.crc32(t.encode())) for d, t in pairs_of(df))
        by = collections.defaultdict(list)
        for r in out:
            by[r["shard"]].append(r["slot"])
        assert all(sorted(v) == list(range(len(v))) for v in by.values())
    load = collections.Counter()
    for r in rows_of(sharding.shard(docs, 10)):
        load[r["shard"]] += r["size"]
    assert max(load.values()) < 1.1 * min(load.values())
    assert sharding.shard(empty, 3).count() == 0


def test_slot_map_grows_by_moves_into_new_shards_only(spark):
    rng = np.random.default_rng(5)
    sizes = {v: int(rng.integers(50, 150)) for v in range(sharding.SLOTS)}
    old = sharding.SlotMap.balanced(sizes, 40)
    new = old.grown(sizes, 41)
    moved = [(a, b) for a, b in zip(old.shards, new.shards) if a != b]
    load = collections.Counter()
    for v, s in enumerate(new.shards):
        load[s] += sizes[v]
    assert moved and {b for _, b in moved} == {40} and max(load.values()) < 1.03 * min(load.values())
    path = old.save(spark)
    new.save(spark, path)
    assert sharding.SlotMap.load(spark, path) == new and sharding.SlotMap.load(spark, path, 1) == old


def test_shard_edits_the_kept_map(spark, docs, tmp_path):
    path = str(tmp_path / "map")

    def run(df, n):
        out = rows_of(sharding.shard(df, n, map_path=path))
        load = collections.Counter()
        for r in out:
            load[r["shard"]] += r["size"]
        assert len(load) == n and max(load.values()) < 1.1 * min(load.values())
        assert len({r["map_version"] for r in out}) == 1
        return out[0]["map_version"], {r["vslot"]: r["shard"] for r in out}

    first = run(docs, 4)
    assert first[0] == 1 and run(docs, 4) == first
    version, grown = run(docs, 5)
    assert version == 2 and {grown[v] for v in grown if grown[v] != first[1][v]} == {4}
    version, fewer = run(docs, 3)
    assert version == 3 and sharding.SlotMap.load(spark, path, 1).n_shards == 4
    more = docs.unionByName(docs.where("doc_id % 7 = 0").withColumn("doc_id", F.col("doc_id") + 10_000))
    version, drifted = run(more, 3)
    assert version in (3, 4) and sum(drifted[v] == s for v, s in fewer.items()) > 0.8 * len(fewer)


# -- 10 neighbours ---------------------------------------------------------------------

def test_neighbours(spark):
    rng = np.random.default_rng(6)
    x = rng.standard_normal((1_500, 16))
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    rows += [(7, x[7].tolist(), 0), (2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, [1.0, None] + [0.0] * 14, 0),
             (2004, [1.0], 0), (None, x[0].tolist(), 0), (2020, x[20].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    good = [(i, np.array(v)) for i, v, _ in rows if i is not None and v is not None and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    ids, m = np.array([i for i, _ in good]), np.stack([v for _, v in good])
    for options, least in (({}, 1.0), ({"block_rows": 500, "candidates": 250}, 0.9)):
        got = collections.defaultdict(list)
        for r in ann.search(df, F.col("vec_id") % 20 == 0, k=10, **options).collect():
            got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
        found = 0
        for q in np.flatnonzero(ids % 20 == 0):
            s = (m * m[q]).sum(axis=1)
            order = [k for k in np.lexsort((ids, -s)) if k != q][:10]
            mine = sorted(got[ids[q]])
            assert [r for r, _, _ in mine] == list(range(1, 11))
            found += len({v for _, v, _ in mine} & set(ids[order].tolist()))
        assert found / (10 * sum(ids % 20 == 0)) >= least * 0.999
    small = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in ann.search(small, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert ann.search(small.where("false"), F.lit(True)).count() == 0


def test_neighbours_of_unequal_lengths_and_hot_copies(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((6_000, 32))
    x *= (np.exp(rng.normal(0, 0.5, len(x))) / np.sqrt((x * x).sum(axis=1)))[:, None]
    x[100:400] = x[100]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in ann.search(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    ids = np.arange(len(x))
    for q in range(0, len(x), 100):
        order = np.lexsort((ids, -(x * x[q]).sum(axis=1)))
        assert got[q] == order[order != q][:20].tolist()


def test_small_blocks_go_through_the_forest(monkeypatch):
    import pyarrow as pa
    found = []

    class Noted(ann.Forest):
        def candidates(self, queries, wanted):
            for rows in super().candidates(queries, wanted):
                found.append((wanted, len(rows), len(self.x)))
                yield rows

    monkeypatch.setattr(ann, "Forest", Noted)
    x = np.random.default_rng(9).standard_normal((300, 16))
    table = pa.table({"vec_id": pa.array(range(300)), "rid": pa.array(range(300)), "vec": pa.array(x.tolist())})
    out = ann._search(table, table.slice(0, 10), 5, ann.TREES, ann.BITS, share=ann.CANDIDATES / ann.BLOCK_ROWS)
    assert out.num_rows == 50 and len(found) == 10
    assert all(wanted <= n for wanted, n, _ in found) and any(n < rows for _, n, rows in found)


# -- pipeline --------------------------------------------------------------------------

def test_pipeline(spark, docs):
    import corpus_pipeline
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "substring_dedup", "packing"]
    out = corpus_pipeline.run(spark, SF).collect()
    known = {r["doc_id"] for r in docs.collect()}
    assert out and {r["doc_id"] for r in out} <= known
    assert len({r["doc_id"] for r in out}) > 0.6 * len(known)
