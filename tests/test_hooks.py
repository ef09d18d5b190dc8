"""Row numbers, callables, reward plug-ins, stage counts, tokenizer functions and list state."""

import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from trainloom.functions import messages as M
from trainloom.functions.tokens import ByteCache, align, learned_characters, load_tokenizer, token_length, token_mask
from trainloom.operators import conversations as CV
from trainloom.operators import hooks as H
from trainloom.operators.accounting import StageCounts
from trainloom.operators.datasets import sft_records_exact
from trainloom.operators.indexing import numbered, seeded_shuffle
from trainloom.operators.metrics import step_groups
from trainloom.operators.rewards import score_rows
from trainloom.plans import jobs as J
from trainloom.sources.shared import drain
from trainloom.streaming.list_state import stream_chat_context, stream_think_segments

from .conftest import SF
from .test_streaming import CHAT, TEXTS, batch_split

# -- row numbers ------------------------------------------------------------------------


@pytest.mark.parametrize("parts", [1, 5, 211])
def test_shuffled_index_is_gapless_and_independent_of_partitions(spark, parts):
    df = spark.range(1_000).select(F.col("id").alias("key"), F.lit("x").alias("row")).repartition(parts)
    got = {r.key: r.row_index for r in seeded_shuffle(df, "key").collect()}
    order = [r.key for r in df.orderBy(F.md5(F.concat(F.lit("3407:"), F.col("key").cast("string"))), "key").collect()]
    assert [got[k] for k in order] == list(range(1_000))


def test_numbered_by_group_with_nulls_ties_and_a_hot_group(spark):
    rows = [(None if i % 7 == 0 else "hot" if i % 3 else f"g{i % 5}", i // 2) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, o int").repartition(9)
    got = {}
    for r in numbered(df, ["o"], by=["g"], name="n").collect():
        got.setdefault(r.g, []).append((r.n, r.o))
    for own in got.values():
        own.sort()
        assert [n for n, _ in own] == list(range(len(own))) and [o for _, o in own] == sorted(o for _, o in own)
    assert sum(map(len, got.values())) == 900
    assert numbered(df.limit(0), ["o"]).count() == numbered(df.limit(0), ["o"], by=["g"]).count() == 0


def test_groups_of_one_step_that_holds_all_rows(spark):
    rows = [(4, f"t{i // 3:03}", i % 3, float(i // 5 % 2)) for i in range(202)]
    df = spark.createDataFrame(rows, "step int, task_id string, sample_ix int, score double").repartition(6)
    got = sorted(tuple(r) for r in step_groups(df, n=5).collect())
    want = []
    for g in range(41):
        x = [r[3] for r in rows[5 * g:5 * g + 5]]
        want.append((4, g, len(x), min(x), max(x), len(x) > 1))
    assert got == want and want[-1][2] == 2


# -- callables ------------------------------------------------------------------------

def test_map_rows_replaces_columns_and_reads_absent_ones_as_null(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    out = H.map_rows(df, lambda r: {"id": r["id"], "u": (r["t"] or "?") + str(r["none"])}, "id int, u string, v double", ["id", "t", "none"])
    assert out.columns == ["id", "u", "v"] and sorted(map(tuple, out.collect())) == [(1, "aNone", None), (2, "?None", None)]
    assert H.map_rows(df.limit(0), lambda r: {}, "id int").count() == 0


def test_map_batches_may_change_the_number_of_rows(spark):
    df = spark.range(10).repartition(1).sortWithinPartitions("id")
    out = H.map_batches(df, lambda b: {"n": [len(b["id"])], "first": [b["id"][0]]}, "n long, first long, missing string", batch_size=4)
    assert [tuple(r) for r in out.collect()] == [(4, 0, None), (4, 4, None), (2, 8, None)]
    with pytest.raises(Exception, match="different lengths"):
        H.map_batches(df, lambda b: {"n": [1], "first": []}, "n long, first long").collect()


def test_map_indexed_and_keep_where(spark):
    df = spark.createDataFrame([(c, i) for i, c in enumerate("dacb")], "c string, i int").repartition(3)
    out = H.map_indexed(df, lambda r, i: {"c": r["c"], "i": i, "seen": sorted(r)}, "c string, i long, seen array<string>", ["c"], ["c"])
    assert sorted(map(tuple, out.collect())) == [(c, i, ["c"]) for i, c in enumerate("abcd")]
    assert sorted(r.c for r in H.keep_where(df, lambda i, none: i > 1 and none is None, ["i", "none"]).collect()) == ["b", "c"]


def test_reward_plugins_are_bound_by_name_in_one_pass(spark):
    df = spark.createDataFrame([(i, f"p{i}", "x" * i if i else None, i % 2, "unused") for i in range(5)], "id int, prompt string, completion string, odd int, extra string")

    def length(prompts, completions):
        return [float(len(c)) for c in completions]

    def odd_only(prompts, completions, odd=None, **columns):
        assert set(columns) == {"extra", "id"}
        return [1.0 if o else None for o in odd]

    out = score_rows(df, {"length": length, "odd_only": odd_only}, ["id"])
    assert sorted(map(tuple, out.collect())) == [(i, float(i), 1.0 if i % 2 else None) for i in range(5)]
    with pytest.raises(Exception, match="gave 1 scores"):
        score_rows(df.coalesce(1), {"bad": lambda prompts, completions: [0.0]}, ["id"]).collect()


# -- stage counts ---------------------------------------------------------------------

def test_stage_counts_come_from_the_pass_that_writes(spark, tmp_path):
    counts = StageCounts()
    df = counts.count(spark.range(20), "loaded")
    df = counts.count(df.where("id % 3 = 0"), "thirds")
    df = counts.count(df.orderBy("id").limit(4), "capped")
    df.write.parquet(str(tmp_path / "out"))
    assert counts.counts() == [("loaded", None, 20), ("thirds", 20, 7), ("capped", 7, 4)]
    counts.require()
    empty = StageCounts()
    empty.count(empty.count(spark.range(3), "loaded").where("id > 5"), "large").write.parquet(str(tmp_path / "none"))
    with pytest.raises(RuntimeError, match="large: no rows remain"):
        empty.require()


# -- tokenizer ------------------------------------------------------------------------

PATH = P.path(J.TOKENIZER)


def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_exact_records_match_the_library(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    counts, tokenizer = StageCounts(), library()
    got = {r.conv_id: r.text for r in sft_records_exact(turns, PATH, max_tokens=300, counts=counts).collect()}
    recs = CV.to_messages(turns).select("conv_id", M.render_chat(M.ensure_system("messages")).alias("text")).collect()
    want = {r.conv_id: r.text for r in recs if len(tokenizer.encode(r.text, add_special_tokens=False).ids) <= 300}
    assert got == want and 0 < len(want) < len(recs)
    assert counts.counts() == [("rendered", None, len(recs)), ("fits", len(recs), len(want)), ("capped", len(want), len(want))]


def test_token_length_of_null_repeated_and_special_texts(spark):
    texts = [None, "", "a b", "a b", "<|eot_id|> <|endoftext|>", "日本語 é" * 50, "x" * 20_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    tokenizer = library()
    want = [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]
    for bound in (0, 3_000, 1 << 20):
        assert [r.n for r in df.select("i", token_length("t", PATH, cache_bytes=bound).alias("n")).orderBy("i").collect()] == want


def test_cache_is_bounded_by_bytes():
    cache = ByteCache(100_000)
    for i in range(10_000):
        cache.put(f"text {i}", i)
    cache.put("y" * 50_000, 1)
    assert cache.held <= 100_000 and cache.get("text 9999") == 9999 and cache.get("text 0") is None and cache.get("y" * 50_000) is None


def test_token_mask_matches_the_library_offsets(spark):
    messages = [[("system", "s é"), ("user", "héllo 日本"), ("assistant", "answer 日本 <|eot_id|> x"), ("user", ""), ("assistant", ""), ("assistant", "b")],
                [("user", "only")], [], [("assistant", None)]]
    df = spark.createDataFrame(list(enumerate(messages)), f"i int, m {M.MESSAGE_TYPE}")
    text = M.render_chat("m")
    rows = df.select("i", text.alias("text"), learned_characters("m").alias("c"), token_mask(text, learned_characters("m"), PATH).alias("mask")).orderBy("i").collect()
    for r, own in zip(rows, messages):
        learned = set()
        for piece in r.c:
            learned |= set(range(piece.start, piece.stop))
        assert "".join(r.text[p.start:p.stop] for p in r.c) == "".join((c or "") + "<|eot_id|>" for role, c in own if role == "assistant")
        offsets = library().encode(r.text, add_special_tokens=False).offsets
        want = [i for i, (a, _) in enumerate(offsets) if a in learned]
        assert [i for s in r.mask.learned for i in range(s.start, s.stop)] == want and r.mask.n_tokens == len(offsets)
    assert align(load_tokenizer(PATH)(["ab cd"])[0], []) == []


# -- list state -----------------------------------------------------------------------

def deliver(spark, path, stream, schema, deliveries):
    """Rows of all deliveries, one run of the stream each."""
    (path / "in").mkdir()
    for i, rows in enumerate(deliveries):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(path / "in" / str(i)))
        src = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(path / "in"))
        out = drain(stream(src), "list-state", str(path / "run"))
    return out.collect()


def test_think_segments_of_scattered_chunks_and_restarts(spark, tmp_path):
    rng, rows = random.Random(3), []
    for i, t in enumerate(TEXTS):
        pieces = [t[j:j + 2] for j in range(0, len(t), 2)] or [None]
        rows += [(f"r{i}", s, p, s == len(pieces) - 1) for s, p in enumerate(pieces)]
    rng.shuffle(rows)
    schema = "reply_id string, seq int, chunk string, is_final boolean"
    cut = len(rows) // 3
    got = deliver(spark, tmp_path, stream_think_segments, schema, [rows[:cut], rows[cut // 2:2 * cut], rows[2 * cut:] + rows[:9] + [(None, None, "x", False)]])
    for i, t in enumerate(TEXTS):
        own = sorted((r for r in got if r.reply_id == f"r{i}"), key=lambda r: r.out_seq)
        assert [r.out_seq for r in own] == list(range(len(own))) and own[-1].is_last
        assert tuple("".join(r.text for r in own if r.channel == c) for c in ("think", "answer")) == batch_split(t)


def test_chat_context_of_late_and_repeated_turns(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    got = deliver(spark, tmp_path, lambda s: stream_chat_context(s, max_turns=1), schema,
                  [CHAT[4:] + [(2, 0, "user", "/exit"), (2, 1, "user", "gone")], CHAT[:5] + CHAT[6:7], CHAT[2:]])
    turns = {}
    for r in sorted(got, key=lambda r: r.pos):
        turns.setdefault((r.conv_id, r.at_turn), []).append((r.role, r.content))
    assert {k: v[1:] for k, v in turns.items()} == {(1, 1): [("user", "hi")], (1, 5): [("user", "again")], (1, 7): [("assistant", "a"), ("user", "more")]}


def test_chat_history_is_cut_but_keeps_the_window(spark, tmp_path):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(25)]
    got = deliver(spark, tmp_path, lambda s: stream_chat_context(s, max_turns=2), "conv_id long, turn long, role string, text string", [rows])
    for at in range(0, 25, 2):
        own = [r.content for r in sorted(got, key=lambda r: r.pos) if r.at_turn == at][1:]
        assert own == [f"m{i}" for i in range(max(0, at - 3), at + 1)]


# -- builders -------------------------------------------------------------------------

def test_builders_by_name_guard_and_smoke(spark):
    from trainloom.config import JobParams
    from trainloom.operators.builders import build
    rows = spark.range(500).select("id", F.array(F.struct(F.lit("user").alias("role"), F.col("id").cast("string").alias("content"))).alias("messages"))
    p = JobParams(general_max_samples=10)
    smoke = {r.id for r in build("general_sft", rows, p, smoke=True).collect()}
    assert len(smoke) == 10 and max(smoke) < 100
    assert {r.id for r in build("general_sft", rows, p).collect()} != smoke
    with pytest.raises(RuntimeError, match="general_sft: no rows remain"):
        build("general_sft", rows.limit(0), p)
    with pytest.raises(KeyError, match="unknown dataset 'chat'"):
        build("chat", rows)


def test_rows_of_chosen_keys_equal_the_seeded_cap(spark):
    from trainloom.operators.sampling import chosen_rows, seeded_cap
    df = spark.range(300).select(F.when(F.col("id") != 7, F.concat(F.lit("k"), F.col("id"))).alias("key"), (F.col("id") * 2).alias("v")).repartition(5)
    for n in (None, 0, 1, 40, 1_000):
        assert sorted(map(str, chosen_rows(df, "key", n).collect())) == sorted(map(str, seeded_cap(df, "key", n).collect()))
    assert chosen_rows(df, "key", 40, among=df.where("v > 500")).where("v <= 500").count() == 0
