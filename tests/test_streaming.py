import random
import re
from functools import partial

import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from trainloom.functions import text as T
from trainloom.operators import conversations as CV
from trainloom.operators import metrics as ME
from trainloom.plans import queries as Q
from trainloom.sources.shared import materialise, short_rows
from trainloom.streaming import think_stream as TS
from trainloom.streaming.memory import _make_fn as _memory_fn
from trainloom.streaming.list_state import ThinkProcessor
from trainloom.streaming.memory import stream_memory
from trainloom.streaming.step_metrics import _fold, _make_fn, _record, stream_step_metrics
from trainloom.streaming.think_stream import ThinkSplitter, _runs, _stream_group, split_chunked_replies, stream_think_split

SEG = re.compile(r"<think>(.*?)(?:</think>|\Z)", re.S)


def batch_split(text):
    return "".join(SEG.findall(text)), SEG.sub("", text)


def feed_all(text, cuts):
    sp = ThinkSplitter()
    acc = {"think": "", "answer": ""}
    prev = 0
    for c in cuts + [len(text)]:
        for ch, t in sp.feed(text[prev:c]):
            acc[ch] += t
        prev = c
    for ch, t in sp.feed("", final=True):
        acc[ch] += t
    return acc["think"], acc["answer"]


def test_splitter_invariant_under_chunking():
    rng = random.Random(7)
    alphabet = ["<think>", "</think>", "a", "b", "<", ">", "/", "think", "<th", "ink>", "\n"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))
        cuts = sorted(rng.sample(range(len(text) + 1), rng.randint(0, min(6, len(text)))))
        assert feed_all(text, cuts) == batch_split(text), text


def test_one_char_chunks():
    text = "x<think>abc</think>y</think>z<think>q"
    assert feed_all(text, list(range(1, len(text)))) == batch_split(text)


def _chunks_df(spark, texts, size):
    rows = []
    for i, t in enumerate(texts):
        pieces = [t[j:j + size] for j in range(0, len(t), size)] or [""]
        rows += [(f"r{i}", s, p, s == len(pieces) - 1) for s, p in enumerate(pieces)]
    return spark.createDataFrame(rows, "reply_id string, seq int, chunk string, is_final boolean")


TEXTS = ["plain", "<think>a</think>b", "<think>unclosed", "stray</think>close", "<think>a<think>b</think>c",
         "x<think>1</think>y<think>2</think>z" * 5, ""]


def test_batch_chunked_equals_regex(spark):
    out = {r.reply_id: (r.think, r.answer) for r in split_chunked_replies(_chunks_df(spark, TEXTS, 3)).collect()}
    df = spark.createDataFrame([(f"r{i}", t) for i, t in enumerate(TEXTS)], "reply_id string, t string")
    exp = {r.reply_id: (r.th, r.an) for r in df.select("reply_id", T.think_text("t").alias("th"),
                                                       T.answer_text("t").alias("an")).collect()}
    assert out == exp


def test_chunks_of_any_order_and_repeated_numbers_are_joined_by_number(spark):
    rows = [("a", 1, "é<th"), ("a", 2, "ink>x"), ("b", 0, "b0"), ("a", 0, "0"), ("a", 3, None), ("b", 2, "b2"), ("b", 1, ""),
            ("c", 0, "pü"), ("c", 1, "q"), ("c", 2, "r"), ("c", 0, "P"), ("c", 1, "Q"), ("c", None, "n"), (None, 0, "z"), (None, 1, "y"), ("d", 0, "")]
    want = {"a": ("x", "0é"), "b": ("", "b0b2"), "c": ("", "nPpüQqr"), None: ("", "zy"), "d": ("", "")}
    for parts in (1, 3):
        df = spark.createDataFrame(rows, "reply_id string, seq int, chunk string").repartition(parts, "chunk") if parts > 1 else \
            spark.createDataFrame(rows, "reply_id string, seq int, chunk string").coalesce(1)
        assert {r.reply_id: (r.think, r.answer) for r in split_chunked_replies(df).collect()} == want


def test_chunks_that_lie_together_are_shuffled_as_one_row(spark):
    table = pa.record_batch({"r": ["a"] * 4 + ["b"] * 2, "s": [0, 1, 2, 4, 5, 6], "c": ["x", "é", "", "y", "z", "w"]})
    out = [r for part in (table, table.slice(1, 3)) for b in _runs(iter([part])) for r in b.to_pylist()]
    assert [(r["reply_id"], r["seq"], r["text"], r["sizes"]) for r in out] == [
        ("a", 0, "xé", [1, 1, 0]), ("a", 4, "y", [1]), ("b", 5, "zw", [1, 1]), ("a", 1, "é", [1, 0]), ("a", 4, "y", [1])]


def test_chunk_batches_are_bounded_by_rows_and_the_settings_come_back(spark, monkeypatch):
    size, seen = "spark.sql.execution.arrow.maxBytesPerBatch", []
    monkeypatch.setattr(TS, "materialise", lambda df, name: seen.append(materialise(df, name)) or seen[-1])
    df = spark.createDataFrame([("a", i, "xy") for i in range(300)], "reply_id string, seq int, chunk string").coalesce(1)
    before = spark.conf.get(size)
    spark.conf.set(size, "64")  # a batch of a few rows
    try:
        assert split_chunked_replies(df).collect() == [("a", "", "xy" * 300)]
        assert [len(r.sizes) for r in seen[0].collect()] == [300]
        with pytest.raises(KeyError), short_rows(spark):
            raise KeyError
        assert spark.conf.get(size) == "64"
    finally:
        spark.conf.set(size, before)


def test_long_chunks_do_not_pass_through_python(spark, monkeypatch):
    monkeypatch.setattr(TS, "LONG_CHUNK", 5)
    seen = []
    monkeypatch.setattr(TS, "materialise", lambda df, name: seen.append(materialise(df, name)) or seen[-1])
    rows = [("a", 0, "<thi"), ("a", 1, "nk>é"), ("a", 2, "éé long"), ("a", 3, "x"), ("a", 4, None), ("b", 0, "longest"), ("b", 0, "B"), ("b", 1, "c"), ("b", 0, "m")]
    df = spark.createDataFrame(rows, "reply_id string, seq int, chunk string").coalesce(1)
    assert {r.reply_id: (r.think, r.answer) for r in split_chunked_replies(df).collect()} == {"a": ("ééé longx", ""), "b": ("", "Blongestmc")}
    assert sorted((r.reply_id, r.text, r.sizes) for r in seen[0].collect() if len(r.text) > 5 and r.sizes[0] > 5) == [("a", "éé long", [7]), ("b", "longest", [7])]


def test_replies_are_cut_once_and_exploded_by_compiled_code(spark, monkeypatch, capsys, tmp_path):
    lines = [(1, 5, 7, 1), (1, 6, 10, 2), (2, 7, 3, 1), (2, 8, 3, 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    cut, adaptive = [], "spark.sql.adaptive.enabled"
    monkeypatch.setattr(Q, "split_chunked_replies", lambda chunks: cut.append(chunks) or split_chunked_replies(chunks))
    before = spark.conf.get(adaptive)
    spark.conf.set(adaptive, "false")  # an adaptive plan shows no code before it runs
    try:
        got = Q.q_think_stream(spark, str(tmp_path))
        assert sorted(got.collect()) == sorted(Q.q_think_split(spark, str(tmp_path)).collect())
        assert cut[0]._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1
        capsys.readouterr()
        cut[0].explain("codegen")
        # The JVM does not compile a method of 8,000 bytes or more.
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 8000
    finally:
        spark.conf.set(adaptive, before)


def _run_stream(spark, df_stream, name):
    q = df_stream.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.sql(f"SELECT * FROM {name}")


def test_stream_think_split(spark, tmp_path):
    chunks = _chunks_df(spark, TEXTS, 2)
    # deliver in two files, the second half first, to exercise out-of-order chunks
    chunks.filter("seq % 2 = 1").write.parquet(str(tmp_path / "in" / "a"))
    chunks.filter("seq % 2 = 0").write.parquet(str(tmp_path / "in" / "b"))
    src = spark.readStream.schema(chunks.schema).option("maxFilesPerTrigger", 1) \
        .parquet(str(tmp_path / "in" / "*"))
    out = _run_stream(spark, stream_think_split(src), "think_seg").toPandas()
    got = {}
    for rid, g in out.sort_values(["reply_id", "out_seq"]).groupby("reply_id"):
        got[rid] = ("".join(g[g.channel == "think"].text), "".join(g[g.channel == "answer"].text))
        assert g.is_last.iloc[-1]
    exp = {f"r{i}": batch_split(t) for i, t in enumerate(TEXTS)}
    assert got == exp


def test_stream_step_metrics_equals_batch(spark, tmp_path):
    rows = [(s, f"t{t}", i, (s * 7 + t * 3 + i) % 4 / 3.0, "c" * (10 * i + 3000 * (t == 1)))
            for s in range(3) for t in range(3) for i in range(5)]
    roll = spark.createDataFrame(rows, "step int, task_id string, sample_ix int, test_score double, completion string")
    timing = spark.createDataFrame([(s, 10.0 + s, 1.5) for s in range(3)], "step int, elapsed_sec double, peak_gb double")
    roll.write.parquet(str(tmp_path / "roll"))
    timing.write.parquet(str(tmp_path / "timing"))
    rs = spark.readStream.schema(roll.schema).parquet(str(tmp_path / "roll"))
    ts = spark.readStream.schema(timing.schema).parquet(str(tmp_path / "timing"))
    got = _run_stream(spark, stream_step_metrics(rs, ts), "step_m").toPandas().sort_values("step")
    scored = roll.select("step", "task_id", "sample_ix", F.col("test_score").alias("score"),
                         F.length("completion").alias("completion_chars"))
    exp = ME.step_metrics(scored, timing).toPandas().sort_values("step")
    cols = list(exp.columns)
    pd.testing.assert_frame_equal(got[cols].reset_index(drop=True), exp[cols].reset_index(drop=True),
                                  check_dtype=False, atol=1e-9)


def test_stream_memory(spark, tmp_path):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "hi"), (1, 2, "assistant", "<think>r</think> ok "),
            (1, 3, "user", "  "), (1, 4, "user", "/reset"), (1, 5, "user", "again"), (1, 6, "assistant", "a"),
            (1, 7, "user", "more")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "chat"))
    src = spark.readStream.schema(df.schema).parquet(str(tmp_path / "chat"))
    out = _run_stream(spark, stream_memory(src, max_turns=1), "mem").toPandas()
    last = out[out.at_turn == 7].sort_values("pos")
    assert list(zip(last.role, last.content))[1:] == [("assistant", "a"), ("user", "more")]
    first = out[out.at_turn == 1].sort_values("pos")
    assert list(first.role) == ["system", "user"]
    assert set(out.at_turn) == {1, 5, 7}


class FakeState:
    """Keyed state of one key between calls of a state function."""

    def __init__(self):
        self.value, self.hasTimedOut, self.timeout = None, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def remove(self):
        self.value = None

    def setTimeoutDuration(self, ms):
        self.timeout = ms


def _feed(fn, key, state, batches, columns):
    return [tuple(r) for b in batches for out in fn((key,), iter([pd.DataFrame(b, columns=columns)]), state)
            for r in out.itertuples(index=False)]


CHUNK = ["seq", "chunk", "is_final"]


def test_think_stream_ignores_redelivery_and_late_chunks():
    state = FakeState()
    out = _feed(_stream_group, "r", state, [[(1, "b", True)], [(0, "<think>a</think>", False)]], CHUNK)
    assert [r[2:4] for r in out] == [("think", "a"), ("answer", "b"), ("end", "")]
    assert _feed(_stream_group, "r", state, [[(0, "<think>a</think>", False)], [(1, "b", True)], [(2, "c", False)]], CHUNK) == []
    assert state.get[4] == "{}"


def test_think_stream_idle_reply_is_closed_with_all_it_holds():
    state = FakeState()
    fn = partial(_stream_group, idle_ms=1000)
    first = _feed(fn, "r", state, [[(0, "ab", False)], [(2, "ef", False)]], CHUNK)
    assert first == [] and state.timeout == 1000
    state.hasTimedOut = True
    rest = [tuple(r) for out in fn(("r",), iter([]), state) for r in out.itertuples(index=False)]
    assert "".join(r[3] for r in rest) == "abef" and rest[-1][4] and not state.exists


class StateCell:
    """Value or list state of one key that counts its calls."""

    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    put = update

    def appendList(self, rows):
        self.calls, self.value = self.calls + 1, [*(self.value or []), *rows]

    def clear(self):
        self.calls, self.value = self.calls + 1, None


@pytest.mark.parametrize("chunks, asks_list", [(20, False), (100, True)])
def test_early_chunks_wait_in_the_value_while_they_are_few(chunks, asks_list):
    value, early = StateCell(), StateCell()
    fold = ThinkProcessor(0, None)
    fold.init(type("Handle", (), {"getValueState": lambda self, *a: value, "getListState": lambda self, *a: early})())
    rows = [("r", i, f"<think>{i}</think>{i};", i == chunks - 1) for i in range(chunks)]
    again = [("r", 7, "other", False)]
    out, half = [], chunks // 2
    for batch in (rows[half:], again + rows[1:half], [], rows[:1], rows[:5]):
        out += fold.handleInputRows(("r",), iter(batch), None) if batch else []
    at7 = "other" if half > 7 else "<think>7</think>7;"
    want = batch_split("".join(at7 if i == 7 else r[2] for i, r in enumerate(rows)))
    assert ("".join(r.text for r in out if r.channel == "think"), "".join(r.text for r in out if r.channel == "answer")) == want
    assert [r.out_seq for r in out] == list(range(len(out))) and out[-1].is_last and value.value[0] is None
    assert value.calls == 7 and (early.calls > 0) == asks_list and not early.value


def _one_file_per_trigger(spark, path, df, parts):
    for i, part in enumerate(parts):
        df.filter(part).coalesce(1).write.parquet(f"{path}/{i}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


STEP_ROWS = [(s, f"t{t}", i, (s * 7 + t * 3 + i) % 4 / 3.0, "c" * (10 * i + 3000 * (t == 1)))
             for s in range(2) for t in range(3) for i in range(5)]


@pytest.mark.parametrize("expected", [True, False])
@pytest.mark.parametrize("parts", [("sample_ix < 2", "sample_ix >= 2"), ("sample_ix >= 2", "sample_ix < 2")])
def test_step_metrics_over_several_batches(parts, expected):
    fn = _make_fn(4, 512)
    frame = pd.DataFrame([("rollout", s, t, i, x, len(c), None, None, None) for s, t, i, x, c in STEP_ROWS if s == 1],
                         columns=["kind", "step", "task_id", "sample_ix", "score", "chars", "elapsed_sec", "peak_gb", "n_rollouts"])
    flush = frame.head(1).assign(kind="flush", elapsed_sec=3.0, peak_gb=1.0, n_rollouts=15 if expected else None)
    batches = [flush] + [frame.query(p) for p in parts]
    state = FakeState()
    out = [list(o.to_dict("records")) for b in batches for o in fn((1,), iter([b]), state)]
    assert len(out) == (1 if expected else 2)
    whole = next(fn((1,), iter([frame, flush]), FakeState())).to_dict("records")
    assert out[-1][0] == pytest.approx(whole[0])
    if expected:
        assert state.get[4] == "done" and list(fn((1,), iter([frame]), state)) == []


def test_step_metrics_deviation_of_equal_scores():
    groups = {}
    _fold(groups, pd.DataFrame({"task_id": ["t"] * 100_000, "sample_ix": range(100_000), "score": 0.7, "chars": 1}), 4, 500.0)
    assert _record(1, groups, None, None)["reward_std"] == 0.0


CHAT = [(1, 0, "system", "s"), (1, 1, "user", " hi "), (1, 2, "assistant", "<think>r</think> ok "), (1, 3, "user", "  "),
        (1, 4, "user", "/reset"), (1, 5, "user", "again"), (1, 6, "assistant", "a"), (1, 7, "user", " more ")]


def test_batch_memory_keeps_system_turn_and_equals_stream(spark, tmp_path):
    df = spark.createDataFrame(CHAT, "conv_id long, turn long, role string, text string")
    batch = CV.memory_window(CV.answer_only_history(CV.after_last_reset(CV.user_inputs(df))), max_turns=1).orderBy("turn").collect()
    assert [(r.turn, r.text) for r in batch] == [(0, "s"), (6, "a"), (7, "more")]
    for name, parts in {"late": ("turn % 2 = 1", "turn % 2 = 0", "turn = 5"), "early": ("turn < 4", "turn >= 4", "turn < 6")}.items():
        src = _one_file_per_trigger(spark, str(tmp_path / name), df, parts)
        out = _run_stream(spark, stream_memory(src, max_turns=1), f"mem_{name}").toPandas()
        assert sorted(set(out.at_turn)) == [1, 5, 7] and not out.duplicated(["at_turn", "pos"]).any()
        last = out[out.at_turn == 7].sort_values("pos")
        assert list(last.content)[1:] == [r.text for r in batch][1:]


def test_memory_exit_ends_the_conversation():
    state = FakeState()
    fn = _memory_fn(2, "S")
    out = _feed(fn, 1, state, [[(0, "user", "a")], [(1, "user", "/exit")], [(2, "user", "b")]], ["turn", "role", "text"])
    assert [r[1] for r in out] == [0, 0] and state.get[2] == "{}"


def test_repeated_rollout_does_not_stand_in_for_a_missing_one():
    columns = ["kind", "step", "task_id", "sample_ix", "score", "chars", "elapsed_sec", "peak_gb", "n_rollouts"]
    rows = pd.DataFrame([("rollout", 1, "t", i, float(i), 10 * i, None, None, None) for i in range(6)], columns=columns)
    flush = rows.head(1).assign(kind="flush", elapsed_sec=3.0, peak_gb=1.0, n_rollouts=6)
    fn, state = _make_fn(4, 512), FakeState()
    batches = [flush, rows.head(5), rows.iloc[[4, 0]], rows.tail(1)]
    out = [o.to_dict("records")[0] for b in batches for o in fn((1,), iter([b]), state)]
    whole = next(fn((1,), iter([rows, flush]), FakeState())).to_dict("records")[0]
    assert out == [pytest.approx(whole)] and out[0]["completion_chars_max"] == 50
