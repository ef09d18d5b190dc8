"""Registered queries that run a job (a stream, a sink, a chain of stages) below the
shared checkpoint folder and read its result back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.config import JobParams
from trainloom.functions import messages as M
from trainloom.functions.mutation import seeded_order_key
from trainloom.functions.tokens import learned_characters, token_mask
from trainloom.operators import conversations as CV
from trainloom.operators import datasets as DS
from trainloom.operators import hooks as H
from trainloom.operators.accounting import StageCounts
from trainloom.operators.builders import build
from trainloom.operators.indexing import seeded_shuffle
from trainloom.operators.metrics import step_groups
from trainloom.operators.rewards import score_rows
from trainloom.operators.sampling import seeded_cap, tail
from trainloom.plans import queries as Q
from trainloom.plans.derived import Derived
from trainloom.sources.logs import ROLLOUT_LOG_KEYED_SCHEMA, STEP_METRICS_SCHEMA
from trainloom.sources.shared import as_stream, drain, materialise, shared_path
from trainloom.sources.sinks import BatchLog, newest_snapshots, snapshot_stream
from trainloom.streaming.list_state import stream_chat_context, stream_think_segments
from trainloom.streaming.step_state import stream_step_records

R6 = Q.r6


def _rollout_rows(d: Derived) -> DataFrame:
    return Q._scored(d).select("run_id", "step", "task_id", "sample_ix", "completion", F.col("frac").alias("test_score"))


def _metric_columns(m: DataFrame) -> DataFrame:
    return m.select(*[R6(c).alias(c) if t == "double" else F.col(c).cast("bigint").alias(c) for c, t in m.dtypes])


# -- T2 -------------------------------------------------------------------------------

def q_step_metrics_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The step records of a stream of all rollouts, a tenth of them delivered twice."""
    d = Derived(spark, sf)
    rows = materialise(_rollout_rows(d).drop("run_id"), "graded")  # delivered twice, graded once
    again = rows.where(F.pmod(F.xxhash64("task_id"), F.lit(10)) == 0)
    timing = d.timing().join(d.rollouts().groupBy("step").agg(F.count("*").alias("n_rollouts")), "step", "left")
    rollouts = as_stream(rows.unionByName(again), "rollouts")
    return _metric_columns(drain(stream_step_records(rollouts, as_stream(timing, "timing", 1)), "step-records"))


# -- S3, S4, S5 -----------------------------------------------------------------------

def q_rollout_log(spark: SparkSession, sf: str) -> DataFrame:
    """S3: every rollout appended to the log by a stream; its first batch is delivered twice."""
    path = shared_path(spark, "rollout-log")
    log = BatchLog(f"{path}/log", "stream", compression="gzip")

    def deliver(batch: DataFrame, batch_id: int) -> None:
        log.write(batch, batch_id)
        if batch_id == 0:
            log.write(batch, batch_id)

    rows = as_stream(_rollout_rows(Derived(spark, sf)), "rollouts")
    rows.writeStream.foreachBatch(deliver).option("checkpointLocation", f"{path}/progress").trigger(availableNow=True).start().awaitTermination()
    back = log.read(spark, ROLLOUT_LOG_KEYED_SCHEMA)
    return back.select("run_id", F.col("step").cast("bigint").alias("step"), "task_id", F.col("sample_ix").cast("bigint").alias("sample_ix"), "completion",
                       R6("test_score").alias("test_score"))


def q_metrics_log(spark: SparkSession, sf: str) -> DataFrame:
    """Step records appended by two jobs, one of them run twice and one without rows."""
    log = BatchLog(shared_path(spark, "metrics-log"))
    # One row per step, appended four times: computed once.
    metrics = materialise(Q._step_metrics(Derived(spark, sf)), "step-metrics")
    for job, part in ((0, "step % 2 = 0"), (1, "step % 2 = 1"), (1, "step % 2 = 1"), (2, "step < 0")):
        log.write(metrics.where(part), job)
    return _metric_columns(log.read(spark, STEP_METRICS_SCHEMA))


def q_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots of every tenth step, read as they come; those of every twentieth are
    written again, in full, and the stream goes on where it stopped."""
    path = shared_path(spark, "snapshots")
    name = F.format_string("completions_%05d", F.col("step"))
    rows = Derived(spark, sf).rollouts().where("step % 10 = 0").select("task_id", "sample_ix", "completion", name.alias("name"), "step")
    schema = "task_id string, sample_ix int, completion string"
    table = None
    for part, which in (("early", "sample_ix = 0"), ("final", "step % 20 = 0")):
        rows.where(which).drop("step").repartition("name").write.partitionBy("name").parquet(f"{path}/files/{part}")
        table = drain(snapshot_stream(spark, f"{path}/files", schema, max_files=8), "snapshots", f"{path}/read")
    return newest_snapshots(table).groupBy("step").agg(F.count("*").alias("completions"), F.sum(F.length("completion")).alias("chars")).withColumn(
        "step", F.col("step").cast("bigint"))


# -- T1, T3 on list state -------------------------------------------------------------

def q_think_segments_stream(spark: SparkSession, sf: str) -> DataFrame:
    """A reply per document, in chunks of 500 characters, streamed out of order and joined by channel."""
    r = Derived(spark, sf).document_replies()
    pieces = r.select("reply_id", Q.chunk_text("reply", F.lit(500)).alias("pieces"))
    chunks = pieces.select("reply_id", F.posexplode("pieces").alias("seq", "chunk"), (F.size("pieces") - 1).alias("last"))
    chunks = chunks.select("reply_id", "seq", "chunk", (F.col("seq") == F.col("last")).alias("is_final"))
    # Chunks of a reply lie in different files, so that they come early and late.
    segments = drain(stream_think_segments(as_stream(chunks, "chunks", by="chunk")), "segments")
    text = lambda channel: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(
        F.col("channel") == channel, F.struct("out_seq", "text")))), lambda s: s.getField("text")), "")
    return segments.groupBy("reply_id").agg(text("think").alias("think"), text("answer").alias("answer"))


def q_chat_context_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The model's context after each user turn of a stream of chat turns."""
    turns = Derived(spark, sf).chat_inputs()
    out = drain(stream_chat_context(as_stream(turns, "turns", by="text")), "contexts")
    return out.withColumn("pos", F.col("pos").cast("bigint"))


# -- L1, L4, L5, A4 -------------------------------------------------------------------

def q_shuffled_index(spark: SparkSession, sf: str) -> DataFrame:
    """L1 + L4: every task with its place after the seeded shuffle."""
    return seeded_shuffle(Derived(spark, sf).tasks().select("task_id"), "task_id")


def q_unprobed_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """The tasks after the first 48 by key."""
    return tail(Derived(spark, sf).tasks().select("task_id"), "task_id", C.CURRICULUM_SAMPLE_SIZE)


def q_step_groups(spark: SparkSession, sf: str) -> DataFrame:
    """A4 over whole steps: consecutive runs of four rollouts."""
    g = step_groups(Q._step_input(Derived(spark, sf)))
    return g.select(F.col("step").cast("bigint").alias("step"), F.col("grp").cast("bigint").alias("grp"), F.col("n").cast("bigint").alias("n"),
                    R6("lo").alias("lo"), R6("hi").alias("hi"), "zero_variance")


# -- D1, D2 ---------------------------------------------------------------------------

def q_rewards_plugin(spark: SparkSession, sf: str) -> DataFrame:
    """Both rewards as plug-ins over batches, in one pass."""
    def correctness(prompts, completions, frac):
        return [C.CORRECTNESS_WEIGHT * x for x in frac]

    def format(prompts, completions, **columns):
        return [(C.FORMAT_THINK_BONUS if C.THINK_OPEN in c and C.THINK_CLOSE in c else 0.0)
                + (C.FORMAT_FENCE_BONUS if c.count(C.FENCE_PYTHON) == 1 else 0.0) for c in completions]

    rows = Q._scored(Derived(spark, sf)).select("task_id", F.col("sample_ix").cast("bigint").alias("sample_ix"), "completion", "frac")
    s = score_rows(rows, {"correctness": correctness, "format": format}, ["task_id", "sample_ix"], prompt="task_id", columns=["frac"])
    return s.select("task_id", "sample_ix", R6("correctness").alias("correctness"), R6("format").alias("format"), R6(F.col("correctness") + F.col("format")).alias("total"))


def q_rl_prompts_mapped(spark: SparkSession, sf: str) -> DataFrame:
    """The RL prompt builder as a row callable behind a predicate callable; equals ``rl_prompts_all``."""
    def to_prompt(row):
        tests = row["test_list"] or []
        user = (row["text"] or row["prompt"] or "").strip() + C.PUBLIC_EXAMPLE_HEADER + "\n".join(tests[:1])
        return {"task_id": row["task_id"], "prompt": [{"role": "system", "content": C.CODE_SYSTEM_PROMPT}, {"role": "user", "content": user}],
                "tests": tests[1:] if len(tests) > 1 else tests, "public_tests": tests[:1], "setup": row["test_setup_code"] or "",
                "public_is_hidden": len(tests) == 1 or bool(row["no_such_column"])}

    tasks = H.keep_where(Derived(spark, sf).tasks(), lambda key, missing: key is not None and missing is None, ["task_id", "no_such_column"])
    schema = f"task_id string, prompt {M.MESSAGE_TYPE}, tests array<string>, public_tests array<string>, setup string, public_is_hidden boolean"
    columns = ["task_id", "text", "prompt", "test_list", "test_setup_code", "no_such_column"]
    return Q._prompt_rows(H.map_rows(tasks, to_prompt, schema, columns))


def q_indexed_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """D2 + L4: a callable that gets each task's place after the seeded shuffle."""
    tasks = Derived(spark, sf).tasks()
    fn = lambda row, i: {"task_id": row["task_id"], "seed": C.SHUFFLE_SEED + i, "code_chars": len(row["code"] or "")}
    return H.map_indexed(tasks, fn, "task_id string, seed long, code_chars long", [seeded_order_key(C.SHUFFLE_SEED, "task_id"), "task_id"], ["task_id", "code"])


def q_reply_lengths_batched(spark: SparkSession, sf: str) -> DataFrame:
    """A batched callable over replies, 64 at a time."""
    def lengths(batch):
        chars = [len(c or "") for c in batch["completion"]]
        return {"task_id": batch["task_id"], "sample_ix": batch["sample_ix"], "chars": chars, "approx_tokens": [c / 4 for c in chars]}

    return H.map_batches(Q._replies(spark, sf), lengths, "task_id string, sample_ix long, chars long, approx_tokens double")


# -- M10, M11 with a tokenizer --------------------------------------------------------

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    import public_tokenizers  # only these two queries need the package
    return public_tokenizers.path(TOKENIZER)


def q_sft_records_exact(spark: SparkSession, sf: str) -> DataFrame:
    """M10 + F3 + P3: every conversation whose rendered text has at most 512 tokens."""
    out = DS.sft_records_exact(Derived(spark, sf).table("conversations"), tokenizer_path(), max_tokens=512)
    return out.withColumn("n_messages", F.col("n_messages").cast("bigint"))


def q_sft_token_mask(spark: SparkSession, sf: str) -> DataFrame:
    """The ranges of tokens that each conversation is learned from."""
    recs = CV.to_messages(Derived(spark, sf).table("conversations")).withColumn("messages", M.ensure_system("messages"))
    mask = token_mask(M.render_chat("messages"), learned_characters("messages"), tokenizer_path())
    out = recs.select("conv_id", mask.alias("m"))
    return out.select("conv_id", "m.n_tokens", F.posexplode("m.learned").alias("pos", "r")).select(
        "conv_id", "n_tokens", F.col("pos").cast("bigint").alias("pos"), "r.start", "r.stop")


# -- A13, F4 --------------------------------------------------------------------------

def q_sft_stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A13 + F3 + F4: rows of each stage of the SFT builder, counted while its records are written."""
    p, counts = JobParams(), StageCounts()
    turns = Derived(spark, sf).table("conversations").select("conv_id", "turn", "role", "text")
    lengths = counts.count(DS.conversation_token_lengths(turns), "loaded")
    fits = counts.count(lengths.where(F.col("token_length") <= p.max_seq_length), "fits")
    chosen = seeded_cap(fits, "conv_id", 60, p.seed).select("conv_id")
    records = counts.count(CV.to_messages(turns.join(chosen, "conv_id")), "records")
    materialise(records, "records")
    counts.require()
    return counts.rows(spark)


# -- D3, S2 ---------------------------------------------------------------------------

def q_smoke_rl_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """D3 + S2 + F4: the RL prompts of a smoke run by the builder's name: 30 of the first 120 tasks."""
    return Q._prompt_rows(build("rl_prompts", Derived(spark, sf).tasks(), JobParams(grpo_max_samples=30), smoke=True))


def q_smoke_repair_sft(spark: SparkSession, sf: str) -> DataFrame:
    """D3 + S2 + F4: repair trajectories of a smoke run, at most 30 from the first 120 tasks."""
    out = build("repair_sft", Derived(spark, sf).tasks(), JobParams(repair_max_samples=30), smoke=True)
    return Q.explode_messages(out.withColumn("rule", F.col("rule").cast("bigint")), "task_id", "messages", "rule", "mutated_code")


JOBS = {
    "step_metrics_stream": q_step_metrics_stream,
    "rollout_log": q_rollout_log,
    "metrics_log": q_metrics_log,
    "snapshots": q_snapshots,
    "think_segments_stream": q_think_segments_stream,
    "chat_context_stream": q_chat_context_stream,
    "shuffled_index": q_shuffled_index,
    "unprobed_tasks": q_unprobed_tasks,
    "step_groups": q_step_groups,
    "rewards_plugin": q_rewards_plugin,
    "rl_prompts_mapped": q_rl_prompts_mapped,
    "indexed_tasks": q_indexed_tasks,
    "reply_lengths_batched": q_reply_lengths_batched,
    "sft_records_exact": q_sft_records_exact,
    "sft_token_mask": q_sft_token_mask,
    "sft_stage_counts": q_sft_stage_counts,
    "smoke_rl_prompts": q_smoke_rl_prompts,
    "smoke_repair_sft": q_smoke_repair_sft,
}
