"""Per-step metric accumulator over a stream of scored rollouts.

Rollout rows (step, task_id, sample_ix, completion, test_score) are folded
into per-group partial sums held in keyed state (one key per step); the
step's timing row (step, elapsed_sec, peak_gb) is the end-of-step signal. The two
sources have no common order, so rollouts may come after it: with a column
``n_rollouts`` in the timing row, the record is emitted once, when that many were
seen; without it, the record is emitted again, corrected, whenever rollouts come
after the timing row, and the last record of a step holds. A step that saw no
scores emits nothing. A rollout (task_id, sample_ix) that is delivered again counts
once. State per step is bounded by its number of rollout groups (sums, and one bit
per rollout seen); an emitted step with ``n_rollouts`` keeps a marker.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trainloom import config as C

OUT_SCHEMA = ("step int, reward_mean double, reward_std double, zero_variance_groups int, num_groups int, "
              "completion_chars_mean double, completion_chars_max int, truncation_rate_approx double, "
              "sec_per_step double, peak_vram_gb double")
STATE_SCHEMA = "groups string, elapsed double, peak double, expected long, phase string"


def _fold(groups: dict, pdf: pd.DataFrame, n: int, trunc_chars: float) -> None:
    for task, ix, score, chars in zip(pdf["task_id"].tolist(), pdf["sample_ix"].tolist(),
                                      pdf["score"].tolist(), pdf["chars"].tolist()):
        key = f"{task}|{int(ix) // n}"
        g = groups.get(key)
        t = 1 if chars / 4.0 >= trunc_chars else 0
        bit = 1 << int(ix) % n
        if g is None:
            groups[key] = [1, score, score, score, 0.0, chars, chars, t, bit]
        elif not g[8] & bit:
            # Squared deviations from the running mean stay exact for equal scores.
            off = score - g[3] / g[0]
            g[0] += 1
            g[1] = min(g[1], score)
            g[2] = max(g[2], score)
            g[3] += score
            g[4] += off * (score - g[3] / g[0])
            g[5] += chars
            g[6] = max(g[6], chars)
            g[7] += t
            g[8] |= bit


def _record(step: int, groups: dict, elapsed, peak) -> dict:
    cnt = sum(g[0] for g in groups.values())
    mean = sum(g[3] for g in groups.values()) / cnt
    var = sum(g[4] + g[0] * (g[3] / g[0] - mean) ** 2 for g in groups.values()) / cnt
    flat = max(g[2] for g in groups.values()) == min(g[1] for g in groups.values())
    return {
        "step": step, "reward_mean": mean, "reward_std": 0.0 if flat else math.sqrt(var),
        "zero_variance_groups": sum(1 for g in groups.values()
                                    if g[0] > 1 and g[2] - g[1] < C.ZERO_VARIANCE_EPS),
        "num_groups": len(groups),
        "completion_chars_mean": sum(g[5] for g in groups.values()) / cnt,
        "completion_chars_max": max(g[6] for g in groups.values()),
        "truncation_rate_approx": sum(g[7] for g in groups.values()) / cnt,
        "sec_per_step": None if elapsed is None else round(elapsed, 3),
        "peak_vram_gb": None if peak is None else round(peak, 3),
    }


def _make_fn(n: int, max_completion_length: int):
    trunc_chars = max_completion_length * C.TRUNCATION_FRACTION

    def fn(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        groups, elapsed, peak, expected, phase = {}, None, None, None, "open"
        if state.exists:
            groups_json, elapsed, peak, expected, phase = state.get
            groups = json.loads(groups_json)
        if phase == "done":
            return
        news = False
        for pdf in batches:
            rows = pdf[pdf["kind"] == "rollout"]
            if len(rows):
                _fold(groups, rows, n, trunc_chars)
                news = True
            flush = pdf[pdf["kind"] == "flush"]
            if len(flush):
                last = flush.iloc[-1]
                elapsed, peak = (None if pd.isna(last[c]) else float(last[c]) for c in ("elapsed_sec", "peak_gb"))
                expected = None if pd.isna(last["n_rollouts"]) else int(last["n_rollouts"])
                phase, news = "flushed", True
        seen = sum(g[0] for g in groups.values())
        ready = phase == "flushed" and news and groups and (expected is None or seen >= expected)
        if ready and expected is not None:
            state.update(("{}", elapsed, peak, expected, "done"))
        else:
            state.update((json.dumps(groups), elapsed, peak, expected, phase))
        if ready:
            yield pd.DataFrame([_record(int(key[0]), groups, elapsed, peak)])

    return fn


def stream_step_metrics(rollouts: DataFrame, timing: DataFrame, n: int = C.NUM_GENERATIONS,
                        max_completion_length: int = C.MAX_COMPLETION_LENGTH) -> DataFrame:
    """Streaming A5: union of rollout rows and end-of-step timing rows, keyed
    by step. Output mode: append (see above for which record of a step holds)."""
    expected = F.col("n_rollouts") if "n_rollouts" in timing.columns else F.lit(None)
    r = rollouts.select(F.lit("rollout").alias("kind"), F.col("step").cast("int").alias("step"),
                        F.col("task_id").cast("string").alias("task_id"),
                        F.col("sample_ix").cast("int").alias("sample_ix"),
                        F.col("test_score").cast("double").alias("score"),
                        F.length(F.coalesce(F.col("completion"), F.lit(""))).cast("int").alias("chars"),
                        F.lit(None).cast("double").alias("elapsed_sec"), F.lit(None).cast("double").alias("peak_gb"),
                        F.lit(None).cast("long").alias("n_rollouts"))
    t = timing.select(F.lit("flush").alias("kind"), F.col("step").cast("int").alias("step"),
                      F.lit(None).cast("string").alias("task_id"), F.lit(None).cast("int").alias("sample_ix"),
                      F.lit(None).cast("double").alias("score"), F.lit(None).cast("int").alias("chars"),
                      F.col("elapsed_sec").cast("double").alias("elapsed_sec"),
                      F.col("peak_gb").cast("double").alias("peak_gb"), expected.cast("long").alias("n_rollouts"))
    return (r.unionByName(t).groupBy("step")
            .applyInPandasWithState(_make_fn(n, max_completion_length), OUT_SCHEMA, STATE_SCHEMA, "append",
                                    GroupStateTimeout.NoTimeout))
