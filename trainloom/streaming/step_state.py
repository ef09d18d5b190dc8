"""T2 as a keyed state machine of two levels, in RocksDB.

Level 1 is keyed by (step, bucket): rollout groups are spread over buckets, so the rows
of one step never meet in one key. One value state holds the bucket's summary and, packed
as an Arrow table, the samples it has seen; a micro-batch reads and writes it once per
bucket, not once per group, and folds whole columns. With news it passes the summary on.

Level 2 is keyed by step and folds one summary per bucket, a fixed number, with the
step's timing row (step, elapsed_sec, peak_gb). Rollouts may come after it: with a
column ``n_rollouts`` in the timing row the record is emitted once, when that many
were seen; without it, again, corrected, whenever rollouts come later, and the last
record of a step holds. A step that saw no scores emits nothing.

A rollout (task_id, sample_ix) that is delivered again counts once. Rows without a step,
a sample number or a score are left out. What comes for a step that was emitted for good
changes nothing. With ``ttl_ms``, state that saw no news for so long is evicted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trainloom import config as C

SUMMARY = ("n long, groups long, flat_groups long, lo double, hi double, total double, spread double, "
           "chars long, chars_max long, truncated long")
_SUMMARY = [c.split()[0] for c in SUMMARY.split(", ")]
BUCKET_ROWS = f"step int, bucket int, {SUMMARY}"
RECORD = ("step int, reward_mean double, reward_std double, zero_variance_groups int, num_groups int, "
          "completion_chars_mean double, completion_chars_max int, truncation_rate_approx double, "
          "sec_per_step double, peak_vram_gb double")


_SAMPLES = pa.schema([("task_id", pa.string()), ("sample_ix", pa.int64()), ("score", pa.float64())])


def _packed(samples: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _SAMPLES, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(pa.Table.from_pandas(samples, _SAMPLES, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(samples: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(samples).read_all().to_pandas()


def _added(s: dict, new: pd.DataFrame, truncated_from: float) -> dict:
    """The summary ``s`` with the samples ``new``, apart from the counts of groups."""
    score, chars = new["score"].to_numpy(), new["chars"].to_numpy()
    n, total = s["n"] + len(score), s["total"] + score.sum()
    mean = score.sum() / len(score)
    spread = s["spread"] + ((score - mean) ** 2).sum()
    if s["n"]:
        spread += (mean - s["total"] / s["n"]) ** 2 * s["n"] * len(score) / n
    return {"n": n, "groups": s["groups"], "flat_groups": s["flat_groups"], "lo": float(np.fmin.reduce(score, initial=s["lo"])),
            "hi": float(np.fmax.reduce(score, initial=s["hi"])), "total": float(total), "spread": float(spread), "chars": s["chars"] + int(chars.sum()),
            "chars_max": max(s["chars_max"], int(chars.max())), "truncated": s["truncated"] + int((chars / 4.0 >= truncated_from).sum())}


class GroupFold(StatefulProcessor):
    """(step, bucket): rollouts -> running summary of the bucket's groups."""

    def __init__(self, group_size: int, truncated_from: float, ttl_ms: int | None):
        self.group_size, self.truncated_from, self.ttl_ms = group_size, truncated_from, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.bucket = handle.getValueState("bucket", f"samples binary, {SUMMARY}", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        # The first delivery of a sample counts.
        sample = ["task_id", "sample_ix"]
        new = pd.concat(list(rows), ignore_index=True)[[*sample, "score", "chars"]].drop_duplicates(sample)
        held = self.bucket.get()
        if held:
            seen, s = _unpacked(held[0]), dict(zip(_SUMMARY, held[1:]))
            both = pd.concat([seen, new], ignore_index=True)
            new = both[~both.duplicated(sample)].iloc[len(seen):]
            if not len(new):
                return
            samples = pd.concat([seen, new[seen.columns]], ignore_index=True)
        else:
            s = {"n": 0, "groups": 0, "flat_groups": 0, "lo": math.inf, "hi": -math.inf, "total": 0.0, "spread": 0.0, "chars": 0, "chars_max": 0, "truncated": 0}
            samples = new[[f.name for f in _SAMPLES]]
        s = _added(s, new, self.truncated_from)
        groups = samples.groupby(["task_id", samples["sample_ix"] // self.group_size], sort=False)["score"].agg(["size", "min", "max"])
        s["groups"] = len(groups)
        s["flat_groups"] = int(((groups["size"] > 1) & (groups["max"] - groups["min"] < C.ZERO_VARIANCE_EPS)).sum())
        self.bucket.update((_packed(samples), *(s[c] for c in _SUMMARY)))
        yield pd.DataFrame([(key[0], key[1], *(s[c] for c in _SUMMARY))], columns=["step", "bucket", *_SUMMARY])

    def close(self) -> None:
        pass


def record_of(step: int, parts: list[dict], elapsed: float | None, peak: float | None) -> dict:
    """The step's record from the summaries of its buckets."""
    n = sum(p["n"] for p in parts)
    mean = sum(p["total"] for p in parts) / n
    spread = sum(p["spread"] + p["n"] * (p["total"] / p["n"] - mean) ** 2 for p in parts)
    equal = max(p["hi"] for p in parts) == min(p["lo"] for p in parts)
    return {
        "step": step, "reward_mean": mean, "reward_std": 0.0 if equal else math.sqrt(spread / n),
        "zero_variance_groups": sum(p["flat_groups"] for p in parts), "num_groups": sum(p["groups"] for p in parts),
        "completion_chars_mean": sum(p["chars"] for p in parts) / n, "completion_chars_max": max(p["chars_max"] for p in parts),
        "truncation_rate_approx": sum(p["truncated"] for p in parts) / n,
        "sec_per_step": None if elapsed is None else round(elapsed, 3), "peak_vram_gb": None if peak is None else round(peak, 3)}


class StepFold(StatefulProcessor):
    """step: bucket summaries and the timing row -> the step's record."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buckets = handle.getMapState("buckets", "bucket int", SUMMARY, self.ttl_ms)
        self.timing = handle.getValueState("timing", "elapsed double, peak double, expected long", self.ttl_ms)
        self.done = handle.getValueState("done", "n long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timer_values) -> Iterator[Row]:
        if self.done.exists():
            for _ in rows:
                pass
            return
        for r in rows:
            if r.bucket is None:
                self.timing.update((r.elapsed, r.peak, r.expected))
                continue
            held = self.buckets.getValue((r.bucket,))
            if held is None or held[0] < r.n:  # of two summaries the later one knows more
                self.buckets.updateValue((r.bucket,), tuple(r[c] for c in _SUMMARY))
        timing = self.timing.get()
        if timing is None:
            return
        elapsed, peak, expected = timing
        parts = [dict(zip(_SUMMARY, v)) for _, v in sorted(self.buckets.iterator(), key=lambda x: x[0][0])]
        seen = sum(p["n"] for p in parts)
        if not seen or expected is not None and seen < expected:
            return
        if expected is not None:
            self.done.update((seen,))
            self.buckets.clear()
            self.timing.clear()
        yield Row(**record_of(key[0], parts, elapsed, peak))

    def close(self) -> None:
        pass


def stream_step_records(rollouts: DataFrame, timing: DataFrame, n: int = C.NUM_GENERATIONS, max_completion_length: int = C.MAX_COMPLETION_LENGTH,
                        buckets: int = 16, ttl_ms: int | None = None) -> DataFrame:
    """Step records from streams of rollouts (step, task_id, sample_ix, completion, test_score)
    and of timing rows. Output mode append, state in RocksDB (``rocksdb_state``). ``ttl_ms``
    is for streams that run on; it asks for a processing-time trigger."""
    mode = "ProcessingTime" if ttl_ms else "None"
    chars = F.length(F.coalesce(F.col("completion"), F.lit(""))).cast("long")
    rows = rollouts.where("step is not null and sample_ix is not null and test_score is not null").select(
        F.col("step").cast("int").alias("step"), F.coalesce(F.col("task_id").cast("string"), F.lit("")).alias("task_id"),
        F.col("sample_ix").cast("long").alias("sample_ix"), F.col("test_score").cast("double").alias("score"), chars.alias("chars"))
    bucket = F.pmod(F.xxhash64("task_id", F.floor(F.col("sample_ix") / n)), F.lit(buckets)).cast("int")
    fold = GroupFold(n, max_completion_length * C.TRUNCATION_FRACTION, ttl_ms)
    summaries = rows.withColumn("bucket", bucket).groupBy("step", "bucket").transformWithStateInPandas(fold, BUCKET_ROWS, "append", mode)
    expected = F.col("n_rollouts") if "n_rollouts" in timing.columns else F.lit(None)
    ends = timing.where("step is not null").select(
        F.col("step").cast("int").alias("step"), F.col("elapsed_sec").cast("double").alias("elapsed"),
        F.col("peak_gb").cast("double").alias("peak"), expected.cast("long").alias("expected"))
    both = summaries.unionByName(ends, allowMissingColumns=True)
    return both.groupBy("step").transformWithState(StepFold(ttl_ms), RECORD, "append", mode)
