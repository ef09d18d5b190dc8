"""Rollout groups, per-step training-health summaries and the run report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.functions import text as T
from trainloom.operators.indexing import numbered


def group_index(sample_ix: str = "sample_ix", n: int = C.NUM_GENERATIONS):
    """Fixed-size chunk of a per-prompt generation sequence (0-based index)."""
    return F.floor(F.col(sample_ix) / F.lit(max(1, n))).cast("bigint")


def rollout_groups(scored: DataFrame, n: int = C.NUM_GENERATIONS,
                   max_completion_length: int = C.MAX_COMPLETION_LENGTH) -> DataFrame:
    """A4 (first level): one row per rollout group = (step, prompt, chunk of n).

    Input columns: step, task_id, sample_ix, score, completion_chars. A group is
    zero-variance when it has more than one score and max - min < 1e-6.
    """
    trunc = T.is_truncated("completion_chars", max_completion_length)
    return (scored.groupBy("step", "task_id", group_index("sample_ix", n).alias("grp"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.min("score").alias("lo"), F.max("score").alias("hi"),
                 F.sum("score").alias("s1"),
                 F.sum("completion_chars").alias("chars"), F.max("completion_chars").alias("chars_max"),
                 F.count_if(trunc).alias("n_trunc"))
            .withColumn("zero_variance", (F.col("n") > 1) & ((F.col("hi") - F.col("lo")) < C.ZERO_VARIANCE_EPS)))


def step_groups(scored: DataFrame, n: int = C.NUM_GENERATIONS, order: tuple[str, ...] = ("task_id", "sample_ix")) -> DataFrame:
    """A4 over whole steps: the rollouts of a step in ``order``, cut into runs of ``n``. A run
    may straddle prompts and the last one may be short. Returns step, grp, n, lo, hi, zero_variance.

    Places come from a distributed numbering, so a step of any size is not gathered.
    """
    rows = numbered(scored.select("step", *order, "score"), list(order), by=["step"], name="row_index")
    runs = rows.groupBy("step", F.floor(F.col("row_index") / F.lit(max(1, n))).alias("grp"))
    return (runs.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"))
            .withColumn("zero_variance", (F.col("n") > 1) & ((F.col("hi") - F.col("lo")) < C.ZERO_VARIANCE_EPS)))


def step_metrics(scored: DataFrame, timing: DataFrame | None = None, n: int = C.NUM_GENERATIONS,
                 max_completion_length: int = C.MAX_COMPLETION_LENGTH) -> DataFrame:
    """A5: one record per step with scores: mean, population std (0.0 for one
    score), zero-variance groups, groups, mean/max chars, approximate
    truncation rate, and (from ``timing``) seconds and peak GB rounded to 3.

    Two aggregation levels: groups, then steps; both combine map-side, so the
    shuffles carry partial sums rather than rollouts.
    """
    g = rollout_groups(scored, n, max_completion_length)
    cnt = F.sum("n")
    mean = F.sum("s1") / cnt
    # stddev_pop merges (count, mean, M2) and stays exact for equal scores.
    spread = scored.groupBy("step").agg(
        F.when(F.max("score") > F.min("score"), F.stddev_pop("score")).otherwise(F.lit(0.0)).alias("reward_std"))
    out = (g.groupBy("step")
           .agg(mean.alias("reward_mean"),
                F.count_if("zero_variance").cast("int").alias("zero_variance_groups"),
                F.count(F.lit(1)).cast("int").alias("num_groups"),
                (F.sum("chars") / cnt).alias("completion_chars_mean"),
                F.max("chars_max").cast("int").alias("completion_chars_max"),
                (F.sum("n_trunc") / cnt).alias("truncation_rate_approx"))
           .join(spread, "step")
           .select("step", "reward_mean", "reward_std", "zero_variance_groups", "num_groups", "completion_chars_mean",
                   "completion_chars_max", "truncation_rate_approx"))
    if timing is None:
        return (out.withColumn("sec_per_step", F.lit(None).cast("double"))
                   .withColumn("peak_vram_gb", F.lit(None).cast("double")))
    t = timing.select("step", F.round("elapsed_sec", 3).alias("sec_per_step"),
                      F.round("peak_gb", 3).alias("peak_vram_gb"))
    return out.join(t, "step", "left")


def run_report(metrics: DataFrame, k: int = 20) -> DataFrame:
    """A10 (+W3): steps, total/mean step time, mean reward over the first k,
    last k and all steps, zero-variance steps, non-finite rows, late
    truncation, peak memory. First/last k are scalar subqueries over top-k."""
    first_cut = metrics.select("step").orderBy(F.col("step").asc()).limit(k).agg(F.max("step")).scalar()
    last_cut = metrics.select("step").orderBy(F.col("step").desc()).limit(k).agg(F.min("step")).scalar()
    rm = F.col("reward_mean")
    finite = ~(F.isnan(rm) | (F.abs(rm) == F.lit(float("inf"))))
    return metrics.agg(
        F.count(F.lit(1)).alias("steps"),
        F.sum("sec_per_step").alias("total_sec"),
        F.avg("sec_per_step").alias("mean_sec_per_step"),
        F.avg(F.when(F.col("step") <= first_cut, rm)).alias("reward_first_k"),
        F.avg(F.when(F.col("step") >= last_cut, rm)).alias("reward_last_k"),
        F.avg(rm).alias("reward_all"),
        F.count_if(F.col("reward_std") < C.ZERO_VARIANCE_EPS).alias("zero_variance_steps"),
        F.count_if(rm.isNull() | ~finite).alias("non_finite_rows"),
        F.avg(F.when(F.col("step") >= last_cut, F.col("truncation_rate_approx"))).alias("truncation_last_k"),
        F.max("peak_vram_gb").alias("peak_vram_gb"))
