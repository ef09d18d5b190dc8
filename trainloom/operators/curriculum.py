"""Probe verdicts and the curriculum filter over RL tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.operators.sampling import head, seeded_cap


def probe_verdicts(probe_scores: DataFrame) -> DataFrame:
    """Per probed task, drop when every score is >= 1-1e-6 (all pass) or
    every score is <= 1e-6 (all fail); a probe that errored is kept."""
    eps = C.ZERO_VARIANCE_EPS
    agg = probe_scores.groupBy("task_id").agg(
        F.min("score").alias("min_score"), F.max("score").alias("max_score"),
        F.bool_or(F.coalesce(F.col("errored"), F.lit(False))).alias("errored"))
    all_pass = F.col("min_score") >= 1.0 - eps
    all_fail = F.col("max_score") <= eps
    return agg.withColumn("keep", F.col("errored") | ~(all_pass | all_fail))


def probe_head(tasks: DataFrame, sample_size: int = C.CURRICULUM_SAMPLE_SIZE, key: str = "task_id",
               seed: int = C.SHUFFLE_SEED) -> DataFrame:
    """Keys of the probed tasks: the first ``sample_size`` in the seeded order that
    shuffles and caps the RL tasks (0: no probe)."""
    keys = tasks.select(key)
    return seeded_cap(keys, key, sample_size, seed) if sample_size else keys.limit(0)


def curriculum_filter(tasks: DataFrame, probe_scores: DataFrame, sample_size: int = C.CURRICULUM_SAMPLE_SIZE,
                      key: str = "task_id", probed: DataFrame | None = None) -> DataFrame:
    """F5 = L3 + A6 + J3 + U1: probe the ``probed`` keys (by default the first
    ``sample_size`` tasks by key), drop the probed ones whose verdict is
    zero-variance, keep every un-probed task.

    A probed task without any probe score is kept (its probe produced nothing).
    Only the dropped ids (at most ``sample_size``) are broadcast.
    """
    probed = head(tasks.select(key), key, sample_size) if probed is None else probed
    scores = probe_scores.join(F.broadcast(probed), key, "left_semi")
    dropped = probe_verdicts(scores).filter(~F.col("keep")).select(key)
    return tasks.join(F.broadcast(dropped), key, "left_anti")


def curriculum_accounting(tasks: DataFrame, probe_scores: DataFrame, sample_size: int = C.CURRICULUM_SAMPLE_SIZE,
                          key: str = "task_id", probed: DataFrame | None = None) -> DataFrame:
    """Probed / dropped / kept-probed / un-probed / total after filtering."""
    probed = head(tasks.select(key), key, sample_size) if probed is None else probed
    probed = probed.withColumn("_probed", F.lit(True))
    scores = probe_scores.join(F.broadcast(probed.select(key)), key, "left_semi")
    verdict = probe_verdicts(scores).select(key, "keep")
    flagged = (tasks.select(key).join(F.broadcast(probed), key, "left")
               .join(F.broadcast(verdict), key, "left"))
    is_probed = F.coalesce(F.col("_probed"), F.lit(False))
    dropped = is_probed & (F.col("keep") == F.lit(False))
    return flagged.agg(
        F.count_if(is_probed).alias("probed"),
        F.count_if(dropped).alias("dropped"),
        F.count_if(is_probed & ~F.coalesce(dropped, F.lit(False))).alias("kept_probed"),
        F.count_if(~is_probed).alias("unprobed"),
        F.count_if(~F.coalesce(dropped, F.lit(False))).alias("total"))
