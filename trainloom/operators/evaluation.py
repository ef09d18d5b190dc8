"""Candidate selection (best-of-k, best attempt), grading joins and pass@1."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.functions import messages as M
from trainloom.functions import text as T


def best_of_k(candidates: DataFrame, k: int | None = None) -> DataFrame:
    """A8 selection (L6): per task, the candidate with the highest selection
    score, the earliest sample on ties (strict ``>`` keeps the first maximum).

    Input: task_id, sample_ix, code, has_public, public_frac, ran_ok. The score
    is the public-test fraction, or 1/0 "ran cleanly" when the task has no
    public tests. Only the first ``k`` samples compete. Hidden results are not
    an input here: they are joined to the winners only (``grade``).
    """
    c = candidates
    if k:
        c = c.filter(F.col("sample_ix") < k)
    score = F.when(F.col("has_public"), F.col("public_frac")).otherwise(
        F.when(F.col("ran_ok"), F.lit(1.0)).otherwise(F.lit(0.0)))
    c = c.withColumn("select_score", score)
    rank = F.struct(F.col("select_score"), (-F.col("sample_ix")).alias("neg_ix"))
    return c.groupBy("task_id").agg(
        F.max_by("sample_ix", rank).alias("sample_ix"),
        F.max_by("code", rank).alias("code"),
        F.max("select_score").alias("select_score"))


def grade(selected: DataFrame, hidden: DataFrame, keys=("task_id", "sample_ix")) -> DataFrame:
    """The selected candidate's hidden-test verdict; none -> failed."""
    h = hidden.groupBy(*keys).agg(F.bool_and(F.coalesce(F.col("passed"), F.lit(False))).alias("ok"))
    return (selected.join(h, list(keys), "left")
            .withColumn("ok", F.coalesce(F.col("ok"), F.lit(False))))


def graded_tasks(tasks: DataFrame, graded: DataFrame, settings: list[str]) -> DataFrame:
    """setting, task_id, ok for every task and setting; a task without a graded row has failed."""
    every = tasks.select("task_id", F.explode(F.array(*map(F.lit, settings))).alias("setting"))
    return every.join(graded.select("setting", "task_id", "ok"), ["setting", "task_id"], "left").select(
        "setting", "task_id", F.coalesce("ok", F.lit(False)).alias("ok"))


def pass_at_1(graded: DataFrame, by=("setting",)) -> DataFrame:
    """Passed / tasks and the task count per setting (0 tasks -> NULL)."""
    return graded.groupBy(*by).agg(
        F.try_divide(F.count_if("ok"), F.count(F.lit(1))).alias("pass_at_1"),
        F.count(F.lit(1)).alias("n"))


def comparison_table(pass_rates: DataFrame) -> DataFrame:
    """Setting -> pass@1 with ``{:.1%}`` text."""
    return pass_rates.withColumn("pass_at_1_text", T.percent("pass_at_1"))


def best_attempt(attempts: DataFrame, has_tests: DataFrame, max_iters: int = C.MAX_ITERS,
                 with_iter: bool = False) -> DataFrame:
    """Outcome of the execute/observe/revise loop per task.

    With tests: the first attempt scoring >= 1.0 wins with 1.0; otherwise the
    highest-scoring, earliest attempt -- and if its code is empty, the last
    attempt's code -- with the score floored at 0.0. Without tests: the first
    attempt that ran cleanly wins with 1.0, else the last code with 0.0.
    ``has_tests`` maps task_id -> boolean. Attempts at or past ``max_iters``
    never happen in the loop and are ignored. ``with_iter`` adds the iteration
    whose code was returned (``chosen_iter``), for grading.
    """
    a = attempts.filter(F.col("iter") < max_iters).withColumn("has_code", F.coalesce(F.col("code"), F.lit("")) != "") \
        .join(has_tests, "task_id", "left").withColumn("has_tests", F.coalesce(F.col("has_tests"), F.lit(False)))
    success = F.when(F.col("has_tests"), F.col("score") >= 1.0).otherwise(F.col("ran_ok"))
    a = a.withColumn("success", F.coalesce(success, F.lit(False)))
    rank = F.struct(F.col("score"), (-F.col("iter")).alias("neg_iter"))
    agg = a.groupBy("task_id").agg(
        F.first("has_tests").alias("has_tests"),
        F.min(F.when(F.col("success"), F.col("iter"))).alias("success_iter"),
        F.min_by("code", F.when(F.col("success"), F.col("iter"))).alias("success_code"),
        F.max_by("code", rank).alias("best_code"),
        F.max_by("has_code", rank).alias("best_has_code"),
        F.max_by("iter", rank).alias("best_iter"),
        F.max("score").alias("best_score"),
        F.max_by("code", F.col("iter")).alias("last_code"),
        F.max("iter").alias("last_iter"),
    )
    code = (F.when(F.col("success_iter").isNotNull(), F.col("success_code"))
            .when(F.col("has_tests"), F.coalesce(T.nonempty("best_code"), F.col("last_code")))
            .otherwise(F.col("last_code")))
    score = (F.when(F.col("success_iter").isNotNull(), F.lit(1.0))
             .when(F.col("has_tests"), F.greatest(F.col("best_score"), F.lit(0.0)))
             .otherwise(F.lit(0.0)))
    iters = F.coalesce(F.col("success_iter"), F.col("last_iter")) + 1
    chosen = (F.when(F.col("success_iter").isNotNull(), F.col("success_iter"))
              .when(F.col("has_tests") & F.col("best_has_code"), F.col("best_iter"))
              .otherwise(F.col("last_iter")))
    cols = ["task_id", F.coalesce(code, F.lit("")).alias("code"), score.alias("score"), iters.alias("iterations")]
    if with_iter:
        cols.append(chosen.alias("chosen_iter"))
    return agg.select(*cols)


def revise_transcript(attempts: DataFrame, tasks: DataFrame, max_iters: int = C.MAX_ITERS) -> DataFrame:
    """System, user(problem [+ tests]), then for every failed attempt the
    reply and the observation (X11), ending with the first successful reply.

    ``tasks``: task_id, problem, tests (array). ``attempts``: task_id, iter,
    reply, score, ran_ok, stdout, stderr. Attempts are gathered per task (at
    most ``max_iters`` of them) and ordered by iteration.
    """
    t = tasks.select("task_id", "problem", F.coalesce(F.col("tests"), F.array().cast("array<string>")).alias("tests"))
    has = F.size(F.col("tests")) > 0
    a = (attempts.filter(F.col("iter") < max_iters).join(t.select("task_id", has.alias("has_tests")), "task_id")
         .withColumn("success", F.coalesce(F.when(F.col("has_tests"), F.col("score") >= 1.0)
                                           .otherwise(F.col("ran_ok")), F.lit(False)))
         .withColumn("obs", T.observation("has_tests", "stderr", "stdout")))
    stop = F.min(F.when(F.col("success"), F.col("iter"))).over(Window.partitionBy("task_id"))
    steps = (a.withColumn("stop", stop)
             .filter(F.col("stop").isNull() | (F.col("iter") <= F.col("stop")))
             .groupBy("task_id")
             .agg(F.sort_array(F.collect_list(F.struct("iter", "reply", "obs", "success"))).alias("steps")))
    user = F.concat(F.coalesce(F.col("problem"), F.lit("")),
                    F.when(has, F.concat(F.lit(C.TESTS_HEADER), F.array_join("tests", "\n"))).otherwise(F.lit("")))
    turns = F.flatten(F.transform("steps", lambda s: F.when(
        s.getField("success"), F.array(M.message("assistant", s.getField("reply"))))
        .otherwise(F.array(M.message("assistant", s.getField("reply")), M.message("user", s.getField("obs"))))))
    return (t.join(steps, "task_id")
            .select("task_id", F.concat(M.messages(("system", C.CODE_SYSTEM_PROMPT), ("user", user)), turns)
                    .alias("messages")))
