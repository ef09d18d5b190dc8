"""Candidate x test expansion, pass fractions and rewards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.functions import text as T

CANDIDATE_KEYS = ["task_id", "sample_ix"]


def attach_tests(rollouts: DataFrame, tasks: DataFrame, tests_col: str = "tests") -> DataFrame:
    """Each completion gets its task's tests and setup; a task that is
    missing gives an empty test list and an empty setup."""
    t = tasks.select("task_id", F.col(tests_col).alias("tests"), F.col("setup"))
    out = rollouts.join(t, "task_id", "left")
    return (out.withColumn("tests", F.coalesce(F.col("tests"), F.array().cast("array<string>")))
               .withColumn("setup", F.coalesce(F.col("setup"), F.lit(""))))


def dedup_outcomes(outcomes: DataFrame, keys=("task_id", "sample_ix", "test_ix")) -> DataFrame:
    """One verdict per (candidate, test): passed if any report says passed."""
    return outcomes.groupBy(*keys).agg(F.bool_or(F.coalesce(F.col("passed"), F.lit(False))).alias("passed"))


def pass_fraction(candidates: DataFrame, outcomes: DataFrame, tests_col: str = "tests",
                  keys=CANDIDATE_KEYS, first_ix=0, keep: tuple[str, ...] = ()) -> DataFrame:
    """J4 + A1: every candidate runs every test of its list; a missing outcome
    counts as a failure, a test reported twice as one; no tests -> 0.0.

    ``first_ix`` (number or column) is the place of the list's first test in the
    task's whole list, which outcomes are numbered by.

    Returns the candidate keys, the columns ``keep`` of the candidates, ``n_tests``, ``n_passed`` and ``frac``.
    """
    return pass_fractions(candidates, outcomes, {"": (tests_col, first_ix)}, keys, keep)


def pass_fractions(candidates: DataFrame, outcomes: DataFrame, lists: dict[str, tuple],
                   keys=CANDIDATE_KEYS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``pass_fraction`` on several lists of tests at once, verdicts being read once. ``lists``:
    prefix of the list's result columns -> (its column, place of its first test)."""
    rows = candidates.select(*keys, *keep, *[c for p, (tests, first) in lists.items() for c in (
        F.size(F.col(tests)).alias(f"{p}n_tests"), (F.col(first) if isinstance(first, str) else F.lit(first)).alias(f"{p}first_ix"))])
    out = passed_places(rows, outcomes, keys)
    for p in lists:
        n, first = F.col(f"{p}n_tests"), F.col(f"{p}first_ix")
        out = out.withColumn(f"{p}n_passed", F.size(F.filter("at", lambda i: (i >= first) & (i < first + n))))
    frac = {p: F.when(F.col(f"{p}n_tests") > 0, F.col(f"{p}n_passed") / F.col(f"{p}n_tests")).otherwise(F.lit(0.0)) for p in lists}
    return out.select(*keys, *keep, *[c for p in lists for c in (f"{p}n_tests", f"{p}n_passed", frac[p].alias(f"{p}frac"))])


def passed_places(candidates: DataFrame, outcomes: DataFrame, keys=CANDIDATE_KEYS) -> DataFrame:
    """``candidates`` with ``at``, the places of the tests that each one passed (a task's tests are few).

    Candidates and verdicts are rows of one window, not sides of a join: a join on all keys
    would shuffle tables that are already spread by one of them (the task)."""
    known = F.col("passed")
    for k in keys:
        known = known & F.col(k).isNotNull()
    verdicts = outcomes.filter(known).select(*keys, F.col("test_ix").cast("int").alias("_test_ix"))
    rows = candidates.withColumn("_wanted", F.lit(True)).unionByName(verdicts, allowMissingColumns=True)
    at = F.collect_set("_test_ix").over(Window.partitionBy(*keys))
    types = {f.name: f.dataType for f in candidates.schema}
    return (rows.withColumn("at", at).filter("_wanted")
            .select(*[F.col(c).cast(types[c]).alias(c) for c in candidates.columns], "at"))


def correctness_reward(frac) -> Column:
    """A2: 3 x pass fraction (the raw fraction is what gets logged)."""
    return F.lit(C.CORRECTNESS_WEIGHT) * T.col_(frac)


# Reward plug-ins, name -> builder of a Column from the scored frame.
REWARDS: dict[str, Callable[[DataFrame], Column]] = {
    "correctness": lambda df: correctness_reward("frac"),
    "format": lambda df: T.format_reward("completion_text"),
}


def register_reward(name: str, fn: Callable[[DataFrame], Column]) -> None:
    REWARDS[name] = fn


def composite_reward(df: DataFrame, weights: dict[str, float] | None = None,
                     names=("correctness", "format")) -> Column:
    """A3: weighted sum of the listed rewards (unweighted by default)."""
    weights = weights or {}
    total = None
    for n in names:
        term = REWARDS[n](df) * F.lit(float(weights.get(n, 1.0)))
        total = term if total is None else total + term
    return total
