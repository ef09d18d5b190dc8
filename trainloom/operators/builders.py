"""D3: dataset builders by name, with the smoke flag (S2) and the non-empty guard.

A builder takes its source rows, the job's parameters and the smoke flag. With the flag, a
budgeted source is cut to its first ``max(100, 4 n)`` rows by key before the shuffle, so that
a smoke run reads little; the reasoning source never is (a prefix could miss a domain).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from trainloom.config import JobParams
from trainloom.operators import datasets as DS
from trainloom.operators.accounting import StageCounts
from trainloom.sources.catalog import smoke_slice
from trainloom.sources.shared import materialise

Builder = Callable[[DataFrame, JobParams, bool], DataFrame]


def _reasoning(rows: DataFrame, p: JobParams, smoke: bool) -> DataFrame:
    return DS.reasoning_sft(rows, "id", p)


def _general(rows: DataFrame, p: JobParams, smoke: bool) -> DataFrame:
    return DS.general_sft(smoke_slice(rows, "id", p.general_max_samples, smoke), "id", p)


def _rl(rows: DataFrame, p: JobParams, smoke: bool) -> DataFrame:
    return DS.rl_prompts(smoke_slice(rows, "task_id", p.grpo_max_samples, smoke), "task_id", p)


def _repair(rows: DataFrame, p: JobParams, smoke: bool) -> DataFrame:
    return DS.repair_sft(smoke_slice(rows, "task_id", p.repair_max_samples, smoke), "task_id", p)


BUILDERS: dict[str, Builder] = {"reasoning_sft": _reasoning, "general_sft": _general, "rl_prompts": _rl, "repair_sft": _repair}


def build(name: str, rows: DataFrame, params: JobParams | None = None, smoke: bool = False) -> DataFrame:
    """The dataset ``name`` from its source rows, written to the shared folder. Fails if the
    source had no rows or none remain; the rows are counted while the dataset is written."""
    if name not in BUILDERS:
        raise KeyError(f"unknown dataset {name!r}; known: {', '.join(sorted(BUILDERS))}")
    counts = StageCounts()
    out = materialise(counts.count(BUILDERS[name](rows, params or JobParams(), smoke), name), name)
    counts.require()
    return out
