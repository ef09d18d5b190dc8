"""Row filters and projections of the dataset builders."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def domain_filter(df: DataFrame, wanted: str, column: str = "domain") -> DataFrame:
    """lower-case equality, applied only when the column exists; a NULL
    domain compares as the text 'none'."""
    if column not in df.columns:
        return df
    return df.filter(F.lower(F.coalesce(F.col(column).cast("string"), F.lit("None"))) == wanted.lower())


def nonempty_messages(df: DataFrame, column: str = "messages") -> DataFrame:
    """drop rows whose message list is empty or NULL."""
    return df.filter(F.size(F.coalesce(F.col(column), F.array())) > 0)


def length_filter(df: DataFrame, max_len: int, column: str = "token_length",
                  observation: Observation | None = None) -> DataFrame:
    """keep rows with ``column <= max_len``. With an ``Observation`` the
    before/kept counts are collected in the same pass as the write (A13)."""
    if observation is not None:
        df = df.observe(observation, F.count(F.lit(1)).alias("before"),
                        F.count_if(F.col(column) <= max_len).alias("kept"))
    return df.filter(F.col(column) <= max_len)


def require_rows(df: DataFrame, stage: str) -> DataFrame:
    """fail when a stage leaves no rows (a one-row probe, not a count)."""
    if df.isEmpty():
        raise RuntimeError(f"{stage}: no rows remain")
    return df


def keep_only(df: DataFrame, *columns: str) -> DataFrame:
    """Project to the given columns (everything else removed)."""
    return df.select(*columns)
