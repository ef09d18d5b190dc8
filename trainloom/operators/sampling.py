"""Seeded shuffle + cap, head/tail splits and per-group top-1."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.functions.mutation import seeded_order_key


def seeded_cap(df: DataFrame, key: str, n: int | None, seed: int = C.SHUFFLE_SEED) -> DataFrame:
    """L1 + L2 (+ F6): order by md5(seed:key), key and keep the first ``n``.

    The order depends on the key only, so any partitioning gives the same rows.
    ``n`` of None/0 means no cap (every row, no sort). With a cap, Spark plans a
    distributed top-n (TakeOrderedAndProject): each task keeps ``n`` rows.
    """
    if not n:
        return df
    return df.orderBy(seeded_order_key(seed, key), F.col(key)).limit(int(n))


BROADCAST_KEYS = 1_000_000


def chosen_rows(df: DataFrame, key: str, n: int | None, seed: int = C.SHUFFLE_SEED, among: DataFrame | None = None) -> DataFrame:
    """The rows of ``df`` whose unique ``key`` is among the first ``n`` in the seeded order (of the
    keys of ``among``, if given); all rows without a cap.

    The top-n runs on the keys alone, ``n`` per task, and wide rows meet only the chosen keys,
    which are broadcast while ``n`` bounds them to ``BROADCAST_KEYS``.
    """
    if not n:
        return df
    keys = seeded_cap((df if among is None else among).select(F.col(key).alias("_chosen_key")), "_chosen_key", n, seed)
    keys = F.broadcast(keys) if n <= BROADCAST_KEYS else keys
    return df.join(keys, df[key].eqNullSafe(keys["_chosen_key"]), "left_semi")


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    """L3: the first ``min(n, rows)`` rows by key."""
    return df.orderBy(F.col(key)).limit(int(n))


def tail(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows after the first ``n`` by key (anti-join against the head keys)."""
    return df.join(head(df.select(key), key, n), key, "left_anti")


def top1_by(df: DataFrame, group_cols: list[str], value_cols: list[str], score: str, order: str) -> DataFrame:
    """Per group the row with the highest ``score``, earliest ``order`` on ties.

    ``max_by`` over a (score, -order) struct is a plain aggregate: partial
    aggregation runs before the shuffle, so a hot group costs no more than a
    small one.
    """
    rank = F.struct(F.col(score), (-F.col(order)).alias("neg_order"))
    aggs = [F.max_by(F.col(c), rank).alias(c) for c in value_cols + [score, order]]
    return df.groupBy(*group_cols).agg(*aggs)
