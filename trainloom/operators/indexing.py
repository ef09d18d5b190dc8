"""Gapless row numbers over a distributed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainloom import config as C
from trainloom.functions.mutation import seeded_order_key
from trainloom.sources.shared import materialise

_PLACE_BITS = 33  # monotonically_increasing_id: partition above, place in the partition below


def numbered(df: DataFrame, order: list[str | Column], by: list[str] | None = None, name: str = "row_index") -> DataFrame:
    """``df`` with ``name``: 0, 1, 2, ... in the given order, from 0 again for each ``by`` group.

    Rows are range-partitioned by group and order, so a group of any size is spread over
    tasks; each row knows its place in its partition, and the rows of earlier partitions are
    added from their counts (one row per partition, or per group and partition). The
    partitioned rows are written to the shared folder, which pins the partition bounds.
    Rows that tie in the order keep one of their possible orders.
    """
    by = by or []
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    names = [f"_order{i}" for i in range(len(keys))]
    rows = df.select("*", *[k.alias(n) for k, n in zip(keys, names)])
    rows = rows.repartitionByRange(*by, *names).sortWithinPartitions(*by, *names)
    place = F.monotonically_increasing_id()
    rows = materialise(rows.withColumn("_row_part", F.spark_partition_id()).withColumn("_row_place", place.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))).drop(*names), "numbered")
    counts = rows.groupBy(*by, "_row_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_row_place").alias("_first"))
    if by:
        earlier = Window.partitionBy(*by).orderBy("_row_part").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col("_row_part").alias("_p"),
                               (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_row_add"))
        same = F.col("_row_part") == F.col("_p")
        for i, c in enumerate(by):
            same = same & F.col(c).eqNullSafe(F.col(f"_by{i}"))
        out = rows.join(counts, same).drop("_p", *[f"_by{i}" for i in range(len(by))])
    else:
        # One row per partition: a bounded list.
        add, total = [], 0
        for r in sorted(counts.collect(), key=lambda r: r["_row_part"]):
            add.append((r["_row_part"], total - r["_first"]))
            total += r["_n"]
        out = rows.join(F.broadcast(df.sparkSession.createDataFrame(add, "_row_part int, _row_add long")), "_row_part")
    return out.withColumn(name, F.col("_row_place") + F.col("_row_add")).drop("_row_part", "_row_place", "_row_add")


def seeded_shuffle(df: DataFrame, key: str, seed: int = C.SHUFFLE_SEED, name: str = "row_index") -> DataFrame:
    """L1 + L4: every row with its place after the seeded shuffle."""
    return numbered(df, [seeded_order_key(seed, key), F.col(key)], name=name)
