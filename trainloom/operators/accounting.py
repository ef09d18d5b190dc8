"""A13 + F4: rows of each stage, counted in the pass that writes the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class StageCounts:
    """Counts the rows that leave each stage of a chain while the chain runs.

    ``count`` wraps a frame, in the order of the chain. After the action that runs the
    chain, ``rows`` gives stage, rows_in, rows_out, and ``require`` fails for the first
    stage that left nothing: no extra job. A count holds for one run of the plan, so the
    frame must be used once in it, and not below a plain limit, which stops reading early.
    """

    def __init__(self):
        self.stages: list[tuple[str, Observation]] = []

    def count(self, df: DataFrame, stage: str) -> DataFrame:
        seen = Observation()
        self.stages.append((stage, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def counts(self) -> list[tuple[str, int | None, int]]:
        out, before = [], None
        for stage, seen in self.stages:
            n = seen.get["rows"]
            out.append((stage, before, n))
            before = n
        return out

    def require(self) -> None:
        for stage, _, n in self.counts():
            if not n:
                raise RuntimeError(f"{stage}: no rows remain")

    def rows(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.counts(), "stage string, rows_in long, rows_out long")
