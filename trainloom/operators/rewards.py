"""Reward plug-ins that score whole batches, several in one Arrow pass."""

from __future__ import annotations

import inspect
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# (prompts, completions, **columns) -> a score for each row.
Reward = Callable[..., list[float | None]]


def _columns_of(fn: Reward, given: list[str]) -> list[str]:
    """The columns a plug-in asks for by name, or all if it takes any keyword."""
    wanted = inspect.signature(fn).parameters.values()
    if any(p.kind is p.VAR_KEYWORD for p in wanted):
        return given
    return [c for c in given if c in {p.name for p in wanted}]


def score_rows(df: DataFrame, rewards: dict[str, Reward], keys: list[str], prompt: str = "prompt", completion: str = "completion",
               columns: list[str] | None = None) -> DataFrame:
    """``keys`` and one double column for each reward.

    A plug-in is called with lists ``prompts`` and ``completions`` and, by name, those of
    ``columns`` (default: all others) that it has as parameters; one with ``**kw`` gets all.
    A null completion reaches it as "". It must give one score (or None) per row. Only
    columns that some plug-in asks for leave the JVM.
    """
    others = columns if columns is not None else [c for c in df.columns if c not in (prompt, completion)]
    asked = {name: _columns_of(fn, others) for name, fn in rewards.items()}
    sent = [c for c in others if any(c in a for a in asked.values())]
    source = df.select(F.struct(*keys).alias("keys"), df[prompt].alias("prompts"), F.coalesce(df[completion], F.lit("")).alias("completions"),
                       F.struct(F.lit(0).alias("_"), *sent).alias("columns"))
    schema = T.StructType([T.StructField("keys", source.schema["keys"].dataType), *[T.StructField(n, T.DoubleType()) for n in rewards]])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = {c: batch.column("columns").field(i + 1).to_pylist() for i, c in enumerate(sent)}
            prompts, completions = batch.column("prompts").to_pylist(), batch.column("completions").to_pylist()
            scores = []
            for name, fn in rewards.items():
                got = fn(prompts=prompts, completions=completions, **{c: lists[c] for c in asked[name]})
                if len(got) != len(completions):
                    raise ValueError(f"reward {name!r} gave {len(got)} scores for {len(completions)} rows")
                scores.append(pa.array(got, pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("keys").cast(arrow.field("keys").type), *scores], schema=arrow)

    return source.mapInArrow(run, schema).select("keys.*", *rewards)
