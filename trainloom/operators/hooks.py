"""Maps and filters by Python callables, in Arrow batches.

Native expressions are the default of every builder; these hooks are for rules of a
user's own. Only the ``columns`` that a callable asks for travel to Python; one that the
source lacks reads as null. Output columns are declared and replace all input columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trainloom.operators.indexing import numbered


def _asked(df: DataFrame, columns: list[str] | None) -> DataFrame:
    return df.select(*[df[c] if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns or df.columns])


def _as_struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema: str | T.StructType, columns: list[str] | None = None) -> DataFrame:
    """One output row per input row: ``fn(row)`` gives a dict; what it leaves out is null."""
    struct = _as_struct(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([fn(r) for r in batch.to_pylist()], arrow)

    return _asked(df, columns).mapInArrow(run, struct)


def map_batches(df: DataFrame, fn: Callable[[dict], dict], schema: str | T.StructType, columns: list[str] | None = None,
                batch_size: int = 64) -> DataFrame:
    """``fn`` takes and gives lists by column, up to ``batch_size`` rows at a time; it may
    give more rows or fewer, but lists of one length."""
    struct = _as_struct(schema)
    arrow = to_arrow_schema(struct)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, batch_size):
                out = fn(batch.slice(at, batch_size).to_pydict())
                sizes = {len(v) for v in out.values()}
                if len(sizes) > 1:
                    raise ValueError(f"columns of different lengths: {sorted(sizes)}")
                n = sizes.pop() if sizes else 0
                yield pa.RecordBatch.from_arrays([pa.array(out.get(f.name, [None] * n), f.type) for f in arrow], schema=arrow)

    return _asked(df, columns).mapInArrow(run, struct)


def map_indexed(df: DataFrame, fn: Callable[[dict, int], dict], schema: str | T.StructType, order: list[str | Column],
                columns: list[str] | None = None) -> DataFrame:
    """``map_rows`` with each row's place (0, 1, 2, ...) in ``order`` as second argument."""
    place = "_place_of_row"
    rows = numbered(df, order, name=place)
    return map_rows(rows, lambda r: fn({k: v for k, v in r.items() if k != place}, r[place]), schema, [*(columns or df.columns), place])


def keep_where(df: DataFrame, fn: Callable[..., bool], columns: list[str]) -> DataFrame:
    """Rows for which ``fn(*values of columns)`` is true; the other columns stay in the JVM."""
    @F.arrow_udf(T.BooleanType())
    def keeps(*arrays: pa.Array) -> pa.Array:
        return pa.array([bool(fn(*values)) for values in zip(*[a.to_pylist() for a in arrays])], pa.bool_())

    return df.where(keeps(*[df[c] if c in df.columns else F.lit(None).cast("string") for c in columns]))
