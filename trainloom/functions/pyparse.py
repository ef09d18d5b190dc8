"""X4: "is valid Python" as an Arrow-batched pandas UDF (parses, never runs)."""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType


def _parses(src) -> bool:
    if src is None:
        return False
    try:
        ast.parse(src)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False
    return True


@F.pandas_udf(BooleanType())
def is_valid_python(src: pd.Series) -> pd.Series:
    return src.map(_parses).astype(bool)


@F.pandas_udf(ArrayType(StringType()))
def keep_parsable(arrs: pd.Series) -> pd.Series:
    """Filter each array of statements to those that parse."""
    return arrs.map(lambda a: [] if a is None else [s for s in a if _parses(s)])
